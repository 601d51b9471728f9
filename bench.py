"""Benchmark: build the marts from the raw role frames, publish them, time the queries.

Prints one JSON line. ``value`` is the summed median wall time of the five
benchmark analyses (R01-R05) run against the published marts, the workload
the reference times; ``build_marts`` (raw -> published marts) and the
dashboard queries are reported alongside.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import uuid
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from urbanlens.plans import analytics as R  # noqa: E402
from urbanlens.plans import params as P  # noqa: E402
from urbanlens.plans.publish import current_version, publish_marts  # noqa: E402
from urbanlens.plans.warehouse import Warehouse  # noqa: E402
from urbanlens.session import get_session, shared_dir  # noqa: E402

BENCHMARK = {
    "r01_daily_summary": R.daily_mobility_summary,
    "r02_top_delay_stations": R.top_delay_stations,
    "r03_bike_weather": R.bike_weather_correlation,
    "r04_cross_modal": R.cross_modal_analysis,
    "r05_monthly_trends": R.monthly_trends,
}
DASHBOARD = {
    "r12_station_delays": lambda wh: R.ttc_station_delays(wh, P.MODES, P.date_range(wh)),
    "r14_hourly_pattern": lambda wh: R.ttc_hourly_pattern(wh, P.MODES, P.date_range(wh)),
    "r16_station_activity": lambda wh: R.bike_station_activity(wh, P.USER_TYPES, P.date_range(wh)),
    "r20_station_delay_metrics": lambda wh: R.station_delay_metrics(wh, P.SUBWAY_STATION_KEY, P.date_range(wh)),
    "r21_station_trip_metrics": lambda wh: R.station_trip_metrics(wh, P.BIKE_STATION_KEY, P.date_range(wh)),
    "r25_category_share": R.category_share,
    "r33_trips_by_weather": R.trips_by_weather,
}


def timed(fn, runs: int = 3) -> float:
    fn()  # warm-up
    out = []
    for _ in range(runs):
        t = time.perf_counter()
        fn()
        out.append(time.perf_counter() - t)
    return statistics.median(out)


def event_log_metrics(log_dir: str) -> dict[str, dict[str, int]]:
    """Per job description: input rows and shuffle bytes written, from Spark's event log."""
    import glob
    import json as _json

    stage_desc: dict[int, str] = {}
    out: dict[str, dict[str, int]] = {}
    for path in glob.glob(f"{log_dir}/**", recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as fh:
            for line in fh:
                ev = _json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    desc = (ev.get("Properties") or {}).get("spark.job.description")
                    if desc:
                        for sid in ev.get("Stage IDs", []):
                            stage_desc[sid] = desc
                elif kind == "SparkListenerTaskEnd":
                    desc = stage_desc.get(ev.get("Stage ID"))
                    m = ev.get("Task Metrics") or {}
                    if desc and m:
                        agg = out.setdefault(desc, {"input_rows": 0, "shuffle_bytes": 0})
                        agg["input_rows"] += (m.get("Input Metrics") or {}).get("Records Read", 0)
                        agg["shuffle_bytes"] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus)
    out_dir = shared_dir(spark, f"bench-marts-{uuid.uuid4().hex[:12]}")

    t = time.perf_counter()
    publish_marts(Warehouse(spark, sf_dir), out_dir)
    build = time.perf_counter() - t

    version = current_version(spark, out_dir)
    wh = Warehouse.from_marts(spark, version, cache_small=True)
    queries = {}
    for name, fn in {**BENCHMARK, **DASHBOARD}.items():
        queries[name] = round(timed(lambda fn=fn: fn(wh).collect()), 4)
    value = round(sum(queries[k] for k in BENCHMARK), 4)
    sf = os.path.basename(sf_dir).replace("sf", "")
    spark.stop()
    # input rows and shuffle bytes: one tagged run per query in a second context with
    # the event log on (kept out of the timed runs, since it writes every task event)
    log_dir = tempfile.mkdtemp(prefix="urbanlens-eventlog-")
    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{log_dir}",
        "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"})
    wh = Warehouse.from_marts(spark, version)  # uncached, so input rows count the parquet reads
    for name, fn in {**BENCHMARK, **DASHBOARD}.items():
        spark.sparkContext.setJobDescription(f"measure:{name}")
        fn(wh).collect()
        spark.sparkContext.setJobDescription(None)
    spark.stop()
    metrics = {k.split(":", 1)[1]: v for k, v in event_log_metrics(log_dir).items() if k.startswith("measure:")}
    print(json.dumps({
        "metric": "benchmark_analyses_total_median", "value": value, "unit": "sec",
        "queries": {**queries, "build_marts": round(build, 3)}, "sf": sf, "cpus": cpus,
        "per_query_input_rows": {k: v["input_rows"] for k, v in metrics.items()},
        "per_query_shuffle_bytes": {k: v["shuffle_bytes"] for k, v in metrics.items()},
    }))


if __name__ == "__main__":
    main()
