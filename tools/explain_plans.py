"""Write PLANS.md: formatted physical plans of the headline queries and the fact build.

usage: python tools/explain_plans.py [sf_dir]
AQE is switched off while explaining so the plan shows the chosen join and
exchange operators up front (at run time AQE may only improve on them).
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
import uuid

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from urbanlens.plans import analytics as R  # noqa: E402
from urbanlens.plans import params as P  # noqa: E402
from urbanlens.plans.publish import current_version, publish_marts  # noqa: E402
from urbanlens.plans.warehouse import Warehouse  # noqa: E402
from urbanlens.session import get_session, shared_dir  # noqa: E402

KEEP = re.compile(r"^\(\d+\) |PushedFilters|ReadSchema|Join type|Build side|Keys|Functions|Partitioning")


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree, _, details = text.partition("\n\n")
    keep = [ln for ln in details.splitlines() if KEEP.search(ln)]
    return tree.strip() + "\n\n" + "\n".join(k[:220] for k in keep)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]")
    base = shared_dir(spark, f"plans-{uuid.uuid4().hex[:8]}")
    raw_wh = Warehouse(spark, sf)
    publish_marts(raw_wh, base)
    wh = Warehouse.from_marts(spark, current_version(spark, base))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    items = [
        ("R01 daily_mobility_summary", R.daily_mobility_summary(wh)),
        ("R02 top_delay_stations", R.top_delay_stations(wh)),
        ("R03 bike_weather_correlation", R.bike_weather_correlation(wh)),
        ("R05 monthly_trends", R.monthly_trends(wh)),
        ("R20 station_delay_metrics", R.station_delay_metrics(wh, P.SUBWAY_STATION_KEY, P.date_range(wh))),
        ("M15 fct_transit_delays (build from raw)", raw_wh.fct_transit_delays),
    ]
    out = ["# Physical plans", "",
           f"Generated by `tools/explain_plans.py` on `{os.path.basename(sf)}` (AQE off while explaining;",
           "analytic queries read the published marts). Trimmed to the operators, pushed filters,",
           "read schemas, join types and exchange partitioning.", ""]
    for title, df in items:
        out += [f"## {title}", "", "```", formatted(df), "```", ""]
    with open(os.path.join(ROOT, "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
