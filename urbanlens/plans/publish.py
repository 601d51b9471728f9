"""Publishing marts (S20/S21): each all-or-nothing, independent of the others.

Each mart is written into a fresh folder, validated there and then published in its own
version log (``operators/versions``); readers take the newest version of each. A mart that
fails keeps its version before, the others move on, and nothing that readers use is ever
replaced, so a crash, or a reader in between, finds whole versions only.

Facts are laid out in two dimensions: a row's place is the interleaved bits of its day
and of its station's rank, so that a narrow range of places is a narrow range of both.
Rows are dealt by the leading bits of the place (Spark rebalances the partitions by the
sizes it sees, without running the input first for a sample) and sorted by place inside a
file, whose row groups are small: a predicate on a date range, and one on a station, each
skip most row groups.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlens.functions.columns import date_from_key
from urbanlens.operators.versions import VersionLog
from urbanlens.plans import intermediate as I
from urbanlens.plans import marts as M
from urbanlens.plans.ingest import Outcome, StageError, run_each, snapshot, write_counted
from urbanlens.plans.warehouse import MART_NAMES

FACTS = {"fct_transit_delays", "fct_bike_trips"}
# the station column of each fact's layout
STATION_COLUMNS = {"fct_transit_delays": "station_key", "fct_bike_trips": "start_station_key"}
ROW_GROUP_BYTES = 4 << 20
DAYS = 1 << 13  # days told apart, about 22 years


def _spread(x: Column) -> Column:
    """The low 16 bits, each followed by a free one."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return x


def place(date_key: str, station_key: str) -> Column:
    """32 bits: those of the day and of the first four digits of the (hexadecimal) station key
    in turn, the day's first. Both rise with the column, so ranges of places are ranges of both."""
    key = F.col(date_key)
    date = F.make_date((key / 10000).cast("int"), (key / 100).cast("int") % 100, key % 100)
    day = F.pmod(F.datediff(date, F.lit("1970-01-01").cast("date")), F.lit(DAYS)) * (65536 // DAYS)
    rank = F.conv(F.substring(station_key, 1, 4), 16, 10)
    day, rank = (F.coalesce(c.cast("long"), F.lit(0).cast("long")) for c in (day, rank))
    return F.shiftleft(_spread(day), 1).bitwiseOR(_spread(rank))


def write_clustered(df: DataFrame, path: str, station_key: str, row_group_bytes: int = ROW_GROUP_BYTES) -> None:
    """One pass over ``df``: its rows by place, in small row groups with bloom filters on the station."""
    placed = df.withColumn("_place", place("date_key", station_key))
    # about eight parts of the whole space for each task: neighbouring places stay together
    bits = (8 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))).bit_length()
    (placed.withColumn("_part", F.shiftright("_place", 32 - min(32, bits))).hint("rebalance", "_part").sortWithinPartitions("_place")
     .drop("_place", "_part").write.option("parquet.block.size", row_group_bytes)
     .option(f"parquet.bloom.filter.enabled#{station_key}", "true").parquet(path))


def daily_from_facts(transit: DataFrame, trips: DataFrame) -> DataFrame:
    """M17 from the published facts: the per-day rollups read the written facts
    instead of re-deriving the enriched models a second time."""
    # the date is a function of the key, and the daily fact has the key alone
    t = transit.withColumn("delay_date", F.col("date_key"))
    b = (trips.withColumn("trip_date", F.col("date_key"))
         .withColumnRenamed("duration_seconds", "trip_duration_seconds"))
    return M.fct_daily_mobility(I.daily_transit(t), I.daily_bike(b))


PUBLISH_ORDER = ("fct_transit_delays", "fct_bike_trips", "dim_date", "dim_station", "dim_weather",
                 "dim_delay_codes", "fct_daily_mobility")


class PublishError(RuntimeError):
    """Marts that did not pass; their versions before stay current."""


def _check(spark: SparkSession, name: str, path: str, facts: dict[str, str]) -> None:
    """Facts and the calendar are not empty; the calendar has the facts' dates; incident keys
    are unique (trips are not deduplicated, Q26)."""
    mart = spark.read.parquet(path)
    if name in (*FACTS, "dim_date") and mart.isEmpty():
        raise PublishError(f"{name} is empty")
    if name == "dim_date":
        for fact, at in sorted(facts.items()):
            days = spark.read.parquet(at).select("date_key").filter("date_key is not null").distinct()
            if not days.join(mart, "date_key", "left_anti").isEmpty():
                raise PublishError(f"{fact} has dates outside the calendar")
    if name == "fct_transit_delays":
        if not mart.groupBy("delay_sk", "transit_mode").count().filter("count > 1").isEmpty():
            raise PublishError("fct_transit_delays has a key twice")


def publish_datasets(wh, base: str, names: tuple[str, ...] = PUBLISH_ORDER, validate: bool = True,
                     from_facts: bool = True) -> list[Outcome]:
    """Build, write, validate and publish each mart on its own; one outcome for each.

    Facts go first; the calendar's bounds and the daily fact are then derived from the
    newest published facts (one integer column / one pass), not again from the raw feeds,
    unless ``from_facts`` is False.
    """
    spark, base = wh.spark, base.rstrip("/")

    def published_facts() -> dict[str, str]:
        found = snapshot(spark, base, sorted(FACTS))
        if set(found) != FACTS:
            raise StageError("build", PublishError(f"no version of {', '.join(sorted(FACTS - set(found)))}"))
        return found

    def build(name: str) -> DataFrame:
        if not from_facts or name not in ("fct_daily_mobility", "dim_date"):
            return getattr(wh, name)
        transit, trips = (spark.read.parquet(path) for _, path in sorted(published_facts().items(), reverse=True))
        if name == "dim_date":
            return M.dim_date_over(*[(f, date_from_key("date_key")) for f in (transit, trips)])
        return daily_from_facts(transit, trips)

    def step(name: str) -> int:
        path = f"{base}/{name}/v-{uuid.uuid4().hex[:12]}"
        station = STATION_COLUMNS.get(name)
        if station:
            rows = write_counted(build(name), path, lambda df, to: write_clustered(df, to, station))
        else:
            rows = write_counted(build(name), path)
        if validate:
            try:
                facts = {} if name != "dim_date" else published_facts() if from_facts else snapshot(spark, base, sorted(FACTS))
                _check(spark, name, path, facts)
            except PublishError as exc:
                raise StageError("validate", exc) from exc
        VersionLog(spark, f"{base}/_versions/{name}").push({"path": path, "rows": rows})
        return rows

    return run_each({name: lambda n=name: step(n) for name in names})


def _raise_failed(outcomes: list[Outcome]) -> None:
    failed = [o for o in outcomes if o.status != "success"]
    if failed:
        raise PublishError("; ".join(f"{o.dataset} ({o.stage}): {o.error}" for o in failed))


def publish_marts(wh, base: str, validate: bool = True) -> str:
    """Publish every mart; ``PublishError`` names those that failed. Returns ``base``."""
    assert set(PUBLISH_ORDER) == set(MART_NAMES)
    _raise_failed(publish_datasets(wh, base, validate=validate))
    return base


def published_mart(wh, base: str, name: str) -> str:
    """Folder of one mart's newest version, which is published now if there is none. The
    calendar and the daily fact come from the facts if both are there, else from the raw
    feeds: a query of days needs no published facts."""
    found = snapshot(wh.spark, base, (name, *sorted(FACTS)))
    if name not in found:
        _raise_failed(publish_datasets(wh, base, (name,), from_facts=FACTS <= set(found)))
        found = snapshot(wh.spark, base, (name,))
    return found[name]


def current_version(spark: SparkSession, base: str) -> dict[str, str]:
    """Folder of the newest version of each mart."""
    return snapshot(spark, base, PUBLISH_ORDER)
