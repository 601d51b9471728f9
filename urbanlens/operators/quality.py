"""Data-quality checks D01-D18. Each returns the violating rows as a DataFrame
(empty = pass); ``run_suite`` collects a list of checks into one results frame.

Checks are ordinary distributed jobs: group-bys for uniqueness, anti joins for
relationships, windows over already-aggregated daily frames for trends.
Nothing is collected to the driver except the per-check counts of the suite.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanlens import config as C
from urbanlens.functions.columns import date_key


def unique(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """Key values occurring more than once (NULL keys ignored, like the source tests)."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    nn = None
    for c in cols:
        cond = F.col(c).isNotNull()
        nn = cond if nn is None else nn & cond
    return (df.filter(nn).groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records"))
            .filter(F.col("n_records") > 1))


def not_null(df: DataFrame, col: str, keep: Sequence[str] = ()) -> DataFrame:
    """Rows where ``col`` is NULL."""
    out = df.filter(F.col(col).isNull())
    return out.select(*keep) if keep else out


def accepted_values(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    """Values outside the domain with their counts (NULL passes)."""
    return (df.filter(F.col(col).isNotNull() & ~F.col(col).isin(list(values)))
            .groupBy(col).agg(F.count(F.lit(1)).alias("n_records")))


def relationships(child: DataFrame, col: str, parent: DataFrame, parent_col: str,
                  where: Column | None = None) -> DataFrame:
    """Child keys without a parent (anti join, U04 set difference; NULL child keys pass)."""
    c = child.filter(F.col(col).isNotNull())
    if where is not None:
        c = c.filter(where)
    p = parent.select(F.col(parent_col).alias(col)).distinct()
    return c.join(p, col, "left_anti")


def value_between(df: DataFrame, col: str, lo, hi, keep: Sequence[str] = ()) -> DataFrame:
    """Rows with ``col`` outside [lo, hi] (NULL passes)."""
    out = df.filter(F.col(col).isNotNull() & ~F.col(col).between(lo, hi))
    return out.select(*keep, col) if keep else out


def row_count_between(df: DataFrame, lo: int, hi: int | None = None) -> DataFrame:
    """One row (n_rows) when the table size is outside [lo, hi]."""
    n = df.agg(F.count(F.lit(1)).alias("n_rows"))
    bad = F.col("n_rows") < lo
    if hi is not None:
        bad = bad | (F.col("n_rows") > hi)
    return n.filter(bad)


def freshness(df: DataFrame, ts_col: str, as_of: dt.date, warn_days: int = C.FRESHNESS_WARN_DAYS,
              error_days: int = C.FRESHNESS_ERROR_DAYS) -> DataFrame:
    """Age of the newest record at ``as_of`` and the status it earns."""
    age = F.datediff(F.lit(as_of), F.to_date(F.max(ts_col)))
    return df.agg(F.max(ts_col).alias("max_loaded_at"), age.alias("age_days")).withColumn(
        "status", F.when(F.col("age_days") > error_days, "error")
        .when(F.col("age_days") > warn_days, "warn").otherwise("pass"))


def load_freshness(loaded: DataFrame, as_of: dt.date | Column, warn_days: int = C.FRESHNESS_WARN_DAYS,
                   error_days: int = C.FRESHNESS_ERROR_DAYS) -> DataFrame:
    """D07 on the load time: age of the newest file of a landed table (a DataFrame that reads files)."""
    times = loaded.select(F.col("_metadata.file_modification_time").alias("loaded_at"))
    age = F.datediff(F.lit(as_of) if isinstance(as_of, dt.date) else as_of, F.to_date(F.max("loaded_at")))
    return times.agg(F.max("loaded_at").alias("max_loaded_at"), age.alias("age_days")).withColumn(
        "status", F.when(F.col("age_days").isNull() | (F.col("age_days") > error_days), "error")
        .when(F.col("age_days") > warn_days, "warn").otherwise("pass"))


def volume_anomalies(series: DataFrame, time_col: str, value_col: str, training: int = 14,
                     sensitivity: float = 3.0, by: Sequence[str] = ()) -> DataFrame:
    """Points further than ``sensitivity`` standard deviations from the mean of the
    previous ``training`` points (of the same table, with ``by``); passes until that many
    points exist. ``operators/history`` does this over the recorded metrics of runs.

    ``series`` is one row per period (already aggregated), so the ordered window
    runs over a small frame.
    """
    w = Window.partitionBy(*by).orderBy(time_col).rowsBetween(-training, -1)
    value = F.col(value_col).cast("double")
    s = series.select(*by, time_col, value.alias("value"), F.avg(value).over(w).alias("baseline"),
                      F.stddev_samp(value).over(w).alias("spread"), F.count(value).over(w).alias("_n"),
                      F.sum(value).over(w).alias("_s"), F.sum(value * value).over(w).alias("_q"))
    # |value - baseline| > sensitivity x spread without roots or quotients: exact for counts
    off = F.pow(F.col("_n") * F.col("value") - F.col("_s"), F.lit(2)) * (F.col("_n") - 1)
    spread = F.col("_n") * F.col("_q") - F.col("_s") * F.col("_s")
    return (s.filter((F.col("_n") >= training) & (spread > 0) & (off > sensitivity ** 2 * F.col("_n") * spread))
            .withColumnRenamed("_n", "trained_on").drop("_s", "_q"))


def freshness_anomalies(dates: DataFrame, date_col: str, training: int = 14,
                        sensitivity: float = 3.0, by: Sequence[str] = ()) -> DataFrame:
    """Gaps between consecutive distinct dates that are anomalous against history."""
    d = dates.select(*by, F.col(date_col).alias("d")).distinct()
    before = F.lag("d").over(Window.partitionBy(*by).orderBy("d"))
    gaps = d.select(*by, "d", F.datediff("d", before).alias("gap_days")).filter(F.col("gap_days").isNotNull())
    return volume_anomalies(gaps, "d", "gap_days", training, sensitivity, by).withColumnRenamed("d", date_col)


def schema_changes(df: DataFrame, expected: DataFrame) -> DataFrame:
    """Columns added, removed or retyped relative to ``expected`` (column_name, data_type)."""
    spark = df.sparkSession
    actual = spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in df.schema.fields],
                                   "column_name string, data_type string")
    e = expected.select("column_name", F.col("data_type").alias("expected_type"))
    j = actual.join(e, "column_name", "full")
    return j.select("column_name", "expected_type", F.col("data_type").alias("actual_type"),
                    F.when(F.col("expected_type").isNull(), "added")
                    .when(F.col("data_type").isNull(), "removed")
                    .when(F.col("expected_type") != F.col("data_type"), "retyped").alias("change")) \
        .filter(F.col("change").isNotNull())


def value_counts(df: DataFrame) -> DataFrame:
    """(column_name, n_values): non-null values of each column, one aggregate."""
    wide = df.agg(*[F.count(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("n_values")) for i, c in enumerate(df.columns)])
    return wide.select(F.explode(rows).alias("r")).select("r.*")


def negative_delays(fct: DataFrame) -> DataFrame:
    """D11."""
    return fct.filter(F.col("delay_minutes") < 0).select("delay_sk", "delay_minutes", "transit_mode", "date_key")


def long_trips(fct: DataFrame, limit_seconds: int = C.LONG_TRIP_SECONDS) -> DataFrame:
    """D12 (warn): trips of at least a day."""
    return fct.filter(F.col("duration_seconds") >= limit_seconds).select("trip_sk", "duration_seconds", "date_key")


def future_dates(facts: dict[str, DataFrame], as_of: dt.date) -> DataFrame:
    """Rows of any fact dated after ``as_of`` (a parameter, so results are stable); the
    labelled violation sets are stacked (U03)."""
    cutoff = date_key(F.lit(as_of))
    out = None
    for name, df in facts.items():
        part = df.filter(F.col("date_key") > cutoff).select(F.lit(name).alias("source_model"), "date_key")
        out = part if out is None else out.unionByName(part)
    return out


def day_over_day_drops(daily: DataFrame, min_ratio: float = C.DAY_OVER_DAY_MIN_RATIO) -> DataFrame:
    """D14 (warn): days whose activity fell below ``min_ratio`` of the previous present day
    (W03 lag over the date key; the previous *present* date, Q17)."""
    counts = daily.select("date_key", (F.coalesce("total_delay_incidents", F.lit(0))
                                       + F.coalesce("total_bike_trips", F.lit(0))).alias("daily_activity_count"))
    w = Window.orderBy("date_key")
    prev = counts.withColumn("previous_day_count", F.lag("daily_activity_count").over(w))
    return prev.filter(F.col("previous_day_count").isNotNull() & (F.col("previous_day_count") > 0)
                       & (F.col("daily_activity_count").cast("double") / F.col("previous_day_count") < min_ratio))


def mapping_coverage(enriched: DataFrame, threshold: float = C.MAPPING_COVERAGE_MIN,
                     treat_as_unmapped: Sequence[str] = ()) -> DataFrame:
    """One row when the share of subway rows with a canonical station is below ``threshold``
    (A09 count(col) against count(*)).

    ``Unknown`` is a non-NULL name and counts as mapped unless listed in
    ``treat_as_unmapped`` (Q8).
    """
    s = enriched.filter(F.col("transit_mode") == "subway")
    name = F.col("canonical_station_name")
    if treat_as_unmapped:
        name = F.when(~name.isin(list(treat_as_unmapped)), name)
    cov = s.agg(F.count(F.lit(1)).alias("total_rows"), F.count(name).alias("mapped_rows"))
    ratio = F.col("mapped_rows").cast("double") / F.nullif(F.col("total_rows"), F.lit(0))
    return cov.withColumn("coverage_ratio", ratio).filter(F.col("coverage_ratio") < threshold)


def station_key_format(mapping: DataFrame) -> DataFrame:
    """D17 (part): keys not shaped ST_nnn, and keys carrying more than one canonical name."""
    bad_format = (mapping.filter(~F.col("station_key").rlike(r"^ST_\d{3}$"))
                  .select(F.lit("key_format").alias("check"), F.col("station_key").alias("detail")))
    multi = (mapping.groupBy("station_key")
             .agg(F.count_distinct("canonical_station_name").alias("n"))
             .filter(F.col("n") > 1)
             .select(F.lit("one_name_per_key").alias("check"), F.col("station_key").alias("detail")))
    return bad_format.unionByName(multi)


def code_seed_structure(codes: DataFrame, categories: Sequence[str] = C.DELAY_CATEGORIES,
                        max_words: int = 10) -> DataFrame:
    """D17 (part): descriptions of 1..max_words words, categories inside the domain."""
    words = F.size(F.split(F.trim("delay_description"), r"\s+"))
    bad_desc = (codes.filter((F.trim("delay_description") == "") | (words > max_words))
                .select(F.lit("description_words").alias("check"), F.col("delay_code").alias("detail")))
    bad_cat = (codes.filter(~F.col("delay_category").isin(list(categories)))
               .select(F.lit("category_domain").alias("check"), F.col("delay_code").alias("detail")))
    return bad_desc.unionByName(bad_cat)


def coordinates_in_bbox(stations: DataFrame, bbox=C.CITY_BBOX) -> DataFrame:
    """Stations without coordinates or outside the bounding box."""
    lat_min, lat_max, lon_min, lon_max = bbox
    lat, lon = F.col("latitude"), F.col("longitude")
    return stations.filter(lat.isNull() | lon.isNull() | ~lat.between(lat_min, lat_max)
                           | ~lon.between(lon_min, lon_max))


@dataclass(frozen=True)
class Check:
    name: str
    severity: str  # "error" or "warn"
    violations: DataFrame


def run_suite(checks: Sequence[Check]) -> DataFrame:
    """One row per check: name, severity, failures, status.

    The counts are computed as one union of small aggregates, i.e. one job.
    """
    out = None
    for c in checks:
        part = c.violations.agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(c.name).alias("test_name"), F.lit(c.severity).alias("severity"), "failures")
        out = part if out is None else out.unionByName(part)
    return out.withColumn("status", F.when(F.col("failures") == 0, "pass")
                          .when(F.col("severity") == "warn", "warn").otherwise("fail"))


class CheckFailed(ValueError):
    """D16 fail-fast: the first check of error severity that found rows."""


def failing_rows(checks: Sequence[Check]) -> DataFrame:
    """The failing rows themselves, as (test_name, severity, row as JSON), to be kept with the run."""
    out = None
    for c in checks:
        part = c.violations.select(F.lit(c.name).alias("test_name"), F.lit(c.severity).alias("severity"),
                                   F.to_json(F.struct("*")).alias("row"))
        out = part if out is None else out.unionByName(part)
    return out


def fail_fast(checks: Sequence[Check]) -> None:
    """Run the checks in order and stop at the first error with a failing row; warnings pass."""
    for c in checks:
        if c.severity == "error" and not c.violations.isEmpty():
            raise CheckFailed(c.name)


def seed_coverage(mapping: DataFrame, codes: DataFrame, min_keys: int = 75, min_codes: int = 30,
                  categories: Sequence[str] = C.DELAY_CATEGORIES) -> DataFrame:
    """At least ``min_keys`` real station keys and ``min_codes`` codes, every category
    used; violations as (check, detail)."""
    keys = (mapping.filter(F.col("station_key") != C.UNKNOWN_STATION[1]).agg(F.count_distinct("station_key").alias("n"))
            .filter(F.col("n") < min_keys).select(F.lit("station_keys").alias("check"), F.col("n").cast("string").alias("detail")))
    rows = codes.agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") < min_codes).select(
        F.lit("codes").alias("check"), F.col("n").cast("string").alias("detail"))
    used = codes.agg(F.collect_set("delay_category").alias("used"))  # at most the domain's few values
    unused = used.select(F.explode(F.array_except(F.array(*[F.lit(c) for c in categories]), "used")).alias("detail"))
    return keys.unionByName(rows).unionByName(unused.select(F.lit("unused_category").alias("check"), "detail"))


def reference_records(df: DataFrame, id_col: str, fields: Sequence[str]) -> DataFrame:
    """Problems of a reference table — empty table, duplicate ids, blank fields."""
    empty = df.agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == 0).select(
        F.lit("empty").alias("check"), F.lit(None).cast("string").alias("detail"))
    dups = (df.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
            .select(F.lit("duplicate_id").alias("check"), F.col(id_col).cast("string").alias("detail")))
    out = empty.unionByName(dups)
    for f in fields:
        blank = (df.filter(F.col(f).isNull() | (F.trim(F.col(f).cast("string")) == ""))
                 .select(F.lit(f"blank_{f}").alias("check"), F.col(id_col).cast("string").alias("detail")))
        out = out.unionByName(blank)
    return out


def mapping_checks(mapping: DataFrame, registry: DataFrame, occurrences: DataFrame) -> DataFrame:
    """Duplicate raw names (error), canonical stations with no raw variant (warn), and the
    share of raw occurrences that resolved to a real station (info, one row)."""
    dup = (mapping.groupBy("raw_station_name").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
           .select(F.lit("duplicate_raw_name").alias("check"), F.col("raw_station_name").alias("detail"),
                   F.lit("error").alias("severity")))
    unused = (registry.join(mapping.select("station_key").distinct(), "station_key", "left_anti")
              .select(F.lit("station_without_variant").alias("check"), F.col("station_key").alias("detail"),
                      F.lit("warn").alias("severity")))
    occ = occurrences.join(mapping, "raw_station_name", "left")
    tot = F.sum("total_occurrences")
    hit = F.sum(F.when(F.col("station_key").isNotNull() & (F.col("station_key") != C.UNKNOWN_STATION[1]),
                       F.col("total_occurrences")).otherwise(0))
    cov = occ.agg(F.lit("coverage_pct").alias("check"),
                  F.round(hit / tot * 100, 2).cast("string").alias("detail"), F.lit("info").alias("severity"))
    return dup.unionByName(unused).unionByName(cov)


def inventory(spark, expected: Sequence[str], database: str | None = None) -> DataFrame:
    """Expected tables missing from the catalog (re-aimed from a schema inventory)."""
    have = {t.name for t in spark.catalog.listTables(database)}
    return spark.createDataFrame([(t,) for t in expected if t not in have], "missing_table string")
