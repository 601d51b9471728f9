"""KPI derivations (A11-A25, R40): the dashboard's helper numbers as aggregates.

Each takes the (already aggregated, small) result of an analytic query and
returns a one-row (or few-row) DataFrame, so nothing is collected before
display. Formatting into text is left to the presentation layer; the numbers
are computed here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from urbanlens import config as C
from urbanlens.functions.columns import right_closed_bin


def member_share(df: DataFrame, key: str, member: str, measure: str, out: str) -> DataFrame:
    """Percent (1 dp) of ``measure`` belonging to ``key == member``; 0 when the total is 0."""
    tot = F.sum(measure)
    part = F.sum(F.when(F.col(key) == member, F.col(measure)).otherwise(0))
    return df.agg(F.when(tot > 0, F.round(part.cast("double") / tot * 100, 1))
                  .otherwise(F.lit(0.0)).alias(out))


def peak_window(hourly: DataFrame, min_records: int = C.PEAK_MIN_RECORDS) -> DataFrame:
    """The (day, hour) with most delays; NULLs when fewer than ``min_records`` in total.
    Ties go to the earliest (day number, hour)."""
    best = F.min_by(F.struct("day_of_week", "hour_of_day"),
                    F.struct(-F.col("delay_count"), F.col("day_of_week_num"), F.col("hour_of_day")))
    a = hourly.agg(F.sum("delay_count").alias("total_records"), best.alias("p"))
    ok = F.col("total_records") >= min_records
    return a.select("total_records",
                    F.when(ok, F.substring("p.day_of_week", 1, 3)).alias("peak_day"),
                    F.when(ok, F.col("p.hour_of_day")).alias("peak_hour"))


def busiest_period(timeline: DataFrame, measure: str) -> DataFrame:
    """The month with the largest ``measure`` (earliest on ties), labelled 'Month YYYY'."""
    best = F.min_by(F.struct("year", "month_name"), F.struct(-F.col(measure), "year", "month_num"))
    return timeline.agg(best.alias("p")).select(
        F.concat_ws(" ", F.col("p.month_name"), F.col("p.year").cast("string")).alias("busiest_period"))


def condition_means(daily: DataFrame, measure: str, dp: int = 0) -> DataFrame:
    """Mean of ``measure`` per weather condition, in the fixed condition order."""
    order = F.array_position(F.array(*[F.lit(c) for c in C.WEATHER_CONDITIONS]), F.col("weather_condition"))
    return (daily.groupBy("weather_condition").agg(F.round(F.avg(measure), dp).alias(f"avg_{measure}"))
            .withColumn("condition_order", order.cast("int")).orderBy("condition_order"))


def impact_vs_baseline(daily: DataFrame, measure: str, baseline: str = "Clear",
                       small_n: int = C.LIMITED_SAMPLE_N) -> DataFrame:
    """% change of the mean of ``measure`` per condition vs the baseline condition.

    ``n_days`` counts rows of the condition including NULL measures; the change
    is NULL when the baseline mean is not positive; ``limited_sample`` flags
    n_days < ``small_n``. One group-by; the baseline comes from a window over
    the (three-row) grouped result.
    """
    g = daily.groupBy("weather_condition").agg(F.avg(measure).alias("avg_value"),
                                               F.count(F.lit(1)).alias("n_days"))
    base = F.max(F.when(F.col("weather_condition") == baseline, F.col("avg_value"))).over(Window.partitionBy())
    return g.select(
        "weather_condition", "n_days", F.round("avg_value", 2).alias("avg_value"),
        F.when(base > 0, F.round((F.col("avg_value") - base) / base * 100, 1)).alias("pct_change"),
        (F.col("n_days") < small_n).alias("limited_sample"))


def temperature_sweet_spot(daily: DataFrame, measure: str = "total_bike_trips") -> DataFrame:
    """The 5-degree right-closed bin with the highest mean ``measure`` (lowest bin on ties)."""
    rows = daily.filter(F.col("mean_temp_c").isNotNull() & F.col(measure).isNotNull())
    b = rows.withColumn("bin_lo", right_closed_bin("mean_temp_c")).filter(F.col("bin_lo").isNotNull())
    g = b.groupBy("bin_lo").agg(F.avg(measure).alias("m"))
    best = g.agg(F.min_by("bin_lo", F.struct(-F.col("m"), F.col("bin_lo"))).alias("bin_lo"))
    return best.select(F.col("bin_lo").alias("peak_low_c"), (F.col("bin_lo") + C.TEMP_BIN_RANGE[2]).alias("peak_high_c"))


def first_last_change(series: DataFrame, period: str, measure: str) -> DataFrame:
    """Totals of the first and last period and the % change (NULL if first <= 0)."""
    y = series.groupBy(period).agg(F.sum(measure).alias("t"))
    a = y.agg(F.min(period).alias("first_period"), F.max(period).alias("last_period"),
              F.min_by("t", period).alias("first_total"), F.max_by("t", period).alias("last_total"),
              F.count(F.lit(1)).alias("n_periods"))
    return a.withColumn("pct_change", F.when(
        (F.col("n_periods") >= 2) & (F.col("first_total") > 0),
        F.round((F.col("last_total") - F.col("first_total")) / F.col("first_total") * 100, 0)))


def latest_share(yearly: DataFrame, part: str = "casual_trips", total: str = "total_trips") -> DataFrame:
    """Share (0 dp) of ``part`` in the most recent year; NULL when that total is 0."""
    a = yearly.agg(F.max("year").alias("year"), F.max_by(part, "year").alias("p"),
                   F.max_by(total, "year").alias("t"))
    return a.select("year", F.when(F.col("t") > 0, F.round(F.col("p") / F.col("t") * 100, 0)).alias("share_pct"))


def season_ratio(monthly: DataFrame, measure: str = "total_trips", high=(7, 8), low=(1, 2)) -> DataFrame:
    """Mean monthly ``measure`` in ``high`` months over the mean in ``low`` months (1 dp)."""
    hi = F.avg(F.when(F.col("month_num").isin(*high), F.col(measure)))
    lo = F.avg(F.when(F.col("month_num").isin(*low), F.col(measure)))
    return monthly.agg(F.when(F.coalesce(lo, F.lit(0.0)) > 0,
                              F.round(F.coalesce(hi, F.lit(0.0)) / lo, 1)).alias("season_ratio"))


def weighted_mean_minutes(yearly: DataFrame) -> DataFrame:
    """Total seconds over total trips, in minutes (0 dp)."""
    t = F.sum("total_trips")
    return yearly.agg(F.when(t > 0, F.round(F.sum("total_duration_seconds") / t / 60, 0)).alias("avg_trip_minutes"))


def rollup_parent_share(causes: DataFrame, measure: str = "incident_count") -> DataFrame:
    """Category -> description totals with each node's percent of its parent.

    ``rollup`` yields the leaves, one subtotal per category and the grand
    total; the parent value comes from a window over the (small) rollup.
    """
    r = (causes.rollup("delay_category", "delay_description")
         .agg(F.sum(measure).alias("value"), F.grouping_id().alias("level")))
    cat_total = F.max(F.when(F.col("level") == 1, F.col("value"))).over(Window.partitionBy("delay_category"))
    grand = F.max(F.when(F.col("level") == 3, F.col("value"))).over(Window.partitionBy())
    parent = F.when(F.col("level") == 0, cat_total).when(F.col("level") == 1, grand)
    return r.select("delay_category", "delay_description", "level", "value",
                    F.round(F.col("value") / parent * 100, 1).alias("pct_of_parent"))
