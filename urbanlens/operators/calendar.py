"""Date spine and holiday calendar.

The spine is one row per day between two dates: its size is bounded by the
calendar (366 rows a year), never by the fact data, so it is safe to broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from urbanlens import config as C
from urbanlens.functions.columns import date_key


def date_spine(bounds: DataFrame, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """Inclusive daily rows for each (start, end) row of ``bounds``."""
    return bounds.select(
        F.explode(F.sequence(F.col(start), F.col(end), F.expr("interval 1 day"))).alias("full_date"))


def spine_between(spark: SparkSession, start: str, end: str) -> DataFrame:
    bounds = spark.range(1).select(F.to_date(F.lit(start)).alias("start_date"),
                                   F.to_date(F.lit(end)).alias("end_date"))
    return date_spine(bounds)



def iso_weekday(d: Column) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return F.weekday(d) + 1


def spine_attributes(spine: DataFrame, d: str = "full_date") -> DataFrame:
    """Key, names, ISO weekday, month, quarter, year, weekend flag."""
    c = F.col(d)
    return spine.select(
        date_key(c).alias("date_key"), c.alias("full_date"),
        F.date_format(c, "EEEE").alias("day_of_week"),
        iso_weekday(c).alias("day_of_week_num"),
        F.month(c).alias("month_num"),
        F.date_format(c, "MMMM").alias("month_name"),
        F.quarter(c).alias("quarter"), F.year(c).alias("year"),
        (iso_weekday(c) >= 6).alias("is_weekend"),
    )


def nth_monday(year: Column, month: int, n: int) -> Column:
    """N-th Monday of a month."""
    first = F.make_date(year, F.lit(month), F.lit(1))
    return F.date_add(F.next_day(F.date_sub(first, 1), "Mon"), 7 * (n - 1))


def monday_on_or_before(year: Column, month: int, day: int) -> Column:
    """The Monday on or before a date."""
    d = F.make_date(year, F.lit(month), F.lit(day))
    return F.date_sub(d, F.weekday(d))


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter Sunday by the anonymous (Meeus/Jones/Butcher) computus."""
    y = year.cast("int")
    a = y % 19
    b = F.floor(y / 100).cast("int")
    c = y % 100
    d = F.floor(b / 4).cast("int")
    e = b % 4
    f = F.floor((b + 8) / 25).cast("int")
    g = F.floor((b - f + 1) / 3).cast("int")
    h = (19 * a + b - d - g + 15) % 30
    i = F.floor(c / 4).cast("int")
    k = c % 4
    el = (32 + 2 * e + 2 * i - h - k) % 7
    m = F.floor((a + 11 * h + 22 * el) / 451).cast("int")
    t = h + el - 7 * m + 114
    return F.make_date(y, F.floor(t / 31).cast("int"), (t % 31) + 1)


def holidays(years: DataFrame, year_col: str = "year") -> DataFrame:
    """The nine statutory holidays of each year in ``years``."""
    y = F.col(year_col)
    parts = []
    for name, month, rule, arg in C.HOLIDAYS:
        if rule == "fixed":
            d = F.make_date(y, F.lit(month), F.lit(arg))
        elif rule == "nth_monday":
            d = nth_monday(y, month, arg)
        elif rule == "easter":
            d = F.date_add(easter_sunday(y), arg)
        else:
            d = monday_on_or_before(y, month, arg)
        parts.append(F.struct(F.lit(name).alias("holiday_name"), d.alias("holiday_date")))
    return (years.select(F.explode(F.array(*parts)).alias("h"))
            .select("h.holiday_name", "h.holiday_date"))


def dim_date(spine: DataFrame, d: str = "full_date") -> DataFrame:
    """Spine attributes + holiday flag (left join on a year-bounded holiday set)."""
    attrs = spine_attributes(spine, d)
    hol = holidays(attrs.select("year").distinct()).select(
        F.col("holiday_date").alias("full_date"), F.lit(True).alias("_hol")).distinct()
    return (attrs.join(F.broadcast(hol), "full_date", "left")
            .withColumn("is_holiday", F.coalesce(F.col("_hol"), F.lit(False)))
            .select("date_key", "full_date", "day_of_week", "day_of_week_num", "month_num",
                    "month_name", "quarter", "year", "is_weekend", "is_holiday"))


def contiguity(dim: DataFrame, d: str = "full_date") -> DataFrame:
    """One summary row: rows, first, last, expected rows, gaps, duplicates.

    The gap count compares each date with its predecessor; the window has no
    partition, which is fine because the input is a calendar (bounded size).
    """
    w = Window.orderBy(d)
    prev = dim.select(F.col(d), F.lag(d).over(w).alias("prev"))
    return prev.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(d).alias("first_date"), F.max(d).alias("last_date"),
        (F.datediff(F.max(d), F.min(d)) + 1).alias("expected_rows"),
        F.sum(F.when(F.datediff(F.col(d), F.col("prev")) > 1, 1).otherwise(0)).alias("gaps"),
        F.sum(F.when(F.datediff(F.col(d), F.col("prev")) == 0, 1).otherwise(0)).alias("duplicates"),
    )
