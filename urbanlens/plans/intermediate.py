"""Intermediate models M06-M10."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanlens.functions import columns as X

UNIONED_COLUMNS = (
    "delay_sk", "delay_date", "delay_time", "incident_timestamp", "day_of_week",
    "transit_mode", "line_code", "route", "raw_station_name", "location", "delay_code",
    "delay_minutes", "gap_minutes", "direction",
)


def delays_unioned(subway: DataFrame, bus: DataFrame, streetcar: DataFrame) -> DataFrame:
    """The three modes in one layout; absent columns become typed NULLs."""
    out = None
    for df in (subway, bus, streetcar):
        for c in UNIONED_COLUMNS:
            if c not in df.columns:
                df = df.withColumn(c, F.lit(None).cast("string"))
        df = df.select(*UNIONED_COLUMNS)
        out = df if out is None else out.unionByName(df)
    return out


def _spread_nulls(col: str):
    """The lookup key; NULL becomes a text that no key equals, different for each row."""
    return F.coalesce(F.col(col), F.concat(F.lit("\x00"), F.col("delay_sk")))


def delays_enriched(unioned: DataFrame, station_mapping: DataFrame, delay_codes: DataFrame) -> DataFrame:
    """Raw station name -> canonical (J01), code -> description (J02), date key.

    Both lookups are written reference tables (one row per raw name / per code), so the
    planner knows their size and broadcasts them below Spark's own byte threshold;
    beyond it the join is a shuffle that AQE re-plans and splits by skew. Rows without
    a name (two modes of three) or a code are spread by their own key, not gathered
    on NULL.
    """
    sm = station_mapping.select("raw_station_name", "canonical_station_name",
                                F.col("station_key").alias("station_id"))
    dc = delay_codes.select("delay_code", "delay_description", "delay_category")
    sm = sm.withColumnRenamed("raw_station_name", "_name")
    dc = dc.withColumnRenamed("delay_code", "_code")
    return (unioned.join(sm, _spread_nulls("raw_station_name") == F.col("_name"), "left")
            .join(dc, _spread_nulls("delay_code") == F.col("_code"), "left")
            .withColumn("date_key", X.date_key("delay_date"))
            .select(*UNIONED_COLUMNS, "canonical_station_name", "station_id",
                    "delay_description", "delay_category", "date_key"))


def trips_enriched(trips: DataFrame, station_ref: DataFrame) -> DataFrame:
    """Start and end station attributes (J03), trip date, date key, duration bucket."""
    ref = station_ref.select("station_id", "latitude", "longitude", "neighborhood")
    start = ref.select(F.col("station_id").alias("start_station_id"),
                       F.col("latitude").alias("start_latitude"),
                       F.col("longitude").alias("start_longitude"),
                       F.col("neighborhood").alias("start_neighborhood"))
    end = ref.select(F.col("station_id").alias("end_station_id"),
                     F.col("latitude").alias("end_latitude"),
                     F.col("longitude").alias("end_longitude"),
                     F.col("neighborhood").alias("end_neighborhood"))
    return (trips.join(start, "start_station_id", "left")
            .join(end, "end_station_id", "left")
            .withColumn("trip_date", F.to_date("start_time"))
            .withColumn("date_key", X.date_key(F.to_date("start_time")))
            .withColumn("duration_bucket", X.duration_bucket("trip_duration_seconds")))


def daily_transit(enriched: DataFrame) -> DataFrame:
    """Per-day incident rollup (A01-A03). Partial aggregation runs map-side."""
    m, mins = F.col("transit_mode"), F.col("delay_minutes")
    out = enriched.groupBy("delay_date", "date_key").agg(
        F.count(F.lit(1)).alias("total_delay_incidents"),
        F.sum(mins).alias("total_delay_minutes"),
        F.round(F.avg(mins), 2).alias("avg_delay_minutes"),
        F.sum("gap_minutes").alias("total_gap_minutes"),
        *[F.count_if(m == mode).alias(f"{mode}_delay_incidents") for mode in ("subway", "bus", "streetcar")],
        *[F.sum(F.when(m == mode, mins).otherwise(0)).alias(f"{mode}_delay_minutes")
          for mode in ("subway", "bus", "streetcar")],
    )
    return out


def daily_bike(enriched: DataFrame) -> DataFrame:
    """Per-day trip rollup."""
    u = F.col("user_type")
    return enriched.groupBy("trip_date", "date_key").agg(
        F.count(F.lit(1)).alias("total_trips"),
        F.sum("trip_duration_seconds").alias("total_duration_seconds"),
        F.round(F.avg("trip_duration_seconds"), 2).alias("avg_duration_seconds"),
        F.count_if(u == "Annual Member").alias("member_trips"),
        F.count_if(u == "Casual Member").alias("casual_trips"),
    )
