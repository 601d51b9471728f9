"""Staging models M01-M05: raw text -> typed, filtered, deduplicated rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanlens.config import DEFAULT, MobilityConfig
from urbanlens.functions import columns as X
from urbanlens.operators.dedup import keep_first

SUBWAY_KEY = ("date", "time", "station", "line", "code", "min_delay")
SURFACE_KEY = ("date", "time", "route", "direction", "delay_code", "min_delay")


def stg_subway(raw: DataFrame) -> DataFrame:
    """Positive delays (P21), typed (P01, P03, P05), renamed (P06), literal mode (P07),
    one row per natural key (W01)."""
    src = raw.filter(X.safe_int("min_delay") > 0)
    src = keep_first(src, SUBWAY_KEY)
    return src.select(
        X.surrogate_key(*SUBWAY_KEY).alias("delay_sk"),
        X.strict_date("date").alias("delay_date"),
        X.time_text("time").alias("delay_time"),
        X.timestamp_from_parts(X.strict_date("date"), F.col("time")).alias("incident_timestamp"),
        F.col("day").alias("day_of_week"),
        F.col("station").alias("raw_station_name"),
        F.col("code").alias("delay_code"),
        X.safe_int("min_delay").alias("delay_minutes"),
        X.safe_int("min_gap").alias("gap_minutes"),
        F.col("bound").alias("direction"),
        F.col("line").alias("line_code"),
        F.lit("subway").alias("transit_mode"),
    )


def stg_surface(raw: DataFrame, mode: str) -> DataFrame:
    """Bus and streetcar share one shape; only the literal differs."""
    src = raw.filter(X.safe_int("min_delay") > 0)
    src = keep_first(src, SURFACE_KEY)
    return src.select(
        X.surrogate_key(*SURFACE_KEY).alias("delay_sk"),
        X.strict_date("date").alias("delay_date"),
        X.time_text("time").alias("delay_time"),
        X.timestamp_from_parts(X.strict_date("date"), F.col("time")).alias("incident_timestamp"),
        F.col("day").alias("day_of_week"),
        "route", "location", "delay_code",
        X.safe_int("min_delay").alias("delay_minutes"),
        X.safe_int("min_gap").alias("gap_minutes"),
        "direction",
        F.lit(mode).alias("transit_mode"),
    )


def stg_trips(raw: DataFrame, cfg: MobilityConfig = DEFAULT) -> DataFrame:
    """Trips of at least a minute with a parseable start (P22; no dedup here, Q26)."""
    fmt = cfg.trip_time_format
    src = raw.filter((X.safe_int("trip_duration") >= cfg.min_trip_seconds)
                     & X.safe_timestamp("start_time", fmt).isNotNull())
    return src.select(
        X.surrogate_key("trip_id").alias("trip_sk"),
        "trip_id",
        X.safe_int("trip_duration").alias("trip_duration_seconds"),
        X.safe_int("start_station_id").alias("start_station_id"),
        X.safe_timestamp("start_time", fmt).alias("start_time"),
        "start_station_name",
        X.safe_int("end_station_id").alias("end_station_id"),
        X.safe_timestamp("end_time", fmt).alias("end_time"),
        "end_station_name",
        X.safe_int("bike_id").alias("bike_id"),
        "user_type",
    )


WEATHER_MEASURES = (
    ("max_temp_c", "max_temp_c"), ("min_temp_c", "min_temp_c"), ("mean_temp_c", "mean_temp_c"),
    ("heat_deg_days_c", "heat_degree_days"), ("cool_deg_days_c", "cool_degree_days"),
    ("total_rain_mm", "total_rain_mm"), ("total_snow_cm", "total_snow_cm"),
    ("total_precip_mm", "total_precip_mm"), ("snow_on_grnd_cm", "snow_on_ground_cm"),
    ("spd_of_max_gust_kmh", "max_wind_gust_kmh"),
)


def stg_weather(raw: DataFrame) -> DataFrame:
    """One row per day, decimals by safe cast."""
    return raw.select(
        X.surrogate_key("date_time").alias("weather_sk"),
        X.strict_date("date_time").alias("weather_date"),
        *[X.safe_decimal(src).alias(dst) for src, dst in WEATHER_MEASURES],
        X.safe_int("dir_of_max_gust_10s_deg").alias("max_wind_gust_dir_deg"),
    )
