"""Mart models M11-M17 and the reference tables they are built from.

Column lists follow the source models' select lists, not the diagram in the
source documentation where the two disagree (Q21).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanlens import config as C
from urbanlens.functions import columns as X
from urbanlens.operators import calendar as K
from urbanlens.operators.dedup import keep_first
from urbanlens.operators.resolve import neighbourhood


def station_ref_from_feed(feed: DataFrame, cfg: C.MobilityConfig = C.DEFAULT,
                          order_col: str | None = None) -> DataFrame:
    """S07 core: positive integer id, inside the bbox, first row per id, 6-dp coordinates.

    ``order_col`` is the position of the station in the feed (first one wins);
    without it the smallest name wins.
    """
    lat_min, lat_max, lon_min, lon_max = cfg.bbox
    sid = F.col("station_id").cast("string").try_cast("int")
    f = (feed.withColumn("station_id", sid)
         .filter((F.col("station_id") > 0)
                 & F.col("lat").between(lat_min, lat_max) & F.col("lon").between(lon_min, lon_max)))
    f = keep_first(f, ["station_id"], [order_col] if order_col else ["name"])
    return f.select(
        "station_id", F.col("name").alias("station_name"),
        F.col("lat").cast("decimal(10,6)").alias("latitude"),
        F.col("lon").cast("decimal(10,6)").alias("longitude"),
        neighbourhood("groups").alias("neighborhood"))


def dim_station(station_mapping: DataFrame, coords: DataFrame, bike_ref: DataFrame) -> DataFrame:
    """Subway stations (P27 distinct canonical names, J04 left join to coordinates, P18 casts)
    and bike stations (P19 id as text), stacked (U02)."""
    ttc = station_mapping.select(F.col("station_key").alias("station_id"),
                                 F.col("canonical_station_name").alias("station_name")).distinct()
    co = coords.select("canonical_station_name",
                       F.col("latitude").cast("decimal(10,6)").alias("latitude"),
                       F.col("longitude").cast("decimal(10,6)").alias("longitude"))
    # coordinates: one row per registry station (bounded by the registry)
    ttc_dim = (ttc.join(F.broadcast(co), ttc.station_name == co.canonical_station_name, "left")
               .select(X.surrogate_key(F.lit("TTC_SUBWAY"), "station_id").alias("station_key"),
                       "station_id", "station_name", F.lit("TTC_SUBWAY").alias("station_type"),
                       "latitude", "longitude", F.lit(None).cast("string").alias("neighborhood")))
    bike_dim = bike_ref.select(
        X.surrogate_key(F.lit("BIKE_SHARE"), F.col("station_id").cast("string")).alias("station_key"),
        F.col("station_id").cast("string").alias("station_id"), "station_name",
        F.lit("BIKE_SHARE").alias("station_type"),
        F.col("latitude").cast("decimal(10,6)").alias("latitude"),
        F.col("longitude").cast("decimal(10,6)").alias("longitude"), "neighborhood")
    return ttc_dim.unionByName(bike_dim)


def dim_weather(stg_weather: DataFrame) -> DataFrame:
    """Weather by date key with a condition label."""
    w = stg_weather
    return w.select(
        X.date_key("weather_date").alias("date_key"), "weather_date", "mean_temp_c", "max_temp_c",
        "min_temp_c", "total_precip_mm", "total_rain_mm", "total_snow_cm", "snow_on_ground_cm",
        "max_wind_gust_kmh", "max_wind_gust_dir_deg",
        X.weather_condition("total_snow_cm", "total_rain_mm").alias("weather_condition"))


def dim_delay_codes(codes: DataFrame) -> DataFrame:
    """Surrogate key over the classified codes."""
    return codes.select(X.surrogate_key("delay_code").alias("delay_code_key"), "delay_code",
                        "delay_description", "delay_category")


def fct_transit_delays(enriched: DataFrame) -> DataFrame:
    """Re-keyed incident fact (P09); station key only for mapped subway rows, code key for
    any code, even one missing from the code table (P10, Q10)."""
    e = enriched
    return e.select(
        X.surrogate_key("transit_mode", "delay_sk").alias("delay_sk"), "date_key",
        X.conditional_key((F.col("transit_mode") == "subway") & F.col("station_id").isNotNull(),
                          F.lit("TTC_SUBWAY"), "station_id").alias("station_key"),
        X.conditional_key(F.col("delay_code").isNotNull(), "delay_code").alias("delay_code_key"),
        "delay_minutes", "gap_minutes", "transit_mode", "line_code", "direction", "incident_timestamp")


def fct_bike_trips(enriched: DataFrame) -> DataFrame:
    """Trip fact; station keys only where the station lookup hit, tested by latitude (Q11);
    ids are cast to text before hashing so both sides agree (Q12)."""
    s_id = F.col("start_station_id").cast("string")
    e_id = F.col("end_station_id").cast("string")
    return enriched.select(
        "trip_sk", "date_key",
        X.conditional_key(F.col("start_latitude").isNotNull(), F.lit("BIKE_SHARE"), s_id)
        .alias("start_station_key"),
        X.conditional_key(F.col("end_latitude").isNotNull(), F.lit("BIKE_SHARE"), e_id)
        .alias("end_station_key"),
        F.col("trip_duration_seconds").alias("duration_seconds"), "user_type", "bike_id",
        "start_time", "end_time")


TRANSIT_DAILY = ("total_delay_incidents", "total_delay_minutes", "avg_delay_minutes",
                 "total_gap_minutes", "subway_delay_incidents", "bus_delay_incidents",
                 "streetcar_delay_incidents", "subway_delay_minutes", "bus_delay_minutes",
                 "streetcar_delay_minutes")


def fct_daily_mobility(transit: DataFrame, bike: DataFrame) -> DataFrame:
    """Full outer join on the date key (J05); the absent side stays NULL (Q16).

    Both inputs are already one row per day, so this join shuffles two small
    frames (days x measures), not the facts.
    """
    t = transit.select("date_key", *TRANSIT_DAILY).withColumnRenamed("date_key", "t_key")
    b = bike.select(F.col("date_key").alias("b_key"),
                    F.col("total_trips").alias("total_bike_trips"),
                    F.col("total_duration_seconds").alias("total_bike_duration_seconds"),
                    F.col("avg_duration_seconds").alias("avg_bike_duration_seconds"),
                    "member_trips", "casual_trips")
    j = t.join(b, t.t_key == b.b_key, "full")
    return j.select(F.coalesce("t_key", "b_key").alias("date_key"), *TRANSIT_DAILY,
                    "total_bike_trips", "total_bike_duration_seconds", "avg_bike_duration_seconds",
                    "member_trips", "casual_trips")


def dim_date_over(*date_frames: tuple[DataFrame, str]) -> DataFrame:
    """M11 on a spine of whole years covering every given date column (P17 typed attributes).

    The bounds are two scalars (one aggregate job); the spine is then built
    from them, so the calendar never re-reads the facts.
    """
    u = None
    for df, col in date_frames:
        part = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
        u = part if u is None else u.unionByName(part)
    lo, hi = u.agg(F.min("lo"), F.max("hi")).first()
    spark = u.sparkSession
    return K.dim_date(K.spine_between(spark, f"{lo.year}-01-01", f"{hi.year}-12-31"))
