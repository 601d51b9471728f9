"""Role frames for the mobility pipeline, derived from the driver's tables.

The driver ships TPC-H-like tables, not transit feeds. These adapters turn
them, deterministically and with work proportional to the inputs, into the raw
string tables and reference tables the pipeline expects:

* incidents  <- events (one row each) + orders (one row each), re-delivered
  copies of every 50th record, station names in several spellings
* trips      <- lineitem (one row each)
* weather    <- orders grouped by order day
* bike feed  <- supplier x nation (nation is a 25-row dimension)
* subway registry / coordinates <- nation

``oracle/duckdb_sql.py`` repeats the same derivations in DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlens.functions.columns import format_ntz
from urbanlens.session import read_table

# --- fixed values of the adapter (test-bed only) ---------------------------
# line by nation region key 0..4
REGION_LINES = ("YU", "BD", "SHP", "SRT", "YU/BD")
# delay-code prefix by nation key % 10, suffix by record id % 6
CODE_PREFIXES = ("MU", "PU", "SU", "EU", "TU", "MR", "PR", "SR", "ER", "TR", "MF", "PF", "SF", "EF", "TF",
                 "MT", "PT", "ST", "ET", "TT", "NT")
CODE_SUFFIXES = ("SC", "DDX", "O", "WEA", "ATC", "XQ")
# self-describing codes used by bus/streetcar, by nation key % 6
TEXT_CODES = ("Mechanical", "Diversion", "Late", "Security", "Vision", "General Delay")
BOUNDS = ("N", "S", "E", "W")
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
# spelling of a station name by record id % 8 (id % 16 == 7 names no station)
STATION_PREFIXES = ("", "", "", "", "APPROACHING ", "", "", "NEAR ")
STATION_SUFFIXES = ("", " STATION", " STN", " TO KIPLING", "", " YARD", " BD", " PLATFORM")
# suffix descriptions supplied as the code reference table of the test bed
SUFFIX_DESCRIPTIONS = (
    ("ATC", "Automatic Train Control Fault"),
    ("D", "Door Malfunction"),
    ("DD", "Door Delay"),
    ("O", "Other"),
    ("SC", "Speed Control Restriction"),
    ("WEA", "Weather"),
)
DESCRIPTION_OVERRIDES = (("PUO", "Passenger Other"),)
# other core names of stations, in their own order; one name stands for two stations
STATION_ALIASES = (("LEVEL 3", "ST_004"), ("TRACK LEVEL 5", "ST_007"), ("LEVEL 5", "ST_009"), ("LEVEL 8", "ST_016"), ("LEVEL 8", "ST_015"))
ALIAS_ORDINAL = 1000
STATION_OVERRIDES = (("NATION_3 YARD", "ST_010", "BD"),)
REDELIVERY_EVERY = 50


def _pick(values: tuple, index: Column) -> Column:
    """values[index] for a 0-based integer column (NULL past the end)."""
    return F.try_element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _hm(ts: Column, hours: Column, minutes: Column) -> Column:
    return ts + F.make_dt_interval(F.lit(0), hours.cast("int"), minutes.cast("int"), F.lit(0))


def incident_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One typed record per incident before it is rendered as text."""
    ev = read_table(spark, sf_dir, "events").select(
        F.col("event_id").alias("rid"),
        (F.col("event_id") * 2).alias("src_id"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        (F.col("user_id") % 25).cast("int").alias("nat"),
        (F.floor("value") % 90).cast("int").alias("delay"),
        F.get_json_object("props", "$.k").cast("int").alias("gap"),
    )
    od = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("rid"),
        (F.col("o_orderkey") * 2 + 1).alias("src_id"),
        _hm(F.col("o_orderdate").cast("timestamp_ntz"), F.col("o_custkey") % 24,
            F.col("o_orderkey") % 60).alias("ts"),
        (F.col("o_custkey") % 25).cast("int").alias("nat"),
        (F.col("o_orderkey") % 120).cast("int").alias("delay"),
        (F.col("o_custkey") % 60).cast("int").alias("gap"),
    )
    base = ev.unionByName(od).withColumn(
        "gap", F.when(F.col("rid") % 10 != 0, F.col("gap")))
    # every REDELIVERY_EVERY-th record arrives a second time with another gap value;
    # generated in the same scan (explode), not by a second pass over the sources
    copies = F.explode(F.when(F.col("rid") % REDELIVERY_EVERY == 0, F.array(F.lit(0), F.lit(1)))
                       .otherwise(F.array(F.lit(0))))
    rec = base.select("*", copies.alias("_copy"))
    return rec.withColumn("gap", F.when(F.col("_copy") == 1, F.coalesce(F.col("gap"), F.lit(0)) + 1)
                          .otherwise(F.col("gap"))).drop("_copy")


def raw_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All incidents as landed text, with a ``transit_mode`` column."""
    nation = read_table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("nat"), F.col("n_name"), F.col("n_regionkey"))
    rec = incident_records(spark, sf_dir).join(F.broadcast(nation), "nat")
    rid, name = F.col("rid"), F.col("n_name")
    mode = _pick(("subway", "bus", "streetcar"), F.col("src_id") % 3)
    day = format_ntz("ts", "yyyy-MM-dd")
    variant = rid % 16
    station = F.when(variant == 7, F.concat(F.lit("TRACK LEVEL "), (rid % 9).cast("string"))).otherwise(
        F.concat(_pick(STATION_PREFIXES, variant % 8), name, _pick(STATION_SUFFIXES, variant % 8)))
    code = (
        F.when(rid % 13 == 0, F.lit(None).cast("string"))
        .when((mode != "subway") & (rid % 9 == 4), _pick(TEXT_CODES, F.col("nat") % 6))
        .otherwise(F.concat(_pick(CODE_PREFIXES, F.col("nat") % 21),
                            _pick(CODE_SUFFIXES, rid % 6))))
    min_delay = (
        F.when(rid % 97 == 0, F.lit("abc"))
        .when(rid % 7 == 0, F.concat(F.col("delay").cast("string"), F.lit(".0")))
        .otherwise(F.col("delay").cast("string")))
    return rec.select(
        mode.alias("transit_mode"),
        F.when(rid % 11 == 0, F.concat(day, F.lit(" 00:00:00"))).otherwise(day).alias("date"),
        format_ntz("ts", "HH:mm").alias("time"),
        _pick(WEEKDAYS, F.weekday("ts")).alias("day"),
        station.alias("station"),
        name.alias("location"),
        ((rid % 40) + 1).cast("string").alias("route"),
        code.alias("code"),
        min_delay.alias("min_delay"),
        F.col("gap").cast("string").alias("min_gap"),
        _pick(BOUNDS, rid % 5).alias("bound"),
        _pick(REGION_LINES, F.col("n_regionkey")).alias("line"),
    )


def raw_subway(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (raw_incidents(spark, sf_dir).filter(F.col("transit_mode") == "subway")
            .select("date", "time", "day", "station", "code", "min_delay", "min_gap",
                    "bound", "line"))


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    start = _hm(F.col("l_shipdate").cast("timestamp_ntz"), F.col("l_partkey") % 24,
                F.col("l_orderkey") % 60)
    duration = ((F.col("l_quantity") - 1) * 75).cast("int")
    end = start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), duration)
    end_id = F.col("l_partkey") % 120
    return li.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"),
                    F.col("l_linenumber").cast("string")).alias("trip_id"),
        duration.cast("string").alias("trip_duration"),
        F.col("l_suppkey").cast("string").alias("start_station_id"),
        F.when(F.col("l_orderkey") % 101 == 0, format_ntz(start, "yyyy-MM-dd HH:mm"))
        .otherwise(format_ntz(start, "M/d/yyyy H:mm")).alias("start_time"),
        F.concat(F.lit("Station "), F.col("l_suppkey").cast("string")).alias("start_station_name"),
        end_id.cast("string").alias("end_station_id"),
        format_ntz(end, "M/d/yyyy H:mm").alias("end_time"),
        F.concat(F.lit("Station "), end_id.cast("string")).alias("end_station_name"),
        F.col("l_partkey").cast("string").alias("bike_id"),
        F.when(F.col("l_returnflag") == "N", F.lit("Casual Member"))
        .otherwise(F.lit("Annual Member")).alias("user_type"),
    )


def raw_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order day, measures from key sums (as landed text)."""
    o = read_table(spark, sf_dir, "orders")
    d = F.to_date("o_orderdate")
    daily = o.groupBy(d.alias("d")).agg(
        F.sum("o_custkey").alias("sc"), F.sum("o_orderkey").alias("so"),
        F.count(F.lit(1)).alias("n"))
    winter = F.month("d").isin(12, 1, 2, 3)

    def tenths(x: Column) -> Column:
        return (x.cast("decimal(20,0)") / F.lit(10)).cast("decimal(10,1)").cast("string")

    mean_t = (F.col("sc") % 600) - 200
    rain = F.when(F.col("so") % 7 < 4, F.lit(0)).otherwise(F.col("so") % 90)
    snow = F.when(winter, (F.col("sc") % 4) * 15).otherwise(F.lit(0))
    return daily.select(
        F.date_format("d", "yyyy-MM-dd").alias("date_time"),
        tenths(mean_t + F.col("n") % 8 * 10).alias("max_temp_c"),
        tenths(mean_t - F.col("n") % 6 * 10).alias("min_temp_c"),
        F.when(F.dayofmonth("d") != 13, tenths(mean_t)).alias("mean_temp_c"),
        tenths(F.greatest(F.lit(180) - mean_t, F.lit(0))).alias("heat_deg_days_c"),
        tenths(F.greatest(mean_t - F.lit(180), F.lit(0))).alias("cool_deg_days_c"),
        F.when(F.dayofmonth("d") != 7, tenths(rain)).alias("total_rain_mm"),
        F.when(F.dayofmonth("d") != 7, tenths(snow)).alias("total_snow_cm"),
        F.when(F.dayofmonth("d") != 21, tenths(rain + snow)).alias("total_precip_mm"),
        tenths(snow * 2).alias("snow_on_grnd_cm"),
        F.when(F.col("n") % 3 == 0, F.lit("<31"))
        .otherwise(tenths(F.col("so") % 900)).alias("spd_of_max_gust_kmh"),
        ((F.col("sc") % 36) * 10).cast("string").alias("dir_of_max_gust_10s_deg"),
    )


def _micro(x: Column) -> Column:
    """Micro-degrees to decimal(10,6), exactly."""
    return (x.cast("decimal(20,0)") / F.lit(1000000)).cast("decimal(10,6)")


def bike_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station feed rows (id, name, lat, lon, groups) as the feed would carry them."""
    s = read_table(spark, sf_dir, "supplier")
    nation = read_table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"), "n_name")
    k = F.col("s_suppkey")
    lat = F.when(k % 23 == 11, F.lit(43900000)).otherwise(
        F.lit(43600000) + (k % 25) * 10000 + (k % 7) * 1000)
    lon = F.lit(-79600000) + (k % 40) * 12000
    groups = (
        F.when(k % 5 == 0, F.array(F.lit("E-Charging"), F.lit("West ")))
        .when(k % 5 == 1, F.array().cast("array<string>"))
        .otherwise(F.array(F.concat(F.lit(" "), F.col("n_name"), F.lit(" ")), F.lit("North"))))
    return s.join(F.broadcast(nation), "s_nationkey").select(
        k.cast("string").alias("station_id"),
        F.col("s_name").alias("name"),
        _micro(lat).cast("double").alias("lat"),
        _micro(lon).cast("double").alias("lon"),
        groups.alias("groups"),
    )


def subway_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical subway stations: (station_key, canonical_station_name, line_code, ordinal)."""
    n = read_table(spark, sf_dir, "nation")
    return n.select(
        F.concat(F.lit("ST_"), F.lpad((F.col("n_nationkey") + 1).cast("string"), 3, "0"))
        .alias("station_key"),
        F.col("n_name").alias("canonical_station_name"),
        _pick(("YU", "BD", "SHP", "SRT", "YU"), F.col("n_regionkey")).alias("line_code"),
        F.col("n_nationkey").cast("int").alias("ordinal"),
    )


def subway_coords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seed of station coordinates; the last nation has none."""
    n = read_table(spark, sf_dir, "nation").filter(F.col("n_nationkey") < 24)
    return n.select(
        F.col("n_name").alias("canonical_station_name"),
        (F.col("n_regionkey") + 1).alias("line_number"),
        _micro(F.lit(43640000) + F.col("n_nationkey") * 5000).alias("latitude"),
        _micro(F.lit(-79500000) + F.col("n_regionkey") * 20000).alias("longitude"),
    )


def station_lookup(registry: DataFrame) -> DataFrame:
    """The core names of the stations: their canonical names and, behind them in order, aliases."""
    spark = registry.sparkSession
    aliases = spark.createDataFrame([(a, k, i) for i, (a, k) in enumerate(STATION_ALIASES, ALIAS_ORDINAL)],
                                    "core_name string, station_key string, ordinal int")
    aliases = aliases.join(registry.select("station_key", "line_code"), "station_key")
    return registry.select(F.col("canonical_station_name").alias("core_name"), "station_key", "line_code", "ordinal").unionByName(
        aliases.select("core_name", "station_key", "line_code", "ordinal"))


def station_overrides(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(STATION_OVERRIDES),
                                 "raw_station_name string, station_key string, line_code string")


def suffix_descriptions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(SUFFIX_DESCRIPTIONS), "suffix string, description string")


def description_overrides(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(DESCRIPTION_OVERRIDES), "delay_code string, description string")
