"""Registered checks for sources, sinks, contracts, upsert and streaming.

Each writes data that Spark derives from the given tables into the shared
folder (``spark.checkpoint.dir``) in the format under test, reads it back
with the operator, and returns the result, so the check covers the whole
round trip and its work grows with the tables.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from urbanlens import config as C
from urbanlens.operators import upsert as U
from urbanlens.operators.keyed import KeyedTable
from urbanlens.operators.ledger import FileLedger
from urbanlens.plans import publish as PUB
from urbanlens.plans import testbed as T
from urbanlens.plans.warehouse import Warehouse
from urbanlens.session import shared_dir
from urbanlens.sources import binary as B
from urbanlens.sources import contracts as V
from urbanlens.sources import delimited as D
from urbanlens.sources import feeds as FD
from urbanlens.streaming import incremental as ST

SUBWAY_FILE_HEADER = ("Date", "Time", "Day", "Station", "Code", "Min Delay", "Min Gap", "Bound", "Line")
BUS_FILE_HEADER = ("Date", "Route", "Time", "Day", "Location", "Incident", "Min Delay", "Min Gap", "Direction")
STREETCAR_FILE_HEADER = ("Date", "Line", "Time", "Day", "Location", "Incident", "Min Delay", "Min Gap", "Bound")
MERGE_BUCKETS = 16
MERGE_TARGET_BEFORE = dt.datetime(1998, 1, 1)
MERGE_SOURCE_FROM = dt.datetime(1997, 1, 1)


def _scratch(spark, name: str) -> str:
    return shared_dir(spark, f"runs/{name}-{uuid.uuid4().hex[:12]}")


def s01_read_delimited(spark, sf_dir):
    """All incidents, delivered in files of two header orders and spellings."""
    raw = T.raw_subway(spark, sf_dir)
    path = _scratch(spark, "s01")
    first = F.pmod(F.xxhash64(*raw.columns), F.lit(2)) == 0
    raw.filter(first).write.option("header", True).option("nullValue", "NULL").csv(f"{path}/a")
    turned = raw.select(*[F.col(c).alias(c.upper()) for c in reversed(raw.columns)])
    turned.filter(~first).write.option("header", True).option("nullValue", "NULL").csv(f"{path}/b")
    return D.read_delimited(spark, path, columns=raw.columns, recursive=True)


def s15_drift(spark, sf_dir):
    """Bus incidents whose files from the drift year on use other names and another order."""
    raw = Warehouse(spark, sf_dir).raw_bus.toDF(*BUS_FILE_HEADER)
    path = _scratch(spark, "s15")
    late = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in raw.columns]), F.lit(3)) == 0
    old_name = {new: old for old, new in C.BUS_DRIFT_RENAMES.items()}
    raw.filter(~late).write.option("header", True).csv(f"{path}/{C.DRIFT_YEAR - 1}")
    drifted = raw.select(*[F.col(f"`{c}`").alias(old_name.get(c, c)) for c in sorted(raw.columns)])
    drifted.filter(late).write.option("header", True).csv(f"{path}/{C.DRIFT_YEAR}")
    return D.read_delimited(spark, path, columns=BUS_FILE_HEADER, recursive=True, renames=C.BUS_DRIFT_RENAMES,
                            rename_from_year=C.DRIFT_YEAR)


def s10_path_year(spark, sf_dir):
    raw = T.raw_subway(spark, sf_dir)
    path = _scratch(spark, "s10")
    raw.withColumn("year", F.substring("date", 1, 4)).write.partitionBy("year").option("header", True).csv(path)
    df = D.read_delimited(spark, path, columns=raw.columns, with_path=True)
    return D.filter_min_year(df, 2020).withColumn("path_year", D.path_year()).drop("file_path")


def s14_copy_counts(spark, sf_dir):
    raw = T.raw_trips(spark, sf_dir)
    path = _scratch(spark, "s14")
    raw.write.option("header", True).csv(path)
    return D.copy_report(D.copy_positional(spark, path, raw.columns, fail_fast=False))


def _merge_inputs(spark, sf_dir):
    trips = Warehouse(spark, sf_dir).stg_trips
    # wall-clock literals as timestamp_ntz, independent of any time zone
    before = F.lit(MERGE_TARGET_BEFORE.isoformat(sep=" ")).cast("timestamp_ntz")
    since = F.lit(MERGE_SOURCE_FROM.isoformat(sep=" ")).cast("timestamp_ntz")
    target = (trips.filter(F.col("start_time") < before)
              .withColumn("trip_duration_seconds", F.lit(0)))
    source = trips.filter(F.col("start_time") >= since)
    return target, source


def _merged(spark, sf_dir):
    target, source = _merge_inputs(spark, sf_dir)
    table = KeyedTable.create(target, _scratch(spark, "s18"), ["trip_id"], MERGE_BUCKETS)
    return table, table.merge(source)


def s18_merge(spark, sf_dir):
    """Trips merged into a table divided by key."""
    return _merged(spark, sf_dir)[0].read()


def s18b_merge_stats(spark, sf_dir):
    """Rows that merge has inserted and updated, counted as they were written."""
    result = _merged(spark, sf_dir)[1]
    return spark.createDataFrame([(result.inserted, result.updated)], "inserted long, updated long")


def s20_publish(spark, sf_dir):
    base = _scratch(spark, "s20")
    PUB.publish_marts(Warehouse(spark, sf_dir), base)
    return spark.read.parquet(PUB.current_version(spark, base)["fct_daily_mobility"])


def delivered(wh: Warehouse) -> dict:
    """The five datasets under their contracts' headers."""
    weather = dict(zip(("date_time", "mean_temp_c", "total_precip_mm", "snow_on_grnd_cm", "spd_of_max_gust_kmh"),
                       V.CONTRACTS["weather_daily"].names))
    return {
        "subway_delays": wh.raw_subway.toDF(*SUBWAY_FILE_HEADER), "bus_delays": wh.raw_bus.toDF(*BUS_FILE_HEADER),
        "streetcar_delays": wh.raw_streetcar.toDF(*STREETCAR_FILE_HEADER),
        "bike_trips": wh.raw_trips.toDF(*V.CONTRACTS["bike_trips"].names),
        "weather_daily": wh.raw_weather.select(*[F.col(k).alias(v) for k, v in weather.items()])}


def v04_types(spark, sf_dir):
    """The five datasets, written with their contracts' headers, against the contracts."""
    base, out = _scratch(spark, "v04"), None
    for name, raw in delivered(Warehouse(spark, sf_dir)).items():
        raw.write.option("header", True).csv(f"{base}/{name}")
        v = V.validate(spark, f"{base}/{name}", V.CONTRACTS[name]).filter(F.col("check") != "min_row_count")  # V06 follows the split into files
        part = v.groupBy("check", "column_name", "severity").agg(F.min("value").alias("value"), F.sum("n_rows").alias("n_rows"))
        part = part.withColumn("dataset", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def v05_nulls(spark, sf_dir):
    """Null values of each contract column of the five datasets, over all their files."""
    base, out = _scratch(spark, "v05"), None
    for name, raw in delivered(Warehouse(spark, sf_dir)).items():
        raw.write.option("header", True).csv(f"{base}/{name}")
        df = D.read_delimited(spark, f"{base}/{name}", with_path=True, null_tokens=())
        part = V.null_profile(df, V.CONTRACTS[name]).withColumn("dataset", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def v10_reconcile(spark, sf_dir):
    """Rows of the delivered files against rows of the landed tables."""
    wh, base = Warehouse(spark, sf_dir), _scratch(spark, "v10")
    src, loaded = [], []
    for name, landed in (("subway", wh.raw_subway), ("bus", wh.raw_bus), ("streetcar", wh.raw_streetcar), ("trips", wh.raw_trips)):
        landed.write.option("header", True).csv(f"{base}/{name}")
        files = D.read_delimited(spark, f"{base}/{name}", columns=landed.columns)
        src.append(files.agg(F.lit(name).alias("dataset"), F.count(F.lit(1)).alias("source_rows")))
        loaded.append(landed.agg(F.lit(name).alias("dataset"), F.count(F.lit(1)).alias("loaded_rows")))
    s, l_ = src[0], loaded[0]
    for a, b in zip(src[1:], loaded[1:]):
        s, l_ = s.unionByName(a), l_.unionByName(b)
    return V.reconcile(s, l_)


def s03_xlsx(spark, sf_dir):
    raw = T.raw_weather(spark, sf_dir)
    path = _scratch(spark, "s03")
    B.write_partition_files(raw, path, "xlsx")
    cells = B.xlsx_cells(B.binary_files(spark, path, glob="*.xlsx"))
    return B.cells_to_columns(cells, raw.columns).drop("path").replace("", None)


def s06_decode(spark, sf_dir):
    raw = T.raw_subway(spark, sf_dir)
    path = _scratch(spark, "s06")
    raw.write.option("header", True).option("encoding", "UTF-16LE").option("maxRecordsPerFile", B.ROWS_PER_FILE).csv(path)
    lines = B.decode_text(B.binary_files(spark, path, glob="*.csv"))
    return B.parse_csv_lines(lines, raw.columns).drop("path", "member")


def s08_zip(spark, sf_dir):
    raw = T.raw_trips(spark, sf_dir)
    path = _scratch(spark, "s08")
    B.write_partition_files(raw, path, "zip")
    lines = B.zip_csv_lines(B.binary_files(spark, path, glob="*.zip"))
    return B.parse_csv_lines(lines, raw.columns).drop("path", "member")


FILE_ORDERS = 10_000  # orders whose trips share a file


def write_id_files(spark, sf_dir, path):
    """The trips' ids in order, a file for each ten thousand orders: the files' contents follow from the rows."""
    ids = T.raw_trips(spark, sf_dir).select((F.split("trip_id", "-")[0].cast("long") / FILE_ORDERS).cast("long").alias("file"), "trip_id")
    ids.repartition("file").sortWithinPartitions("file", "trip_id").write.partitionBy("file").text(path)


def _named(entries):
    return entries.select(F.regexp_extract("path", "/file=([0-9]+)/", 1).cast("long").alias("file"), "size_bytes", "sha256")


def s12_manifest(spark, sf_dir):
    """Sizes and hashes of files whose contents follow from the rows."""
    path = _scratch(spark, "s12")
    write_id_files(spark, sf_dir, path)
    return _named(U.file_manifest(spark, path))


def s13b_ledger(spark, sf_dir):
    """A ledger after three updates: of all files, of two thirds (the others are pruned), and of
    the same once more, which hashes nothing."""
    path = _scratch(spark, "s13b")
    write_id_files(spark, sf_dir, f"{path}/files")
    ledger = FileLedger(spark, f"{path}/ledger")
    ledger.update(f"{path}/files")
    rest = [r["path"] for r in ledger.read().select("path").collect() if int(r["path"].split("/file=")[1].split("/")[0]) % 3]
    if rest:
        ledger.update(rest)
    last = ledger.update(rest) if rest else ledger.update(f"{path}/files")
    return _named(ledger.read()).filter(F.col("file") % 3 != 0).withColumn("version", F.lit(last.version if rest else 3))


def s07_station_feed(spark, sf_dir):
    path = _scratch(spark, "s07")
    FD.write_station_feed(T.bike_feed(spark, sf_dir), path)
    return FD.read_station_feed(spark, path)


def st01_incremental_load(spark, sf_dir):
    """Trips in three deliveries, a compaction, then a delivery that corrects a fifth of the orders."""
    raw = T.raw_trips(spark, sf_dir)
    base = _scratch(spark, "st01")
    args = (f"{base}/landing", f"{base}/table", f"{base}/checkpoint", raw.columns)
    ST.land_in_batches(raw, f"{base}/landing", "trip_id", 3)
    ST.load_incrementally(spark, *args)
    ST.compact(spark, f"{base}/table", ["trip_id"])
    fixed = raw.filter(F.split("trip_id", "-")[0].cast("long") % 5 == 0).withColumn("trip_duration", F.lit("7777"))
    ST.land_in_batches(fixed, f"{base}/landing/later", "trip_id", 1)
    ST.load_incrementally(spark, *args)
    return ST.read_current(spark, f"{base}/table", ["trip_id"])


SOURCE_QUERIES = {
    "s01_read_delimited": s01_read_delimited,
    "s03_xlsx": s03_xlsx,
    "s06_decode": s06_decode,
    "s07_station_feed": s07_station_feed,
    "s08_zip": s08_zip,
    "s10_path_year": s10_path_year,
    "s12_manifest": s12_manifest,
    "s13b_ledger": s13b_ledger,
    "s15_drift": s15_drift,
    "s14_copy_counts": s14_copy_counts,
    "s18_merge": s18_merge,
    "s18b_merge_stats": s18b_merge_stats,
    "s20_publish": s20_publish,
    "v04_types": v04_types,
    "v05_nulls": v05_nulls,
    "v10_reconcile": v10_reconcile,
    "st01_incremental_load": st01_incremental_load,
}

