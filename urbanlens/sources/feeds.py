"""JSON documents: station feed (S07) and open-data catalogue.

Documents are read by Spark's JSON source with an explicit schema (no
inference pass); nested arrays are flattened with ``posexplode`` so the
position of a station in its feed survives (the first row of an id wins).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlens import config as C
from urbanlens.plans.marts import station_ref_from_feed

FEED_SCHEMA = (
    "last_updated long, ttl long, data struct<stations: array<struct<"
    "station_id: string, name: string, lat: double, lon: double, groups: array<string>>>>"
)
CATALOGUE_SCHEMA = (
    "success boolean, result struct<id: string, name: string, title: string, resources: array<struct<"
    "id: string, name: string, url: string, format: string, last_modified: string, datastore_active: boolean>>>"
)


def feed_stations(spark: SparkSession, paths: str | Sequence[str], multiline: bool = False) -> DataFrame:
    """One row per station entry with its order (file, document line, position)."""
    docs = (spark.read.schema(FEED_SCHEMA).option("multiLine", multiline)
            .json(paths if isinstance(paths, str) else list(paths))
            .withColumn("doc_id", F.monotonically_increasing_id())
            .withColumn("file_path", F.col("_metadata.file_path")))
    s = docs.select("file_path", "doc_id", F.posexplode("data.stations").alias("pos", "st"))
    return s.select(F.struct("file_path", "doc_id", "pos").alias("feed_order"), "st.*")


def read_station_feed(spark: SparkSession, paths: str | Sequence[str], multiline: bool = False,
                      cfg: C.MobilityConfig = C.DEFAULT) -> DataFrame:
    """Positive id, inside the bbox, first entry per id, 6-dp coordinates, neighbourhood."""
    return station_ref_from_feed(feed_stations(spark, paths, multiline), cfg, order_col="feed_order")


STATIONS_PER_DOC = 1000


def write_station_feed(feed: DataFrame, path: str, per_doc: int = STATIONS_PER_DOC, updated: int = 0, ttl: int = 10) -> None:
    """Write feed rows as feed documents (JSON lines); each document carries the stations of
    one hash bucket. Their number follows that of the rows, so that a document holds about
    ``per_doc`` stations however many there are (all rows of an id are in one document)."""
    bucket = F.pmod(F.xxhash64("station_id"), F.lit(1 + feed.count() // per_doc))
    docs = (feed.withColumn("_b", bucket).groupBy("_b")
            .agg(F.sort_array(F.collect_list(F.struct("station_id", "name", "lat", "lon", "groups"))).alias("stations")))
    out = docs.select(F.to_json(F.struct(F.lit(updated).alias("last_updated"), F.lit(ttl).alias("ttl"),
                                         F.struct("stations").alias("data"))).alias("value"))
    out.write.mode("overwrite").text(path)


def select_resources(catalogue: DataFrame, years: tuple[int, int], fmt: str = "CSV") -> DataFrame:
    """Resources whose name carries a year (20[1-2]d) inside ``years`` and whose format matches;
    a file-system-safe file name is derived from the resource name."""
    r = catalogue.select(F.explode("result.resources").alias("r")).select("r.*")
    year = F.regexp_extract("name", C.RESOURCE_YEAR_PATTERN, 1)
    safe = F.regexp_replace(F.regexp_replace(F.lower("name"), r"[^a-z0-9._-]+", "_"), r"^_+|_+$", "")
    return (r.withColumn("year", F.when(year != "", year.cast("int")))
            .filter(F.col("year").between(*years) & (F.upper("format") == fmt.upper()))
            .withColumn("file_name", F.concat(safe, F.lit("."), F.lower("format"))))
