"""A table divided by key, on plain parquet, whose merges rewrite only what they touch.

Rows are divided by a hash of their key into a fixed number of buckets, one folder each.
A version names for each bucket the folder that holds it. A merge takes of the source
one row per key, reads the buckets its keys fall into and no others, and writes those
anew; the next version points to the new folders and, for all other buckets, to the old
ones. Inserted and updated rows are counted while they are written (Observation). Nothing
that readers use is replaced, and a merge that loses a race is repeated, or, if the other
one touched other buckets, published beside it.

The source may be of any size: it is landed as it comes, and shuffles once to its buckets,
together with the touched part of the target; there, in one sort, a key's first source row is
found and its old rows are dropped. Inside a bucket rows are dealt further by another hash of
their key, so that a task's work is bounded by the shuffle's partitions, not by the number of
buckets; Spark merges what is small. Only a source with a hot key (its rows are counted as they
would be dealt) is reduced by an aggregate before, inside its map tasks, and shuffles twice.
``buckets`` is chosen by how much of the table a merge may rewrite.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from urbanlens.operators.dedup import keep_first
from urbanlens.operators.versions import Version, VersionConflict, VersionLog
from urbanlens.session import drop_landed, land

BUCKETS = 64
_BUCKET = "_bucket"
_PART = "_part"  # of a bucket, in the shuffle only
PARTS_PER_PARTITION = 8  # even out the hash of the few buckets
CODEC = "zstd"  # of the table's files and the landed source
HOT_ROWS = 100_000  # a part of a bucket may get so many source rows,
HOT = 4  # or so many times the mean of all, as they come


@dataclass(frozen=True)
class MergeResult:
    inserted: int
    updated: int
    buckets: tuple[int, ...]  # touched
    version: int


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.log = VersionLog(spark, f"{self.path}/_versions")

    @classmethod
    def create(cls, df: DataFrame, path: str, keys: Sequence[str], buckets: int = BUCKETS) -> KeyedTable:
        """A first version of the rows of ``df``, as they are: rows of one key stay until a merge replaces them."""
        table = cls(df.sparkSession, path)
        head = {"keys": list(keys), "buckets": buckets, "schema": df.schema.jsonValue(), "folders": {}}
        rows = df.withColumn(_BUCKET, table._bucket(head))
        folder = table._write(table._dealt(rows, head).drop(_PART))
        found = [r[0] for r in table.spark.read.schema(rows.schema).parquet(f"{table.path}/{folder}").select(_BUCKET).distinct().collect()]
        table.log.append(head | {"folders": {str(b): folder for b in found}}, 0)
        return table

    def _bucket(self, head: dict) -> Column:
        return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in head["keys"]]), F.lit(head["buckets"])).cast("int")

    def _parts(self, head: dict) -> int:
        """Parts of a bucket."""
        return -(-PARTS_PER_PARTITION * int(self.spark.conf.get("spark.sql.shuffle.partitions")) // head["buckets"])

    def _part(self, head: dict) -> Column:
        return F.pmod(F.hash(*[F.col(f"`{k}`") for k in head["keys"]]), F.lit(self._parts(head)))

    def _dealt(self, rows: DataFrame, head: dict) -> DataFrame:
        """Shuffled by bucket and part: rows of one key stay together."""
        return rows.withColumn(_PART, self._part(head)).repartition(_BUCKET, _PART)

    def _write(self, rows: DataFrame) -> str:
        folder = f"rows-{uuid.uuid4().hex[:12]}"
        rows.write.option("compression", CODEC).partitionBy(_BUCKET).parquet(f"{self.path}/{folder}")
        return folder

    def current(self) -> Version:
        version = self.log.newest()
        if version is None:
            raise FileNotFoundError(f"no table under {self.path}")
        return version

    def read(self, version: Version | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        """The newest (or the given) version, all of it or some buckets."""
        body = (version or self.current()).body
        schema = StructType.fromJson(body["schema"])
        paths = [f"{self.path}/{folder}/{_BUCKET}={b}" for b, folder in sorted(body["folders"].items())
                 if buckets is None or int(b) in buckets]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def merge(self, source: DataFrame, order: Sequence[str] | None = None) -> MergeResult:
        """Update the rows whose key the source has, insert those the table lacks. Of several
        source rows of a key the first by ``order`` (then all columns) is taken; a NULL key
        is a key like any other."""
        body = self.current().body
        columns = [f.name for f in StructType.fromJson(body["schema"])]
        own = {c.lower(): c for c in columns}
        first = list(dict.fromkeys(c if c in columns else own.get(c.lower(), c) for c in order or ()))
        rest = [c for c in columns if c not in first]
        # the staged columns stand in the order that decides between rows of a key
        rows = source.select(*[F.col(f"`{c}`") for c in columns]).select(*[F.col(f"`{c}`") for c in first + rest])
        landed = []
        try:
            staged = self._landed(rows, body, landed)
            counts = self._counts(staged, body)
            touched = tuple(sorted(counts))
            if self._is_hot(counts, body):
                staged = self._landed(keep_first(staged.drop(_BUCKET), body["keys"], first), body, landed)
            while True:
                version = self.current()
                if not touched:
                    return MergeResult(0, 0, (), version.number)
                folder, seen = self._merged(version, staged, touched)
                try:
                    number = self._publish(version, folder, touched)
                    return MergeResult(seen["inserted"], seen["updated"], touched, number)
                except VersionConflict:
                    continue
        finally:
            for path in landed:
                drop_landed(self.spark, path)

    def _landed(self, rows: DataFrame, head: dict, landed: list[str]) -> DataFrame:
        landed.append(land(rows.withColumn(_BUCKET, self._bucket(head)), "merge-source", codec=CODEC))
        return self.spark.read.parquet(landed[-1])

    def _counts(self, staged: DataFrame, head: dict) -> dict[int, tuple[int, int]]:
        """For each bucket that the source touches its rows, and those of its largest part."""
        parts = staged.groupBy(_BUCKET, self._part(head).alias(_PART)).agg(F.count(F.lit(1)).alias("n"))
        return {r[0]: (r[1], r[2]) for r in parts.groupBy(_BUCKET).agg(F.sum("n"), F.max("n")).collect()}

    def _is_hot(self, counts: dict[int, tuple[int, int]], head: dict) -> bool:
        """Whether dealing the source as it is would give one task far more rows than others."""
        mean = sum(n for n, _ in counts.values()) / max(1, len(counts) * self._parts(head))
        return any(most > max(HOT_ROWS, HOT * mean) for _, most in counts.values())

    def _merged(self, version: Version, staged: DataFrame, touched: Sequence[int]) -> tuple[str, dict]:
        keys = version.body["keys"]
        old = self.read(version, touched).withColumn(_BUCKET, self._bucket(version.body)).withColumn("_new", F.lit(0))
        both = self._dealt(old.unionByName(staged.withColumn("_new", F.lit(1))), version.body)
        # in a key the source's rows come first, the one to be taken before all; the shuffle serves the
        # window and, by the sort's first column, the writer
        one = (Window.partitionBy(_BUCKET, _PART, *[F.col(f"`{k}`") for k in keys])
               .orderBy(F.desc("_new"), *[F.col(f"`{c}`") for c in staged.columns if c not in (*keys, _BUCKET)]))
        both = (both.withColumn("_place", F.row_number().over(one))
                .withColumn("_from_source", F.sum("_new").over(one.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
        seen = Observation()
        new, place, from_source = F.col("_new") == 1, F.col("_place"), F.col("_from_source")
        taken = new & (place == 1)
        replaced = ~new & (from_source > 0) & (place == from_source + 1)  # the first old row of a key that the source has
        both = both.observe(seen, F.count(F.when(taken, 1)).alias("taken"), F.count(F.when(replaced, 1)).alias("updated"))
        kept = both.filter(taken | (from_source == 0))
        folder, counts = self._write(kept.drop("_new", "_place", "_from_source", _PART)), seen.get
        return folder, {"inserted": counts["taken"] - counts["updated"], "updated": counts["updated"]}

    def _publish(self, base: Version, folder: str, touched: Sequence[int]) -> int:
        """The next version; behind other writers' versions if none of them has touched these buckets."""
        version = base
        while True:
            mine = {str(b): folder for b in touched}
            body = version.body | {"folders": version.body["folders"] | mine}
            try:
                return self.log.append(body, version.number).number
            except VersionConflict:
                version = self.current()
                if any(version.body["folders"].get(str(b)) != base.body["folders"].get(str(b)) for b in touched):
                    raise


def load_files(table: KeyedTable, files: str | Sequence[str], columns: Sequence[str] | None = None, **options) -> MergeResult:
    """Every file of a dataset in one read, merged into the table in one upsert."""
    from urbanlens.sources.delimited import read_delimited

    return table.merge(read_delimited(table.spark, files, columns=columns, **options))
