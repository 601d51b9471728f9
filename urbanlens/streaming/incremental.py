"""Incremental, idempotent landing of arriving files with Structured Streaming.

New delimited files in a landing folder are picked up by a file stream, and every
micro-batch is *appended* to the table's batch folder (cost: the batch, not the
table). Readers see the upserted state: of all rows of a key the one of the newest
batch wins (inside a batch the smallest row, so that the result does not depend on
arrival order), an aggregate that is combined map-side. A re-delivered file changes
nothing, a corrected one takes effect. ``compact`` folds the batches read so far
into a new base version; readers skip what the base already holds. The checkpoint
makes the stream restartable after executor or driver loss (a re-run batch rewrites
its own folder, so it is idempotent); ``availableNow`` processes what is there and
stops, which is how a scheduled load runs.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlens.operators.dedup import keep_first
from urbanlens.sources.delimited import text_schema


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``; None if nothing was written there yet. Any other failure is raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _base(spark: SparkSession, table_dir: str) -> tuple[DataFrame | None, int]:
    """The newest base and the last batch it holds (-1: none)."""
    versions = _read(spark, f"{table_dir}/_BASES")
    if versions is None:
        return None, -1
    last = versions.orderBy(F.desc("through_batch"), F.desc("path")).first()
    return spark.read.parquet(last["path"]), last["through_batch"]


def _batches(spark: SparkSession, table_dir: str, after: int) -> DataFrame | None:
    found = _read(spark, f"{table_dir}/batches")
    return None if found is None else found.filter(F.col("batch_id") > after)


def read_current(spark: SparkSession, table_dir: str, keys: Sequence[str]) -> DataFrame:
    """The upserted table: the base (if compacted) and every batch after it, one row per
    key, the newest."""
    base, through = _base(spark, table_dir)
    new = _batches(spark, table_dir, through)
    if base is None and new is None:
        raise FileNotFoundError(f"no data under {table_dir}")
    parts = [] if base is None else [base.withColumn("_age", F.lit(0).cast("long"))]
    if new is not None:  # newest batch first: its age is the smallest
        parts.append(new.withColumn("_age", -F.col("batch_id").cast("long") - 1).drop("batch_id"))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return keep_first(rows, keys, ["_age"]).drop("_age")


def compact(spark: SparkSession, table_dir: str, keys: Sequence[str]) -> str:
    """Write the current state as a new base; batches up to the last one it holds are no
    longer read and may be archived."""
    _, through = _base(spark, table_dir)
    new = _batches(spark, table_dir, through)
    last = through if new is None else new.agg(F.max("batch_id")).first()[0]
    version = f"{table_dir}/base-{uuid.uuid4().hex[:12]}"
    read_current(spark, table_dir, keys).write.parquet(version)
    row = [(version, through if last is None else int(last))]
    spark.createDataFrame(row, "path string, through_batch long").coalesce(1).write.mode("append").parquet(f"{table_dir}/_BASES")
    return version


def load_incrementally(spark: SparkSession, landing_dir: str, table_dir: str, checkpoint_dir: str,
                       columns: Sequence[str], bytes_per_batch: int = 10 << 30) -> int:
    """Run the stream until the landing folder is drained; return the number of batches.
    A batch takes files up to a volume, whatever their number."""
    stream = (spark.readStream.schema(text_schema(columns)).option("header", True)
              .option("quote", '"').option("escape", '"').option("maxBytesPerTrigger", bytes_per_batch)
              .option("recursiveFileLookup", True)
              .csv(landing_dir))
    batches = []

    def append(batch: DataFrame, batch_id: int) -> None:
        out = f"{table_dir}/batches/batch_id={batch_id}"
        batch.select(*columns).write.mode("overwrite").parquet(out)
        batches.append(batch_id)

    q = (stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint_dir)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return len(batches)


def land_in_batches(df: DataFrame, landing_dir: str, batch_col: str, n_batches: int) -> None:
    """Write ``df`` into the landing folder as ``n_batches`` separate deliveries of compressed files."""
    b = F.pmod(F.xxhash64(batch_col), F.lit(n_batches))
    for i in range(n_batches):
        (df.filter(b == i).write.mode("overwrite").option("header", True).option("compression", "gzip")
         .option("quote", '"').option("escape", '"').csv(f"{landing_dir}/delivery-{i:03d}"))
