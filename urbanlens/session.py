"""Session and table access."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "urbanlens", extra: dict | None = None) -> SparkSession:
    """Session tuned for this library: AQE, skew-join splitting, UTC, no UI."""
    builder = SparkSession.builder.appName(app)
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    if master:
        builder = builder.master(master)
    builder = (
        builder
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("URBANLENS_DRIVER_MEMORY", "16g"))
    )
    if shuffle_partitions:  # else the cluster's own setting; AQE merges small partitions
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A folder under the cluster's shared checkpoint directory.

    The cluster names it in ``spark.checkpoint.dir``; only a local session
    without that setting (tests, laptops) gets a private temporary one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="urbanlens-ckpt-"))
        base = spark.sparkContext.getCheckpointDir()
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    base = base.rstrip("/")
    return f"{base}/{name}"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def land(df: DataFrame, name: str, partition_by: tuple[str, ...] = (), codec: str | None = None) -> str:
    """Write ``df`` as a parquet table in the shared folder; returns its folder.

    It cuts the lineage, so later plans neither recompute nor re-optimise the derivation,
    survives the loss of executors, and gives the planner the table's true size."""
    import uuid

    path = shared_dir(df.sparkSession, f"tables/{name}-{uuid.uuid4().hex[:12]}")
    df.write.partitionBy(*partition_by).parquet(path, compression=codec)
    return path


def drop_landed(spark: SparkSession, path: str) -> None:
    """Remove a table that ``land`` wrote and nobody reads any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
