"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlens.session import shared_dir


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` (long) and ``text`` only; a null text becomes empty. Other columns,
    whatever their names, are dropped here, so they can't clash with those added later."""
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
    )


def row_key(*cols: str) -> Column:
    """64-bit key of a row. Equal rows share it. Two different rows may share it among very
    many: it chooses candidates that are verified, and results are joined by it and the id."""
    return F.xxhash64(*[F.col(c) for c in cols])


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back: cuts the lineage,
    survives lost executors, and gives the planner the table's true size."""
    spark = df.sparkSession
    path = shared_dir(spark, f"llm/{name}-{uuid.uuid4().hex[:12]}")
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def n_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
