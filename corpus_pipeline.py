"""The corpus pipeline: documents -> packed training sequences, in five stages.

Each stage is (name, function); a function takes ``(spark, docs, sf_dir)`` and returns a
DataFrame, which :func:`run` writes as Parquet in the cluster's shared folder and reads
again as the next stage's ``docs``. All but the last return the columns of documents.

``quality`` drops what the classifier (trained on ``labels``) rejects; ``near_duplicates``
keeps the smallest id of each group of a similarity of 0.8 or more; ``decontaminate``
drops documents in which a benchmark item appears; ``secrets`` replaces each secret by a
mark (``n_chars`` follows); ``pack`` returns the pieces of the packed sequences.

Rows with nulls, empty tables and extra columns pass as the operators' modules define;
a stage never adds or drops a column but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlens.llm import decontam, neardup, packing, quality, secrets
from urbanlens.llm.common import shared_table
from urbanlens.llm.queries import RANKS
from urbanlens.session import read_table


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one(docs, percent=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.keep_clean(docs, read_table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = secrets.redact(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, RANKS)


STAGES = [
    ("quality", good),
    ("near_duplicates", distinct),
    ("decontaminate", decontaminated),
    ("secrets", without_secrets),
    ("pack", packed),
]

#: No SQL: classifier training, near-duplicate groups and tokenization are not expressible.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = shared_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
