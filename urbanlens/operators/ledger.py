"""A ledger of files: sizes and hashes, kept in versions.

Executors read sizes and hash contents in blocks, so a file of any size passes through a
task in constant memory. An update hashes only files that are new or whose size has
changed, and publishes additions, replacements and the pruning of vanished files as one
version.
"""

from __future__ import annotations

import hashlib
import sys
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlens.operators.versions import VersionConflict, VersionLog
from urbanlens.sources.headers import listing, open_file

ENTRY_SCHEMA = "path string, size_bytes long, sha256 string"
_BLOCK = 1 << 20


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = []
        for path in batch.column(0).to_pylist():
            with open_file(path, None, seekable=True) as f:
                sizes.append(f.size())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], names=["path", "size_bytes"])


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths, sizes, digests = batch.column(0).to_pylist(), [], []
        for path in paths:
            digest, size = hashlib.sha256(), 0
            with open_file(path, None) as f:
                while block := f.read(_BLOCK):
                    digest.update(block)
                    size += len(block)
            sizes.append(size)
            digests.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(sizes, pa.int64()), pa.array(digests, pa.string())],
                                         names=["path", "size_bytes", "sha256"])


def file_sizes(spark: SparkSession, paths: str | Sequence[str], recursive: bool = True) -> DataFrame:
    return listing(spark, paths, recursive).mapInArrow(_sizes, "path string, size_bytes long")


def hashed(files: DataFrame) -> DataFrame:
    """``path, size_bytes, sha256`` of the files named by ``path``."""
    return files.select("path").mapInArrow(_hashes, ENTRY_SCHEMA)


@dataclass(frozen=True)
class LedgerChange:
    added: int
    replaced: int
    pruned: int
    version: int


class FileLedger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.log = VersionLog(spark, f"{self.path}/_versions")

    def read(self) -> DataFrame:
        version = self.log.newest()
        if version is None:
            return self.spark.createDataFrame([], ENTRY_SCHEMA)
        return self.spark.read.schema(ENTRY_SCHEMA).parquet(f"{self.path}/{version.body['folder']}")

    def changed(self, paths: str | Sequence[str], recursive: bool = True) -> DataFrame:
        """``path, size_bytes`` of files that the ledger lacks or knows with another size."""
        return file_sizes(self.spark, paths, recursive).join(self.read(), ["path", "size_bytes"], "left_anti")

    def update(self, paths: str | Sequence[str], recursive: bool = True) -> LedgerChange:
        """Make the ledger that of the files under ``paths``, in one version step."""
        while True:
            version = (self.log.numbers() or [0])[-1]
            now, old = file_sizes(self.spark, paths, recursive), self.read()
            kept = old.join(now, ["path", "size_bytes"], "left_semi")
            new = hashed(now.join(old, ["path", "size_bytes"], "left_anti").repartition("path"))
            folder = f"entries-{uuid.uuid4().hex[:12]}"
            kept.unionByName(new).write.parquet(f"{self.path}/{folder}")
            written = self.spark.read.schema(ENTRY_SCHEMA).parquet(f"{self.path}/{folder}")
            both = written.select("path", F.col("sha256").alias("n"), F.col("size_bytes").alias("ns")).join(
                old.select("path", F.col("sha256").alias("o"), F.col("size_bytes").alias("os")), "path", "full")
            counts = both.agg(F.count(F.when(F.col("o").isNull(), 1)), F.count(F.when((F.col("n") != F.col("o")) | (F.col("ns") != F.col("os")), 1)),
                              F.count(F.when(F.col("n").isNull(), 1))).first()
            try:
                return LedgerChange(*counts, self.log.append({"folder": folder}, version).number)
            except VersionConflict:
                continue


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no installed package
