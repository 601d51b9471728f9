"""First records of many files, read by the executors in one job.

Spark lists the files (globs, recursion and hidden files as its readers see them), and
each task opens its share of them and reads no further than the first line. So ten
thousand files are one job, a file of no bytes is a row like any other, and beside that
listing the driver gets one row for each folder and distinct header.
"""

from __future__ import annotations

import codecs
import csv
import re
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HEADER_SCHEMA = "file_path string, header string, names array<string>"
FILES_PER_TASK = 64
_CHUNK = 1 << 16


def listing(spark: SparkSession, paths: str | Sequence[str], recursive: bool = False, glob: str | None = None) -> DataFrame:
    """``path`` of the files under the paths, those without a byte too (Spark's readers leave
    them out of their scans), spread over tasks."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = [(unquote(f),) for f in reader.load(paths if isinstance(paths, str) else list(paths)).inputFiles()]
    return spark.createDataFrame(files, "path string").repartition(max(1, -(-len(files) // FILES_PER_TASK)))


def open_file(path: str, compression: str | None = "detect", seekable: bool = False):
    """A stream of the file's bytes, decompressed by its extension unless ``compression`` is None."""
    from pyarrow import fs

    scheme, _, rest = path.partition(":")
    if scheme == "file":
        system, name = fs.LocalFileSystem(), "/" + rest.lstrip("/")
    elif not rest:
        system, name = fs.LocalFileSystem(), path
    else:
        system, name = fs.FileSystem.from_uri(quote(re.sub("^s3[an]:", "s3:", path), safe=":/@"))
    return system.open_input_file(name) if seekable else system.open_input_stream(name, compression=compression)


def first_line(chunks: Iterator[bytes], encoding: str) -> str | None:
    """The text before the first line break, without a byte-order mark; None if there is no byte."""
    decoder, text, any_byte = codecs.getincrementaldecoder(encoding)("replace"), "", False
    for chunk in chunks:
        any_byte = any_byte or bool(chunk)
        text += decoder.decode(chunk)
        if (end := re.search(r"[\r\n]", text)) is not None:
            text = text[:end.start()]
            break
    else:
        text += decoder.decode(b"", True)
    return text.removeprefix("﻿") if any_byte else None


def _first_records(encoding: str):
    def chunks(path: str) -> Iterator[bytes]:
        with open_file(path) as f:
            while chunk := f.read(_CHUNK):
                yield chunk

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column(0).to_pylist()
            lines = [first_line(chunks(p), encoding) for p in paths]
            names = [[n.strip() for n in next(csv.reader([line]), [])] if line is not None else [] for line in lines]
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(lines, pa.string()), pa.array(names, pa.list_(pa.string()))],
                                             names=["file_path", "header", "names"])
    return run


def file_headers(spark: SparkSession, paths: str | Sequence[str], encoding: str = "UTF-8", recursive: bool = False,
                 glob: str | None = None) -> DataFrame:
    """``file_path, header, names`` of every file: its first line, and the column names in it
    (quoted names whole, trimmed). A file of no bytes has no header and no names."""
    files = listing(spark, paths, recursive, glob)
    return files.mapInArrow(_first_records(encoding), HEADER_SCHEMA)


@dataclass(frozen=True)
class Vintage:
    """Files of one header: whole folders where all their files have it, else the files."""

    header: str
    year: int | None
    paths: tuple[str, ...]
    first: str


def literal(path: str) -> str:
    """The path as a pattern that matches only itself."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def vintages(spark: SparkSession, paths: str | Sequence[str], year_pattern: str, encoding: str = "UTF-8", recursive: bool = False,
             glob: str | None = None) -> list[Vintage]:
    """The headers under the paths, in the order of the first file of each. The driver holds a
    row for each folder and header, and names of files only where headers share a folder."""
    found = (file_headers(spark, paths, encoding, recursive, glob).filter(F.col("header").isNotNull())
             .select("file_path", "header", F.regexp_extract("file_path", "^(.*)/[^/]*$", 1).alias("folder"),
                     F.regexp_extract("file_path", year_pattern, 1).alias("year")))
    groups = found.groupBy("folder", "header", "year").agg(F.min("file_path").alias("first")).collect()
    folders = [g["folder"] for g in groups]
    inner = sorted(set(folders))
    apart = {f for f in inner if folders.count(f) > 1 or any(o.startswith(f + "/") for o in inner)}
    files: dict[tuple, list[str]] = {}
    if apart:
        for r in found.filter(F.col("folder").isin(sorted(apart))).collect():
            files.setdefault((r["folder"], r["header"], r["year"]), []).append(r["file_path"])
    kinds: dict[tuple[str, str], list] = {}
    for g in sorted(groups, key=lambda g: g["first"]):
        own = files.get((g["folder"], g["header"], g["year"]))
        kinds.setdefault((g["header"], g["year"]), []).append((g["first"], [literal(p) for p in sorted(own)] if own else [literal(g["folder"])]))
    return [Vintage(header, int(year) if year else None, tuple(p for _, ps in parts for p in ps), parts[0][0])
            for (header, year), parts in kinds.items()]


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no installed package
