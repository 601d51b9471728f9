"""Delimited files: read, land as text, header drift, positional copy, CSV sink.

(S01, S02, S04 path column, S10, S14, S15, S16, S22)

Files are read by Spark's CSV source, which splits large files across tasks;
nothing is parsed on the driver. The landing schema is explicit text (no
inference pass over the data).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urbanlens import config as C
from urbanlens.functions.columns import null_if_token
from urbanlens.sources.headers import vintages

YEAR_IN_PATH = r"(?:^|/)(?:[^/=]+=)?(\d{4})(?:/|$)"


def text_schema(columns: Sequence[str]) -> T.StructType:
    """Every column a nullable string."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def _one_vintage(spark: SparkSession, paths: Sequence[str], encoding: str, glob: str | None) -> DataFrame:
    """Files of one header; a file whose header differs after all fails the read."""
    reader = (spark.read.option("header", True).option("quote", '"').option("escape", '"').option("encoding", encoding)
              .option("inferSchema", False).option("enforceSchema", False).option("mode", "PERMISSIVE"))
    return (reader.option("pathGlobFilter", glob) if glob else reader).csv(list(paths))


def read_delimited(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str] | None = None,
                   null_tokens: Sequence[str] = C.NULL_TOKENS, with_path: bool = False,
                   encoding: str = "UTF-8", recursive: bool = False, glob: str | None = None,
                   renames: Mapping[str, str] | None = None, rename_from_year: int | None = None) -> DataFrame:
    """Comma-separated, header skipped, '"'-quoted, every column text.

    Columns are taken by name, in any case and order (Q25): executors read the files'
    headers (``headers``), each distinct one has its own reader over its folders, and the
    results are stacked by name; files without a byte are passed over.
    ``columns`` names the result's columns; each must be in some file's header, and is
    NULL where a file lacks it. Without it the columns of all headers are kept, under
    the spelling of the first file. ``renames`` maps drifted header names to those of
    the result before that (S15); with ``rename_from_year`` only in files whose path has
    that year or a later one. NULL tokens map to NULL (Q24). Compressed files are read
    transparently by extension.
    """
    groups: dict[tuple[str, bool], list[str]] = {}
    for v in vintages(spark, paths, YEAR_IN_PATH, encoding, recursive, glob):
        drift = bool(renames) and (rename_from_year is None or v.year is not None and v.year >= rename_from_year)
        groups.setdefault((v.header, drift), []).extend(v.paths)
    if not groups:
        raise FileNotFoundError(f"no delimited file with a header under {paths}")
    frames, spelling = [], {c.lower(): c for c in columns or ()}
    moved = {k.lower(): v for k, v in (renames or {}).items()}
    for (_, drift), files in groups.items():
        df = _one_vintage(spark, files, encoding, glob)
        names = [moved.get(c.lower(), c) if drift else c for c in df.columns]
        for c in names:
            if columns is None:
                spelling.setdefault(c.lower(), c)
        frames.append((df, {c.lower(): own for c, own in zip(names, df.columns)}))
    missing = [c for c in spelling.values() if not any(c.lower() in have for _, have in frames)]
    if missing:
        raise ValueError(f"columns missing from the files: {missing}")
    out = None
    for df, have in frames:
        cols = [(null_if_token(F.col(f"`{have[k]}`"), null_tokens) if k in have else F.lit(None).cast("string")).alias(c)
                for k, c in spelling.items()]
        if with_path:
            cols.append(F.col("_metadata.file_path").alias("file_path"))
        part = df.select(*cols)
        out = part if out is None else out.unionByName(part)
    return out


def path_year(path_col: str = "file_path"):
    """The four-digit directory component of a path (``2024/`` or ``year=2024/``), else NULL."""
    y = F.regexp_extract(F.col(path_col), YEAR_IN_PATH, 1)
    return F.when(y != "", y.cast("int"))


def filter_min_year(df: DataFrame, min_year: int = C.MIN_PATH_YEAR, path_col: str = "file_path") -> DataFrame:
    """Keep rows whose path year is >= ``min_year``; paths without a year are kept."""
    y = path_year(path_col)
    return df.filter(y.isNull() | (y >= min_year))


def rename_drifted(df: DataFrame, renames: Mapping[str, str], year_col: str | None = None,
                   from_year: int = C.DRIFT_YEAR) -> DataFrame:
    """Apply header renames. With ``year_col`` (a path year column), per row: columns of
    files from ``from_year`` on are moved to the new names; older rows keep theirs."""
    if year_col is None:
        return df.withColumnsRenamed(dict(renames))
    drift = F.col(year_col) >= from_year
    out = df
    for old, new in renames.items():
        if old not in df.columns:
            continue
        if new in df.columns:
            out = out.withColumn(new, F.when(drift, F.col(old)).otherwise(F.col(new)))
        else:
            out = out.withColumn(new, F.when(drift, F.col(old)))
    return out


def strip_extra(df: DataFrame, allowed: Sequence[str]) -> DataFrame:
    """Keep allowed columns (case-insensitive), in file order; absent allowed columns
    are added as NULL (short rows are padded by the CSV reader already)."""
    allowed_l = [a.lower() for a in allowed]
    keep = [c for c in df.columns if c.lower() in allowed_l]
    present = {c.lower() for c in keep}
    pad = [F.lit(None).cast("string").alias(a) for a in allowed if a.lower() not in present]
    return df.select(*keep, *pad)


def copy_positional(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str],
                    fail_fast: bool = True) -> DataFrame:
    """Map file columns by position onto ``columns`` (header skipped).

    ``fail_fast``: abort on a malformed row (wrong field count), like a COPY
    with ON_ERROR=ABORT. Otherwise malformed rows are kept, with their text in
    ``_corrupt_record`` for ``copy_report``: rows the parser rejects, and rows
    with more fields than declared (caught by one sentinel column past the
    declared ones, since the lenient parser would otherwise drop the excess).
    """
    schema = text_schema(columns)
    if not fail_fast:
        schema = (schema.add(T.StructField("_extra_field", T.StringType(), True))
                  .add(T.StructField("_corrupt_record", T.StringType(), True)))
    reader = (spark.read.schema(schema).option("header", True).option("quote", '"').option("escape", '"')
              .option("enforceSchema", True).option("mode", "FAILFAST" if fail_fast else "PERMISSIVE"))
    if fail_fast:
        return reader.csv(list(paths) if not isinstance(paths, str) else paths)
    df = reader.option("columnNameOfCorruptRecord", "_corrupt_record").csv(
        list(paths) if not isinstance(paths, str) else paths)
    # with the sentinel, a well-formed row is one field short of the read schema and
    # is flagged by the parser; count its top-level (quote-aware) fields to tell it
    # from a genuinely short row
    plain = F.regexp_replace("_corrupt_record", '"[^"]*"', "")  # commas outside quotes, in one pass over the row
    fields = F.length(plain) - F.length(F.replace(plain, F.lit(","), F.lit(""))) + 1
    text = F.concat_ws(",", *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in columns], F.col("_extra_field"))
    bad = (F.when(F.col("_extra_field").isNotNull(), text)
           .when(F.col("_corrupt_record").isNotNull() & (fields != len(columns)), F.col("_corrupt_record")))
    return df.select(*[F.col(f"`{c}`") for c in columns], bad.alias("_corrupt_record"))


def copy_report(df: DataFrame) -> DataFrame:
    """Rows parsed, loaded, errors, the first error text, and rows whose first
    (key) field is empty, in one aggregate."""
    bad = F.col("_corrupt_record").isNotNull()
    key = F.col(f"`{df.columns[0]}`")
    return df.agg(F.count(F.lit(1)).alias("rows_parsed"),
                  F.sum(F.when(~bad & key.isNull(), 1).otherwise(0)).alias("empty_key_rows"),
                  F.sum(F.when(bad, 0).otherwise(1)).alias("rows_loaded"),
                  F.sum(F.when(bad, 1).otherwise(0)).alias("errors_seen"),
                  F.min(F.when(bad, F.col("_corrupt_record"))).alias("first_error"))


def write_delimited(df: DataFrame, path: str, order_by: Sequence[str], columns: Sequence[str] | None = None,
                    null_token: str = "") -> None:
    """Header, fixed column order, deterministic global sort (range partitioned)."""
    out = df.select(*(columns or df.columns)).orderBy(*order_by)
    (out.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"')
     .option("nullValue", null_token).csv(path))


def load_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A typed reference table from CSV (explicit schema, no inference)."""
    return spark.read.schema(schema).option("header", True).option("quote", '"').option("escape", '"').csv(path)


def lower_columns(df: DataFrame) -> DataFrame:
    """Lower-case column names."""
    return df.toDF(*[c.lower() for c in df.columns])
