"""Schema contracts and file validation.

``validate`` runs over every file of a dataset in one distributed job and
returns violations as rows (file, check, column, value, count, severity);
``raise_on_errors`` turns the first error into an exception for fail-fast
callers. Header checks read only the first line of each file; type and null
checks run over all rows, or on request over the first ``sample_rows`` rows of each
file (selected without sorting: row ids are ascending within a read split, and the
first rows of a file live in its first split). Columns match contract names in any
case.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlens import config as C
from urbanlens.sources.headers import file_headers


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    dtype: str  # DATE TIME STRING INTEGER DECIMAL TIMESTAMP
    nullable: bool = True


@dataclass(frozen=True)
class Contract:
    dataset: str
    columns: tuple[ColumnSpec, ...]
    min_row_count: int = 100
    extra: dict = field(default_factory=dict)

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]


def _cols(*specs: tuple) -> tuple[ColumnSpec, ...]:
    return tuple(ColumnSpec(*s) for s in specs)


# --- fixed values: the five source contracts (V09) ---------------------------------
CONTRACTS = {
    "subway_delays": Contract("subway_delays", _cols(
        ("Date", "DATE", False), ("Time", "TIME", False), ("Day", "STRING", False),
        ("Station", "STRING"), ("Code", "STRING"), ("Min Delay", "INTEGER"), ("Min Gap", "INTEGER"),
        ("Bound", "STRING"), ("Line", "STRING"))),
    "bus_delays": Contract("bus_delays", _cols(
        ("Date", "DATE", False), ("Route", "STRING"), ("Time", "TIME", False), ("Day", "STRING", False),
        ("Location", "STRING"), ("Incident", "STRING"), ("Min Delay", "INTEGER"), ("Min Gap", "INTEGER"),
        ("Direction", "STRING"))),
    "streetcar_delays": Contract("streetcar_delays", _cols(
        ("Date", "DATE", False), ("Line", "STRING"), ("Time", "TIME", False), ("Day", "STRING", False),
        ("Location", "STRING"), ("Incident", "STRING"), ("Min Delay", "INTEGER"), ("Min Gap", "INTEGER"),
        ("Bound", "STRING"))),
    "bike_trips": Contract("bike_trips", _cols(
        ("Trip Id", "STRING", False), ("Trip  Duration", "INTEGER"), ("Start Station Id", "INTEGER"),
        ("Start Time", "TIMESTAMP"), ("Start Station Name", "STRING"), ("End Station Id", "INTEGER"),
        ("End Time", "TIMESTAMP"), ("End Station Name", "STRING"), ("Bike Id", "INTEGER"),
        ("User Type", "STRING"))),
    "weather_daily": Contract("weather_daily", _cols(
        ("Date/Time", "DATE", False), ("Mean Temp (°C)", "DECIMAL"), ("Total Precip (mm)", "DECIMAL"),
        ("Snow on Grnd (cm)", "DECIMAL"), ("Spd of Max Gust (km/h)", "DECIMAL"))),
}

VIOLATION_SCHEMA = ("file_path string, check string, column_name string, value string, "
                    "n_rows bigint, severity string")


def _empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], VIOLATION_SCHEMA)


def header_checks(spark: SparkSession, paths, contract: Contract) -> DataFrame:
    """V01 missing (error), V02 extra / case mismatch (warn), V03 empty header (error): a file
    of no bytes, or whose first line is blank, has an empty header and misses every column."""
    h = file_headers(spark, paths)
    h = h.select("file_path", F.explode(F.when(F.trim(F.coalesce("header", F.lit(""))) == "", F.array(F.lit(None).cast("string")))
                                        .otherwise(F.col("names"))).alias("name"))
    spec = spark.createDataFrame([(c.name,) for c in contract.columns], "expected string")
    got = h.withColumn("lname", F.lower("name"))
    exp = spec.withColumn("lname", F.lower("expected"))
    # per file, expected names with no case-insensitive match -> missing (a header is
    # a bounded list of names, so collecting one file's names into a set is safe)
    present = got.select("file_path", "lname").distinct()
    missing = (present.groupBy("file_path").agg(F.collect_set("lname").alias("have"))
               .select("file_path", F.explode(F.array(*[F.struct(F.lit(c.name).alias("expected"),
                                                                  F.lit(c.name.lower()).alias("lname"))
                                                        for c in contract.columns])).alias("e"), "have")
               .filter(~F.array_contains("have", F.col("e.lname")))
               .select("file_path", F.lit("missing_column").alias("check"), F.col("e.expected").alias("column_name"),
                       F.lit(None).cast("string").alias("value"), F.lit(1).cast("bigint").alias("n_rows"),
                       F.lit("error").alias("severity")))
    extra = (got.join(F.broadcast(exp), "lname", "left")
             .select("file_path", "name", "expected")
             .select("file_path",
                     F.when(F.col("name").isNull(), "empty_header")
                     .when(F.col("expected").isNull(), "extra_column")
                     .when(F.col("expected") != F.col("name"), "case_mismatch").alias("check"),
                     F.col("name").alias("column_name"), F.lit(None).cast("string").alias("value"),
                     F.lit(1).cast("bigint").alias("n_rows"))
             .filter(F.col("check").isNotNull())
             .withColumn("severity", F.when(F.col("check") == "empty_header", "error").otherwise("warn")))
    return missing.unionByName(extra)


def value_checks(df: DataFrame, contract: Contract, sample_rows: int | None = None) -> DataFrame:
    """V04 type conformance and V05 nullability, counted per file, check and column, with
    one offending value as an example.

    ``df``: the dataset read as text with a ``file_path`` column (``read_delimited``).
    Blank and any-case ``NULL`` count as null; a null passes the type check.
    """
    d = df
    if sample_rows is not None:
        d = d.withColumn("_rid", F.monotonically_increasing_id())
        first = d.groupBy("file_path").agg(F.min("_rid").alias("_first"))
        d = (d.join(first, "file_path")
             .filter(F.col("_rid") - F.col("_first") < sample_rows).drop("_rid", "_first"))
    own = {c.lower(): c for c in df.columns}
    cols = [c for c in contract.columns if c.name.lower() in own]
    checks, wrong = [], None
    for c in cols:
        if c.dtype == "STRING" and c.nullable:
            continue  # any text, and none, conforms
        v = F.col(f"`{own[c.name.lower()]}`")
        is_null = v.isNull() | F.upper(F.trim(v)).isin("", "NULL")
        bad_type = F.lit(False) if c.dtype == "STRING" else ~F.trim(v).rlike(C.TYPE_PATTERNS[c.dtype])
        kind = F.when(is_null, F.lit(None if c.nullable else "null_in_required")) \
            .otherwise(F.when(bad_type, F.lit(f"type_{c.dtype.lower()}")))
        checks.append(F.struct(F.lit(c.name).alias("column_name"), kind.alias("check"),
                               v.alias("value")))
        wrong = kind.isNotNull() if wrong is None else wrong | kind.isNotNull()
    if not checks:
        return _empty(df.sparkSession)
    # only rows with a violation are taken apart
    exploded = d.filter(wrong).select("file_path", F.explode(F.array(*checks)).alias("c")).filter(F.col("c.check").isNotNull())
    return (exploded.groupBy("file_path", F.col("c.check").alias("check"), F.col("c.column_name").alias("column_name"))
            .agg(F.min("c.value").alias("value"), F.count(F.lit(1)).alias("n_rows")).withColumn("severity", F.lit("error"))
            .select("file_path", "check", "column_name", "value", "n_rows", "severity"))


def null_profile(df: DataFrame, contract: Contract) -> DataFrame:
    """Per contract column, how many values count as null (blank or any-case NULL)
    and whether the contract allows it; one aggregate over all files."""
    own = {c.lower(): c for c in df.columns}
    cols = [c for c in contract.columns if c.name.lower() in own]
    values = [F.col(f"`{own[c.name.lower()]}`") for c in cols]
    aggs = [F.sum(F.when(v.isNull() | F.upper(F.trim(v)).isin("", "NULL"), 1).otherwise(0)).alias(f"c{i}")
            for i, v in enumerate(values)]
    wide = df.agg(*aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(c.name).alias("column_name"), F.lit(c.nullable).alias("nullable"),
                                        F.col(f"c{i}").alias("null_rows")) for i, c in enumerate(cols)]))
    return wide.select(rows.alias("r")).select("r.*").withColumn(
        "status", F.when((F.col("null_rows") > 0) & ~F.col("nullable"), "error").otherwise("pass"))


def row_count_checks(df: DataFrame, contract: Contract) -> DataFrame:
    """V06 (warn): files with fewer data rows than the contract's minimum."""
    return (df.groupBy("file_path").agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") < contract.min_row_count)
            .select("file_path", F.lit("min_row_count").alias("check"), F.lit(None).cast("string").alias("column_name"),
                    F.lit(None).cast("string").alias("value"), "n_rows", F.lit("warn").alias("severity")))


def validate(spark: SparkSession, paths: str | Sequence[str], contract: Contract,
             sample_rows: int | None = None) -> DataFrame:
    """Every file of a dataset against its contract, files of no bytes included; an empty
    folder yields no rows."""
    from urbanlens.sources.delimited import read_delimited

    try:
        found = header_checks(spark, paths, contract)
        df = read_delimited(spark, paths, with_path=True, null_tokens=())
    except FileNotFoundError:  # no file with a header: what there is has been checked
        return found
    except AnalysisException as exc:
        if exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return _empty(spark)
        raise
    return (found.unionByName(value_checks(df, contract, sample_rows))
            .unionByName(row_count_checks(df, contract)))


class ContractError(ValueError):
    """Carries file, expected, actual and the mismatches."""

    def __init__(self, file_path: str, check: str, column: str | None, value: str | None, n: int):
        super().__init__(f"{file_path}: {check} in column {column!r} (value {value!r}, {n} rows)")
        self.file_path, self.check, self.column, self.value, self.n_rows = file_path, check, column, value, n


def raise_on_errors(violations: DataFrame) -> None:
    """Fail fast on the first error-severity violation (one row is fetched)."""
    first = violations.filter(F.col("severity") == "error").orderBy("file_path", "check", "column_name").take(1)
    if first:
        r = first[0]
        raise ContractError(r["file_path"], r["check"], r["column_name"], r["value"], r["n_rows"])


def reconcile(source_counts: DataFrame, loaded_counts: DataFrame,
              tolerance_pct: float = C.RECONCILE_TOLERANCE_PCT) -> DataFrame:
    """Per dataset, |source - loaded| / source <= tolerance; 0 source rows pass only if 0 loaded.
    Counts are true row counts, not file counts (Q20)."""
    j = source_counts.join(loaded_counts, "dataset", "full")
    s, l_ = F.coalesce("source_rows", F.lit(0)), F.coalesce("loaded_rows", F.lit(0))
    diff = F.when(s == 0, F.when(l_ == 0, F.lit(0.0)).otherwise(F.lit(100.0))) \
        .otherwise(F.round(F.abs(s - l_) / s * 100, 4))
    return j.select("dataset", s.alias("source_rows"), l_.alias("loaded_rows"), diff.alias("diff_pct"),
                    F.when(diff <= tolerance_pct, "pass").otherwise("fail").alias("status"))


def run_summary(spark: SparkSession, results: Sequence[tuple[str, str, str, int, str | None]]) -> DataFrame:
    """Per-dataset (stage, status, rows, error) plus a totals row; ``results`` is small."""
    df = spark.createDataFrame(list(results), "dataset string, stage string, status string, rows bigint, error string")
    tot = df.agg(F.lit("TOTAL").alias("dataset"), F.lit(None).cast("string").alias("stage"),
                 F.concat(F.sum(F.when(F.col("status") == "success", 1).otherwise(0)).cast("string"),
                          F.lit("/"), F.count(F.lit(1)).cast("string")).alias("status"),
                 F.sum("rows").alias("rows"), F.lit(None).cast("string").alias("error"))
    return df.unionByName(tot)

