"""Checks of a run against the runs before it.

Every run appends its metrics to a table (a folder for each run: a repeated run replaces
its own rows and nothing else) and is compared with the last ``training`` runs before it.
Until a metric has that many runs it passes.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

METRICS_SCHEMA = "table_name string, metric string, value double, run long"


def volume_metrics(df: DataFrame, table_name: str, loaded_at: str | Column | None = None, as_of: Column | None = None) -> DataFrame:
    """``table_name, metric, value``: the number of rows and, with ``loaded_at``, the days from
    its newest value to ``as_of``; one aggregate, one row for each metric."""
    rows = F.count(F.lit(1)).cast("double")
    pairs = [F.struct(F.lit("rows").alias("metric"), rows.alias("value"))]
    if loaded_at is not None:
        newest = F.max(F.col(loaded_at) if isinstance(loaded_at, str) else loaded_at)
        age = F.datediff(as_of, F.to_date(newest)).cast("double")
        pairs.append(F.struct(F.lit("age_days").alias("metric"), age.alias("value")))
    wide = df.agg(F.array(*pairs).alias("m"))
    return wide.select(F.lit(table_name).alias("table_name"), F.explode("m").alias("m")).select("table_name", "m.*")


class MetricHistory:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def read(self) -> DataFrame:
        """All runs' metrics; empty before the first."""
        try:
            return self.spark.read.schema(METRICS_SCHEMA).parquet(self.path)
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], METRICS_SCHEMA)

    def append(self, metrics: DataFrame) -> None:
        """Append the rows of one or several runs (column ``run``); a run's own rows replace
        those of an earlier try of it."""
        (metrics.select("table_name", "metric", F.col("value").cast("double").alias("value"), F.col("run").cast("long").alias("run"))
         .repartition("run").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(self.path))

    def record(self, run: int, metrics: DataFrame, training: int = 14, sensitivity: float = 3.0) -> DataFrame:
        """Append the metrics of ``run`` and compare them with the runs before it: all metrics
        with ``baseline``, ``spread`` (of the last ``training`` runs) and ``status``."""
        self.append(metrics.withColumn("run", F.lit(run).cast("long")))
        return self.check(run, training, sensitivity)

    def check(self, run: int, training: int = 14, sensitivity: float = 3.0) -> DataFrame:
        """``training`` until there are enough runs, else ``pass``, or ``anomaly`` for a value more
        than ``sensitivity`` standard deviations from the mean (any other value, if all were equal)."""
        known = self.read()
        recent = Window.partitionBy("table_name", "metric").orderBy(F.desc("run"))
        before = (known.filter((F.col("run") < run) & F.col("value").isNotNull())
                  .withColumn("_n", F.row_number().over(recent)).filter(F.col("_n") <= training)
                  .groupBy("table_name", "metric")
                  .agg(F.avg("value").alias("baseline"), F.stddev_samp("value").alias("spread"), F.count("value").alias("trained_on")))
        now = known.filter(F.col("run") == run).join(before, ["table_name", "metric"], "left")
        off = F.abs(F.col("value") - F.col("baseline")) > sensitivity * F.col("spread")
        status = (F.when(F.coalesce("trained_on", F.lit(0)) < training, "training")
                  .when(F.col("value").isNull() | off, "anomaly").otherwise("pass"))
        return now.select("table_name", "metric", "run", "value", "baseline", "spread", status.alias("status"))
