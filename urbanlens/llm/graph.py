"""Connected components of an edge table, as joins and minima (large-star, small-star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanlens.llm.common import shared_table


def _stars(pairs: DataFrame, keep) -> DataFrame:
    """For each node ``u`` its smallest neighbour or itself as ``m``; the kept neighbours,
    and ``u`` itself, point to it."""
    least = pairs.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("m"))
    near = pairs.filter(keep).join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return near.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).filter("a > b").distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, component`` for every node that has an edge to another; ``component`` is the
    smallest node that can be reached.

    Every round halves the trees' depth at least on typical graphs; rounds end when the
    stars no longer change. Each round is written to the shared folder, so the plan stays
    short and a lost executor costs one round at most. A node with many edges is a hot
    key of a minimum (combined before the shuffle) and of a join that AQE may split."""
    stars = shared_table(
        edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a > b").distinct(), "edges")
    before = None
    while True:
        mark = stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
        both = stars.select(F.col("a").alias("u"), F.col("b").alias("v"))
        both = both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _stars(both, F.col("v") > F.col("u"))
        small = _stars(large.select(F.col("a").alias("u"), F.col("b").alias("v")), F.lit(True))
        stars = shared_table(small, "edges")
    roots = stars.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
