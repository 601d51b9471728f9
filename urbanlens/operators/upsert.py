"""Idempotent key upsert and file manifests.

MERGE INTO needs a row-level table format; on plain parquet the same result
is a set operation: the deduplicated source wins for every key it carries,
target rows whose key it does not carry are kept. Both sides shuffle once on
the key (the dedup window and the anti join share that partitioning), and the
result is written to a new folder, never in place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanlens.operators.dedup import keep_first


def _key_match(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool) -> Column:
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(right[k]) if null_safe else (left[k] == right[k])
        cond = c if cond is None else (cond & c)
    return cond


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
                 order: Sequence[str] | None = None, null_safe: bool = True) -> DataFrame:
    """Target with the source applied (update matched, insert unmatched).

    The source is first reduced to one row per key (``keep_first``; survivor
    by ``order``, default all other columns). With ``null_safe=False`` a NULL
    key never matches, so such source rows are always inserted (Q7 parity).
    """
    src = keep_first(source, keys, order, null_safe=null_safe)
    src_keys = src.select(*keys)
    kept = target.join(src_keys, _key_match(target, src_keys, keys, null_safe), "left_anti")
    return kept.unionByName(src.select(*target.columns))


def merge_stats(target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = True) -> DataFrame:
    """(inserted, updated) counts of applying ``source`` to ``target``, one aggregate."""
    src_keys = keep_first(source.select(*keys), keys, list(keys), null_safe=null_safe)
    tgt_keys = target.select(*keys).distinct().withColumn("_hit", F.lit(True))
    j = src_keys.join(tgt_keys, _key_match(src_keys, tgt_keys, keys, null_safe), "left")
    return j.agg(F.sum(F.when(F.col("_hit").isNull(), 1).otherwise(0)).alias("inserted"),
                 F.sum(F.when(F.col("_hit"), 1).otherwise(0)).alias("updated"))


def file_manifest(spark, paths: str | Sequence[str], recursive: bool = True) -> DataFrame:
    """(path, size, sha256) per file, hashed in blocks inside the task that reads it."""
    from urbanlens.operators.ledger import hashed
    from urbanlens.sources.headers import listing

    return hashed(listing(spark, paths, recursive))


def manifest_changes(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Files to (re)load — new paths or a changed size; unchanged sizes are skipped."""
    return current.join(previous.select("path", "size_bytes"), ["path", "size_bytes"], "left_anti")


def manifest_update(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Replace entries by path, then prune entries whose file no longer exists."""
    merged = merge_upsert(previous, current, ["path"], order=["path"])
    return merged.join(current.select("path"), "path", "left_semi")


def load_dataset(spark, target: DataFrame | None, files: str | Sequence[str], keys: Sequence[str],
                 columns: Sequence[str] | None = None) -> DataFrame:
    """Every file of a dataset in one read, merged into the target in one upsert."""
    from urbanlens.sources.delimited import read_delimited

    source = read_delimited(spark, files, columns=columns)
    return source if target is None else merge_upsert(target, source, keys)
