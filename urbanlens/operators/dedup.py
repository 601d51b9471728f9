"""Keep-one-per-key (W01/W02) and duplicate reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _order_names(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None) -> list[str]:
    """The explicit order, then every other non-key column: a total order, so the
    survivor is the same whatever the partitioning or arrival order (Q6)."""
    first = list(order or [])
    return first + [c for c in df.columns if c not in keys and c not in first]


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None,
               null_safe: bool = True) -> DataFrame:
    """One row per key: the first by ``order`` (ascending, NULLs first), ties broken
    by the remaining columns.

    Written as an aggregate, the minimum of a struct that holds the ordering columns
    and after them all others, not as a ``row_number`` window: the struct is the row
    itself, the aggregate runs partially on the map side, so even a key holding a
    third of all rows leaves each map task as one row, and no task sorts a hot key.
    With ``null_safe=False`` rows whose key holds a NULL are all kept, as an
    ``ON a = b`` merge would.
    """
    names = _order_names(df, keys, order)
    # struct ordering compares field by field with NULL lowest: ascending, NULLs first
    row = F.min(F.struct(*[F.col(f"`{c}`") for c in names])).alias("_row")
    out_cols = [F.col(f"`{c}`") if c in keys else F.col(f"_row.`{c}`").alias(c) for c in df.columns]
    if null_safe:
        return df.groupBy(*keys).agg(row).select(*out_cols)
    any_null = None
    for k in keys:
        cond = F.col(k).isNull()
        any_null = cond if any_null is None else (any_null | cond)
    kept = df.filter(~any_null).groupBy(*keys).agg(row).select(*out_cols)
    return kept.unionByName(df.filter(any_null))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1))
