"""Duplicate removal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_duplicates(
    df: DataFrame, subset: Sequence[str] | None = None, order: Sequence[str] | None = None
) -> DataFrame:
    """One row per distinct ``subset`` (default: all columns), the first by ``order``.

    The kept row is an aggregate, so each task reduces its own copies before the
    shuffle and a value holding a large share of the rows costs one row per task.
    """
    if not subset:
        return df.dropDuplicates()
    if not order:
        return df.dropDuplicates(list(subset))
    rest = [c for c in df.columns if c not in subset]
    if not rest:
        return df.dropDuplicates()
    first = F.min_by(F.struct(*[f"`{c}`" for c in rest]), F.struct(*order)).alias("_first")
    return df.groupBy(*[f"`{c}`" for c in subset]).agg(first).select(*[f"`{c}`" if c in subset else f"_first.`{c}`" for c in df.columns])


def duplicate_counts(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """``(total_rows, removed)``; NULL keys count as equal to each other."""
    groups = df.groupBy(*(subset or df.columns)).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("removed"),
    )
