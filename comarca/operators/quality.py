"""Completeness and uniqueness checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comarca.functions.scalars import is_missing
from comarca.operators.combine import union_all


def _percent(part, whole):
    return F.try_divide(part.cast("double") * 100.0, whole.cast("double"))


def completeness(df: DataFrame, dataset: str) -> DataFrame:
    """``(dataset, total_rows, total_columns, complete_rows, column, missing_percentage)``.

    One pass over the table; the percentages of an empty table are NULL.
    """
    missing = {f.name: is_missing(f.name, f.dataType) for f in df.schema}
    any_missing = reduce(lambda a, b: a | b, missing.values())
    counts = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(~any_missing).alias("complete_rows"),
        F.array(
            *[F.struct(F.lit(c).alias("column"), F.count_if(m).alias("missing")) for c, m in missing.items()]
        ).alias("cells"),
    )
    return counts.select("total_rows", "complete_rows", F.inline("cells")).select(
        F.lit(dataset).alias("dataset"),
        "total_rows",
        F.lit(len(missing)).alias("total_columns"),
        "complete_rows",
        "column",
        _percent(F.col("missing"), F.col("total_rows")).alias("missing_percentage"),
    )


def uniqueness(df: DataFrame, dataset: str, keys: Sequence[str]) -> DataFrame:
    """``(dataset, key_columns, total_duplicates, duplicate_percentage)``.

    Rows after the first of each key are duplicates; NULL keys equal each other.
    """
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    counts = groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("total_duplicates"),
    )
    return counts.select(
        F.lit(dataset).alias("dataset"),
        F.lit(", ".join(keys)).alias("key_columns"),
        "total_duplicates",
        F.coalesce(_percent(F.col("total_duplicates"), F.col("rows")), F.lit(0.0)).alias("duplicate_percentage"),
    )


def quality_report(data: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """Both checks of every dataset as rows ``(check, measure, subject, value)``."""
    parts = []
    for name, df in data.items():
        check = F.lit(f"{name}_completeness")
        cells = completeness(df, name).select(
            "total_rows", "total_columns", "complete_rows", "column", "missing_percentage"
        )
        per_column = F.struct(
            F.lit("missing_percentage").alias("measure"),
            F.col("column").alias("subject"),
            F.col("missing_percentage").alias("value"),
        )
        per_table = [
            F.struct(F.lit(m).alias("measure"), F.lit(name).alias("subject"), F.col(m).cast("double").alias("value"))
            for m in ("total_rows", "total_columns", "complete_rows")
        ]
        # The table figures repeat on every column's row; take them from the first column only.
        first = F.col("column") == df.columns[0]
        rows = F.when(first, F.array(per_column, *per_table)).otherwise(F.array(per_column))
        parts.append(cells.select(check.alias("check"), F.inline(rows)))
        if name in keys:
            found = uniqueness(df, name, keys[name])
            measures = [
                F.struct(
                    F.lit(m).alias("measure"), F.col("key_columns").alias("subject"), F.col(m).cast("double").alias("value")
                )
                for m in ("total_duplicates", "duplicate_percentage")
            ]
            parts.append(found.select(F.lit(f"{name}_uniqueness").alias("check"), F.inline(F.array(*measures))))
    return union_all(parts)
