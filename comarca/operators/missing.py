"""Missing-value strategies. NaN counts as missing on floating columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comarca.functions.scalars import is_missing, null_if_nan
from comarca.operators.ordered import forward_fill

STRATEGIES = ("drop", "fill_zero", "fill_mean", "fill_forward")


def drop_missing(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=list(subset) if subset else None)


def fill_zero(df: DataFrame) -> DataFrame:
    """0 in numeric columns and ``'0'`` in text columns."""
    return df.na.fill(0).na.fill("0")


def fill_mean(df: DataFrame) -> DataFrame:
    """Column mean in numeric columns, all means from one pass over the table.

    Whole-number columns become double, since a mean need not be whole.
    """
    numeric = [f for f in df.schema if isinstance(f.dataType, T.NumericType)]
    if not numeric:
        return df
    cells = {f.name: null_if_nan(f.name, f.dataType).cast("double") for f in numeric}
    means = df.agg(F.struct(*[F.avg(cell).alias(name) for name, cell in cells.items()])).scalar()
    return df.withColumns({name: F.coalesce(cell, means.getField(name)) for name, cell in cells.items()})


def handle_missing(
    df: DataFrame, strategy: str = "drop", order: Sequence[str] = (), by: Sequence[str] = ()
) -> DataFrame:
    if strategy == "drop":
        return drop_missing(df)
    if strategy == "fill_zero":
        return fill_zero(df)
    if strategy == "fill_mean":
        return fill_mean(df)
    if strategy == "fill_forward":
        if not order:
            raise ValueError("fill_forward needs an order key")
        return forward_fill(df, [c for c in df.columns if c not in (*order, *by)], order, by)
    raise ValueError(f"unknown strategy: {strategy}")


def _missing_cells(df: DataFrame):
    flags = [is_missing(f.name, f.dataType).cast("long") for f in df.schema]
    return F.coalesce(F.sum(reduce(lambda a, b: a + b, flags)), F.lit(0))


def missing_report(before: DataFrame, after: DataFrame, strategy: str) -> DataFrame:
    """Rows and missing cells on both sides, and the step's ``affected`` figure.

    ``affected`` counts removed rows for ``drop`` and, for the fills, the cells
    still missing afterwards.
    """
    counts = [
        df.agg(F.count(F.lit(1)).alias(f"rows_{side}"), _missing_cells(df).alias(f"missing_{side}"))
        for side, df in (("before", before), ("after", after))
    ]
    first = counts[0].agg(F.first(F.struct("*"))).scalar()
    report = counts[1].select(
        F.lit(strategy).alias("strategy"),
        first.getField("rows_before").alias("rows_before"),
        "rows_after",
        first.getField("missing_before").alias("missing_before"),
        "missing_after",
    )
    removed = F.col("rows_before") - F.col("rows_after")
    return report.withColumn("affected", removed if strategy == "drop" else F.col("missing_after"))
