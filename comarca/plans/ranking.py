"""Ordering shared by the reports. Rows without a value come last."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def descending(df: DataFrame, measure: str, *ties: str) -> DataFrame:
    return df.orderBy(F.col(measure).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in ties])


def top(df: DataFrame, measure: str, k: int, *ties: str) -> DataFrame:
    """The ``k`` largest by ``measure``; ``ties`` make the cut repeatable."""
    return descending(df, measure, *ties).limit(k)


def largest(df: DataFrame, measure: str, k: int | None, *ties: str) -> DataFrame:
    return descending(df, measure, *ties) if k is None else top(df, measure, k, *ties)


def sample_rows(df: DataFrame, n: int = 3, order: list[str] | None = None) -> DataFrame:
    """Any ``n`` rows, or the first ones by ``order`` where a repeatable sample is wanted."""
    return (df.orderBy(*order) if order else df).limit(n)


def rounded_mean(column: str, digits: int) -> Column:
    return F.round(F.avg(column), digits)


def rounded_sum(column: str, digits: int = 0) -> Column:
    return F.round(F.sum(column), digits)
