"""Distinct counts from sketches that are stored once and merged for any span."""

from __future__ import annotations

from collections.abc import Sequence
from math import sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 2^14 registers of a sketch: 16 KB at most, whatever it has seen.
REGISTERS = 14


def distinct_sketches(df: DataFrame, counted: str, by: Sequence[str], registers: int = REGISTERS) -> DataFrame:
    """``(by…, sketch)``: one sketch of the distinct values of ``counted`` per group, merged before the shuffle.

    NULL is no value. Values of any type count by their text.
    """
    return df.groupBy(*by).agg(F.hll_sketch_agg(F.col(counted).cast("string"), registers).alias("sketch"))


def merged_counts(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """``(by…, estimate)`` over all sketches of a group, which no row is read again for."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def largest_error(exact: Column, registers: int = REGISTERS, deviations: float = 4.0) -> Column:
    """How far an estimate may be off: so many standard deviations of 1.04 / sqrt(2^registers), and one value."""
    return exact * (deviations * 1.04 / sqrt(2**registers)) + 1
