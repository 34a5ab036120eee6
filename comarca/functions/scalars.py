"""Scalar expressions shared by the transforms and the reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Class edges and labels of the depopulation percentage.
CATEGORY_EDGES = (0, 25, 50, 75, 100)
CATEGORY_LABELS = ("Low", "Medium", "High", "Very High")


def bucketize(
    value: Column, edges: Sequence[float] = CATEGORY_EDGES, labels: Sequence[str] = CATEGORY_LABELS
) -> Column:
    """Label of the right-closed interval holding ``value``; NULL outside all of them."""
    label = F.lit(None).cast("string")
    for low, high, name in reversed(list(zip(edges, edges[1:], labels))):
        label = F.when((value > low) & (value <= high), F.lit(name)).otherwise(label)
    return label


def label_rank(label: Column, labels: Sequence[str] = CATEGORY_LABELS) -> Column:
    """1-based position of a label in its class order; NULL for other labels."""
    position = F.array_position(F.array(*[F.lit(name) for name in labels]), label)
    return F.nullif(position, F.lit(0)).cast("int")


def coerce_number(value: Column, type_name: str = "double") -> Column:
    """The number written in ``value``, or NULL where it is not one.

    Whole-number types also accept ``2010.0`` and ``1e3``. Java's type suffixes,
    as in ``1d``, do not make a number.
    """
    plain = ~value.cast("string").rlike(r"[0-9.]\s*[dDfF]\s*$")
    number = F.when(plain, value.try_cast("double"))
    if type_name in ("double", "float"):
        return number.cast(type_name)
    whole = F.when(number == F.floor(number), number.try_cast(type_name))
    return F.coalesce(value.try_cast(type_name), whole)


def leading_code(value: Column) -> Column:
    """Digits at the start of the text; NULL (not '') where there are none."""
    return F.nullif(F.regexp_extract(value, r"(?Ud)^(\d+)", 1), F.lit(""))


def name_after_code(value: Column) -> Column:
    """Text following the first run of digits and blanks; NULL where there is none."""
    return F.nullif(F.regexp_extract(value, r"(?Ud)\d+\s+(.+)$", 1), F.lit(""))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; NULL for a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent_change(new: Column, old: Column) -> Column:
    return F.round(ratio((new - old) * F.lit(100.0), F.nullif(old, F.lit(0))), 2)


def thousands(value: Column) -> Column:
    """Whole number with thousands separators."""
    return F.format_number(value, 0)


def contains_ignoring_case(value: Column, fragment: str) -> Column:
    """Substring test in which ``%`` and ``_`` of the fragment stay wildcards."""
    pattern = "%" + fragment.replace("\\", "\\\\") + "%"
    return F.like(F.lower(value), F.lower(F.lit(pattern)))


def scaled(value: Column, unit: float) -> Column:
    return value / F.lit(float(unit))


def timestamp_text(value: Column) -> Column:
    """Timestamp as text, with the fraction only where there is one."""
    return value.cast("string")


def is_missing(name: str, data_type: T.DataType) -> Column:
    """True for NULL and, on floating columns, for NaN."""
    column = F.col(f"`{name}`")
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def null_if_nan(name: str, data_type: T.DataType) -> Column:
    column = F.col(f"`{name}`")
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return F.nullif(column, F.lit(float("nan")).cast(data_type))
    return column
