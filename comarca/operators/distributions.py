"""Descriptive statistics, histograms and box-plot figures, all exact."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comarca.functions.scalars import null_if_nan
from comarca.sinks.pinned import pin

QUARTILES = (0.25, 0.5, 0.75)
# Ranks of the sketch are off by a share of 1 / _ACCURACY of the rows at most.
_ACCURACY = 10_000


def _numeric(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema}
    return df.select(*by, *[null_if_nan(c, types[c]).cast("double").alias(c) for c in columns])


def _figures(column: str, probs: Sequence[float]) -> Column:
    """Count, least, largest and, around each wanted rank, two values that surely enclose it."""
    around = [x for p in probs for x in (max(0.0, p - 4 / _ACCURACY), min(1.0, p + 4 / _ACCURACY))]
    return F.struct(
        F.count(column).alias("n"), F.min(column).alias("least"), F.max(column).alias("most"),
        F.percentile_approx(column, [float(x) for x in around], _ACCURACY).alias("around"),
    )


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float] = QUARTILES,
    by: Sequence[str] = (),
    figures: DataFrame | None = None,
) -> DataFrame:
    """Interpolated quantiles: ``(by…, column, p, value)``.

    Two passes: a sketch with bounded rank errors gives two values that enclose each wanted
    rank; then rows below them are counted and the values between them, some of every
    thousand rows, are collapsed and ranked exactly. Columns of fewer rows than the sketch
    is accurate to are enclosed by their ends. A caller that has the ``figures`` of the
    columns (one row per group) saves the first pass. Infinities are values like others.
    """
    wide = _numeric(df, columns, by)
    if figures is None:
        figures = wide.groupBy(*by).agg(*[_figures(c, probs).alias(f"_figures_{i}") for i, c in enumerate(columns)])
    # One row per group; written, so that Spark knows its size.
    figures = pin(figures.select(*[F.col(c).alias(f"_of_{c}") for c in by], *[f"_figures_{i}" for i in range(len(columns))]), "figures")
    if by:
        rows = wide.join(figures, reduce(and_, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by]))
    else:
        (only,) = figures.collect() or [None]
        rows = wide.withColumns({f"_figures_{i}": _literal(only[i]) for i in range(len(columns))}) if only else wide

    def end(i: int, j: int, side: int) -> Column:
        f = F.col(f"_figures_{i}")
        whole = f["least"] if side == 0 else f["most"]
        return F.when(f["n"] < _ACCURACY, whole).otherwise(f["around"][2 * j + side])

    wanted = [(i, c, j, p) for i, c in enumerate(columns) for j, p in enumerate(probs)]
    below = [F.count_if(F.col(c) < end(i, j, 0)).alias(f"_below_{i}_{j}") for i, c, j, _ in wanted]
    totals = [F.first(F.col(f"_figures_{i}")["n"]).alias(f"_n_{i}") for i in range(len(columns))]
    counted = rows.groupBy(*by).agg(*below, *totals)
    starts = [
        F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("p"), F.col(f"_below_{i}_{j}").alias("below"), F.col(f"_n_{i}").alias("n"))
        for i, _, j, p in wanted
    ]
    starts = counted.select(*[F.col(c).alias(f"_of_{c}") for c in by], F.explode(F.array(*starts)).alias("_s"))
    cells = [
        F.when(F.col(c).between(end(i, j, 0), end(i, j, 1)), F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("p"), F.col(c).alias("value")))
        for i, c, j, p in wanted
    ]
    near = rows.select(*by, F.explode(F.array_compact(F.array(*cells))).alias("_cell")).select(*by, "_cell.*")
    near = near.groupBy(*by, "i", "p", "value").agg(F.count(F.lit(1)).alias("times"))
    # A few of every ten thousand rows at most, equal values collapsed.
    upto = F.sum("times").over(W.partitionBy(*by, "i", "p").orderBy("value").rowsBetween(W.unboundedPreceding, W.currentRow))
    placed = near.withColumn("upto", upto)
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by] + [placed.i == F.col("_s.i"), placed.p == F.col("_s.p")]
    # One row per group, column and share.
    ranked = placed.join(pin(starts, "rank-starts"), reduce(and_, same))
    position = F.col("p") * (F.col("_s.n") - 1)
    first, last = F.col("_s.below") + F.col("upto") - F.col("times"), F.col("_s.below") + F.col("upto")

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= first) & (rank < last), F.col("value")))

    ranked = ranked.select(*by, "i", placed.p.alias("p"), "value", "upto", "times", "_s")
    ends = ranked.groupBy(*by, "i", "p").agg(
        at(F.floor(position)).alias("low"), at(F.ceil(position)).alias("high"), F.first(position).alias("position")
    )
    low, high = F.col("low"), F.col("high")
    weight = F.col("position") - F.floor("position")
    between = F.when((low == high) | (weight == 0), low).otherwise(low + (high - low) * weight)
    name = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("i") + 1)
    return ends.select(*by, name.alias("column"), "p", between.alias("value"))


def _literal(figures) -> Column:
    """A row of figures as part of the plan."""
    around = F.array(*[F.lit(x).cast("double") for x in figures["around"] or [None]])
    return F.struct(
        F.lit(figures["n"]).alias("n"), F.lit(figures["least"]).cast("double").alias("least"),
        F.lit(figures["most"]).cast("double").alias("most"), around.alias("around"),
    )


def quartile_table(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), figures: DataFrame | None = None
) -> DataFrame:
    """``(by…, column, q1, median, q3)``."""
    found = quantiles(df, columns, QUARTILES, by, figures)
    at = [
        F.max(F.when(F.col("p") == p, F.col("value"))).alias(name)
        for name, p in zip(("q1", "median", "q3"), QUARTILES)
    ]
    return found.groupBy(*by, "column").agg(*at)


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, count, mean, std, min, q1, median, q3, max)`` of every numeric column.

    The first of two passes gives the plain figures and the sketches: one row.
    """
    columns = columns or [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    found = pin(
        _numeric(df, columns).agg(
            *[_figures(c, QUARTILES).alias(f"_figures_{i}") for i, c in enumerate(columns)],
            *[F.struct(F.avg(c).alias("mean"), F.stddev_samp(c).alias("std")).alias(f"_plain_{i}") for i, c in enumerate(columns)],
        ),
        "figures",
    )
    plain = [
        F.struct(
            F.lit(c).alias("column"), F.col(f"_figures_{i}.n").alias("count"), F.col(f"_plain_{i}.mean").alias("mean"),
            F.col(f"_plain_{i}.std").alias("std"), F.col(f"_figures_{i}.least").alias("min"), F.col(f"_figures_{i}.most").alias("max"),
        )
        for i, c in enumerate(columns)
    ]
    rows = found.select(F.explode(F.array(*plain)).alias("_row")).select("_row.*")
    quartiles = quartile_table(df, columns, figures=found)
    # One row per column.
    joined = rows.join(F.broadcast(quartiles), "column", "left")
    return joined.select("column", "count", "mean", "std", "min", "q1", "median", "q3", "max")


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """``(bin, bin_start, bin_end, count)`` of equal-width bins; the last one holds the maximum.

    Bins without rows are listed with 0.
    """
    wide = _numeric(df, [column])
    values = wide.where(F.col(column).isNotNull())
    lowest, highest = F.min(column), F.max(column)
    # A single value gets a unit-wide range around it.
    half = F.when(lowest == highest, F.lit(0.5)).otherwise(F.lit(0.0))
    span = values.agg(F.struct((lowest - half).alias("low"), (highest + half).alias("high"))).scalar()
    low, high = span.getField("low"), span.getField("high")
    step = (high - low) / bins
    number = F.least(F.floor((F.col(column) - low) / step), F.lit(bins - 1)).cast("int")
    counted = values.groupBy(number.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(F.broadcast(counted), "bin", "left").select(
        "bin",
        (low + F.col("bin") * step).alias("bin_start"),
        (low + (F.col("bin") + 1) * step).alias("bin_end"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def _with_fences(df: DataFrame, column: str, by: str) -> DataFrame:
    values = _numeric(df, [column], [by]).where(F.col(column).isNotNull() & F.col(by).isNotNull())
    quartiles = pin(quartile_table(values, [column], [by]).drop("column"), "quartiles")
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    return values.join(quartiles, by).withColumns({"_low": F.col("q1") - reach, "_high": F.col("q3") + reach})


def boxplot_stats(df: DataFrame, column: str, by: str) -> DataFrame:
    """``(by, count, whisker_low, q1, median, q3, whisker_high, outliers)`` per group.

    Whiskers end at the last value within 1.5 interquartile ranges of the box.
    """
    value = F.col(column)
    inside = value.between(F.col("_low"), F.col("_high"))
    stats = (
        _with_fences(df, column, by)
        .groupBy(by, "q1", "median", "q3")
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.min(F.when(inside, value)).alias("_least"),
            F.max(F.when(inside, value)).alias("_most"),
            F.count_if(~inside).alias("outliers"),
        )
    )
    return stats.select(
        by,
        "count",
        F.least("_least", "q1").alias("whisker_low"),
        "q1",
        "median",
        "q3",
        F.greatest("_most", "q3").alias("whisker_high"),
        "outliers",
    )


def boxplot_outliers(df: DataFrame, column: str, by: str) -> DataFrame:
    """``(by, column)`` of the values beyond the whiskers."""
    value = F.col(column)
    return _with_fences(df, column, by).where((value < F.col("_low")) | (value > F.col("_high"))).select(by, column)
