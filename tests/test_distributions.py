import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from comarca.operators import distributions
from tests.conftest import as_rows


@pytest.fixture(scope="module")
def skewed():
    draw = np.random.default_rng(3)
    values = np.concatenate([np.full(700, 42.0), draw.lognormal(3, 2, 1200), [np.nan] * 100, [-1e6, 1e6]])
    groups = np.where(draw.random(len(values)) < 0.4, "hot", draw.choice(list("abcdefgh"), len(values)))
    return pd.DataFrame({"g": groups, "x": values, "n": draw.integers(0, 9, len(values))})


def test_describe_equals_pandas(spark, skewed):
    expected = skewed[["x", "n"]].describe()
    df = spark.createDataFrame(skewed, "g string, x double, n long").repartition(5)
    found = distributions.describe(df).toPandas().set_index("column")
    for column in ("x", "n"):
        mine = found.loc[column, ["count", "mean", "std", "min", "q1", "median", "q3", "max"]].astype(float)
        np.testing.assert_allclose(mine, expected[column], rtol=1e-10)


def test_quantiles_by_group_equal_numpy(spark, skewed):
    df = spark.createDataFrame(skewed, "g string, x double, n long")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    found = distributions.quantiles(df, ["x"], probs, ["g"]).collect()
    values = {(r.g, r.p): r.value for r in found}
    for group, part in skewed.dropna().groupby("g"):
        for p in probs:
            assert values[group, p] == pytest.approx(np.quantile(part["x"], p), rel=1e-12)
    assert len(values) == 9 * len(probs)


@pytest.mark.parametrize("accuracy", [4, 40, 400, 10_000])
def test_quantiles_are_exact_whatever_the_sketch(spark, monkeypatch, accuracy):
    monkeypatch.setattr(distributions, "_ACCURACY", accuracy)
    rng = np.random.default_rng(1)
    groups = {"a": rng.normal(size=20_000), "b": rng.integers(0, 7, 15_000).astype(float), "c": rng.exponential(size=41), "d": np.zeros(900)}
    rows = [(g, float(v), float(-v)) for g, values in groups.items() for v in values]
    df = spark.createDataFrame(rows, "g string, x double, y double").repartition(6)
    probs = (0.0, 0.001, 0.25, 0.5, 0.75, 0.9999, 1.0)
    found = {(r.g, r.column, r.p): r.value for r in distributions.quantiles(df, ["x", "y"], probs, ["g"]).collect()}
    want = {(g, c, p): np.quantile(s * values, p) for g, values in groups.items() for c, s in (("x", 1), ("y", -1)) for p in probs}
    assert found == pytest.approx(want, rel=1e-12, abs=1e-15)
    found = {(r.column, r.p): r.value for r in distributions.quantiles(df, ["x"], probs).collect()}
    every = np.concatenate(list(groups.values()))
    assert found == pytest.approx({("x", p): np.quantile(every, p) for p in probs}, rel=1e-12, abs=1e-15)


def test_infinities_are_values(spark):
    infinite = float("inf")
    df = spark.createDataFrame([(v,) for v in [1.0, 2.0, 3.0, 4.0, infinite, infinite, -infinite]], "x double")
    row = distributions.describe(df).first()
    assert (row["count"], row["min"], row["q1"], row["median"], row["q3"], row["max"]) == (
        7, -infinite, 1.5, 3.0, infinite, infinite,
    )


def test_describe_of_single_and_missing_values(spark):
    df = spark.createDataFrame([(1.0, None), (None, None)], "x double, y double")
    found = {r["column"]: tuple(r)[1:] for r in distributions.describe(df).collect()}
    assert found["x"] == (1, 1.0, None, 1.0, 1.0, 1.0, 1.0, 1.0)
    assert found["y"] == (0, None, None, None, None, None, None, None)


def test_histogram_equals_numpy(spark, skewed):
    values = skewed["n"].to_numpy()
    counts, edges = np.histogram(values, bins=5)
    rows = sorted(as_rows(distributions.histogram(spark.createDataFrame(skewed, "g string, x double, n long"), "n", 5)))
    assert [r[3] for r in rows] == counts.tolist()
    np.testing.assert_allclose([r[1] for r in rows] + [rows[-1][2]], edges)


def test_histogram_lists_empty_bins_and_single_values(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (10.0,)], "x double")
    assert [r[3] for r in sorted(as_rows(distributions.histogram(df, "x", 4)))] == [1, 0, 0, 2]
    single = distributions.histogram(spark.createDataFrame([(5.0,)], "x double"), "x", 2)
    assert sorted(as_rows(single)) == [(0, 4.5, 5.0, 0), (1, 5.0, 5.5, 1)]


def test_boxplot(spark):
    rows = [("a", float(v)) for v in (1, 2, 3, 4, 5, 100)] + [("b", 7.0), (None, 1.0), ("a", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    found = {r.g: r for r in distributions.boxplot_stats(df, "x", "g").collect()}
    a = found["a"]
    assert (a["count"], a.whisker_low, a.q1, a.median, a.q3, a.whisker_high, a.outliers) == (6, 1, 2.25, 3.5, 4.75, 5, 1)
    assert found["b"].outliers == 0 and found["b"].whisker_high == 7
    assert set(found) == {"a", "b"}
    assert as_rows(distributions.boxplot_outliers(df, "x", "g")) == [("a", 100.0)]


def test_boxplot_whisker_never_lies_inside_the_box(spark):
    values = [0.0, 10.0, 10.0, 10.0, 10.0]
    df = spark.createDataFrame([("a", v) for v in values], "g string, x double").select("g", F.col("x"))
    row = distributions.boxplot_stats(df, "x", "g").first()
    assert (row.whisker_low, row.q1, row.outliers) == (10.0, 10.0, 1)
