import pytest

from comarca.operators import quality
from tests.conftest import as_rows, as_set


def test_completeness(spark):
    df = spark.createDataFrame([(1.0, 4), (2.0, 5), (None, 6), (float("nan"), 7)], "a double, b long")
    assert as_rows(quality.completeness(df, "t")) == [("t", 4, 2, 2, "a", 50.0), ("t", 4, 2, 2, "b", 0.0)]


def test_completeness_of_an_empty_table(spark):
    df = spark.createDataFrame([], "a double, b long")
    assert as_rows(quality.completeness(df, "t")) == [("t", 0, 2, 0, "a", None), ("t", 0, 2, 0, "b", None)]


def test_uniqueness(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id long, value string")
    (row,) = as_rows(quality.uniqueness(df, "t", ["id"]))
    assert row[:3] == ("t", "id", 1) and row[3] == pytest.approx(100 / 3)


def test_null_keys_equal_each_other(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (1, 1)], "k long, j long")
    assert quality.uniqueness(df, "t", ["k", "j"]).first().total_duplicates == 1
    assert as_rows(quality.uniqueness(df.limit(0), "t", ["k"])) == [("t", "k", 0, 0.0)]


def test_report(spark):
    df = spark.createDataFrame([(None, 1), (1, 1)], "k long, j long")
    assert as_set(quality.quality_report({"t": df, "u": df.select("j")}, {"t": ["j"]})) == {
        ("t_completeness", "missing_percentage", "k", 50.0),
        ("t_completeness", "missing_percentage", "j", 0.0),
        ("t_completeness", "total_rows", "t", 2.0),
        ("t_completeness", "total_columns", "t", 2.0),
        ("t_completeness", "complete_rows", "t", 1.0),
        ("t_uniqueness", "total_duplicates", "j", 1.0),
        ("t_uniqueness", "duplicate_percentage", "j", 50.0),
        ("u_completeness", "missing_percentage", "j", 0.0),
        ("u_completeness", "total_rows", "u", 2.0),
        ("u_completeness", "total_columns", "u", 1.0),
        ("u_completeness", "complete_rows", "u", 2.0),
    }
