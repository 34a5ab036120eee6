from pyspark.sql import functions as F

from comarca.functions import naming, scalars
from tests.conftest import as_rows


def test_plain_names():
    assert naming.plain_name("Column Name") == "column_name"
    assert naming.plain_name("Another-Column") == "anothercolumn"
    assert naming.plain_name(" AAEE Sección (CNAE09) ") == "aaee_seccion_cnae09"
    assert naming.plain_name("Año·") == "ano"


def test_repeated_names_are_numbered():
    assert naming.unique_names(["a", "a", "a_2", "a"]) == ["a", "a_3", "a_2", "a_4"]


def test_clean_names_keeps_data(spark):
    cleaned = naming.clean_names(spark.createDataFrame([(1, 2)], "`Column Name` long, `Another-Column` long"))
    assert cleaned.columns == ["column_name", "anothercolumn"]
    assert as_rows(cleaned) == [(1, 2)]


def test_warehouse_names(spark):
    df = naming.warehouse_names(spark.createDataFrame([(1, 2)], "`a.b c` long, d long"))
    assert df.columns == ["A_B_C", "D"]


def test_bucket_edges_are_right_closed(spark):
    values = [(0.0,), (-1.0,), (25.0,), (25.5,), (50.0,), (75.0,), (100.0,), (101.0,), (None,)]
    df = spark.createDataFrame(values, "x double")
    label = scalars.bucketize(F.col("x"))
    rows = as_rows(df.select("x", label.alias("l"), scalars.label_rank(label).alias("r")))
    assert rows == [
        (0.0, None, None),
        (-1.0, None, None),
        (25.0, "Low", 1),
        (25.5, "Medium", 2),
        (50.0, "Medium", 2),
        (75.0, "High", 3),
        (100.0, "Very High", 4),
        (101.0, None, None),
        (None, None, None),
    ]


def test_unknown_label_has_no_rank(spark):
    df = spark.createDataFrame([("Bajo",), (None,)], "l string")
    assert as_rows(df.select(scalars.label_rank(F.col("l")))) == [(None,), (None,)]


def test_codes_and_names(spark):
    df = spark.createDataFrame([("01051 Agurain/Salvatierra",), ("abc",), ("x 12 Y z",), (None,), ("1 a\rb\n",)], "m string")
    rows = as_rows(df.select(scalars.leading_code(F.col("m")), scalars.name_after_code(F.col("m"))))
    assert rows == [("01051", "Agurain/Salvatierra"), (None, None), (None, "Y z"), (None, None), ("1", "a\rb")]


def test_unicode_digits_count_as_digits(spark):
    df = spark.createDataFrame([("٣٤ Casa",)], "m string")
    assert as_rows(df.select(scalars.leading_code(F.col("m")))) == [("٣٤",)]


def test_coercion(spark):
    cases = {
        "1": (1.0, 1),
        "..": (None, None),
        "2.5": (2.5, None),
        "2010.0": (2010.0, 2010),
        "1e3": (1000.0, 1000),
        " 12 ": (12.0, 12),
        "1d": (None, None),
        "1.f": (None, None),
        "1_000": (None, None),
        "": (None, None),
        "inf": (float("inf"), None),
        None: (None, None),
    }
    df = spark.createDataFrame([(text,) for text in cases], "t string")
    rows = df.select("t", scalars.coerce_number(F.col("t")), scalars.coerce_number(F.col("t"), "int")).collect()
    assert {r[0]: (r[1], r[2]) for r in rows} == cases


def test_coercion_keeps_long_numbers_exact(spark):
    df = spark.createDataFrame([("9007199254740993",)], "t string")
    assert as_rows(df.select(scalars.coerce_number(F.col("t"), "long"))) == [(9007199254740993,)]


def test_ratio_by_zero_is_null(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (3, 2)], "a long, b long")
    assert as_rows(df.select(scalars.ratio(F.col("a"), F.col("b")))) == [(None,), (None,), (1.5,)]


def test_percent_change(spark):
    df = spark.createDataFrame([(110.0, 100.0), (1.0, 0.0), (90.0, 100.0)], "n double, o double")
    assert as_rows(df.select(scalars.percent_change(F.col("n"), F.col("o")))) == [(10.0,), (None,), (-10.0,)]


def test_contains_keeps_accents_wildcards_and_backslashes(spark):
    df = spark.createDataFrame([("ÁVILA",), ("Avila",), ("a\\b",)], "p string")

    def hits(fragment):
        return [r[0] for r in df.where(scalars.contains_ignoring_case(F.col("p"), fragment)).collect()]

    assert hits("ávi") == ["ÁVILA"]
    assert hits("v_la") == ["ÁVILA", "Avila"]
    assert hits("\\B") == ["a\\b"]
    assert hits("'; DROP") == []


def test_thousands(spark):
    df = spark.createDataFrame([(1234567.5,), (999.4,)], "x double")
    assert as_rows(df.select(scalars.thousands(F.col("x")))) == [("1,234,568",), ("999",)]
