"""Headers by name, quotes and line breaks in CSV, and exports that come back whole."""

import pytest

from comarca.plans.etl import Run
from comarca.sinks.files import export_csv
from comarca.sinks.registry import table_loader
from comarca.sources.delimited import csv_options, read_file, read_folder

QUOTED = 'b;a;c\n1;"say ""hi""; now";x\n2;"two\nlines";\n'


def test_one_file_is_read_by_header_name(spark, tmp_path):
    (tmp_path / "f.csv").write_text(QUOTED)
    got = read_file(spark, str(tmp_path / "f.csv"), "a string, b int, absent int", multi_line=True)
    assert got.columns == ["a", "b", "absent", "c", "source_file"]
    assert [tuple(r)[:4] for r in got.collect()] == [('say "hi"; now', 1, None, "x"), ("two\nlines", 2, None, None)]


def test_a_folder_keeps_line_breaks_in_quotes(spark, tmp_path):
    (tmp_path / "f.csv").write_text(QUOTED)
    (tmp_path / "g.csv").write_text("a;b;c\nplain;3;z\n")
    got = read_folder(spark, str(tmp_path), "a string, b int", multi_line=True)
    assert {(r.a, r.b) for r in got.collect()} == {('say "hi"; now', 1), ("two\nlines", 2), ("plain", 3)}


def test_exported_text_comes_back(spark, tmp_path):
    texts = ['say "hi"', "two\nlines", " blanks ", "back\\slash", "a,b", '"', "", None, "é"]
    path = export_csv(spark.createDataFrame(list(enumerate(texts)), "i int, t string"), str(tmp_path / "out"))
    got = spark.read.schema("i int, t string").options(**csv_options(",", True)).csv(path).collect()
    # Spark reads an empty text as NULL; everything else comes back as it was.
    assert {r.i: r.t for r in got} == {i: t or None for i, t in enumerate(texts)}


@pytest.mark.parametrize("anyway", [False, True])
def test_a_failed_transform_is_no_success(spark, anyway):
    def broken(df, steps):
        raise ValueError("boom")

    spark.createDataFrame([(1,)], "good int").write.mode("overwrite").saveAsTable("fact_s")
    run = Run(spark, {"s": lambda spark: spark.createDataFrame([(2,)], "raw int")}, {"table": table_loader()},
              transforms={"s": broken}, load_untransformed=anyway)
    assert run.run() is False and run.errors["s"] == "boom"
    assert ("raw" in spark.table("fact_s").columns) is anyway
    spark.sql("DROP TABLE fact_s")
