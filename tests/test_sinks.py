import json
from datetime import datetime
from glob import glob

import pytest
from pyspark.sql import functions as F

from comarca.sinks import documents, files, registry, tables, warehouse
from tests.conftest import as_rows, as_set


@pytest.fixture
def rows(spark):
    return spark.createDataFrame([(1, "x"), (2, None)], "a long, b string")


def test_replace_and_append(spark, rows):
    tables.replace_table(spark.range(9), "sink_t")
    tables.replace_table(rows, "sink_t")
    assert tables.loaded_rows(rows, "sink_t") == 2
    tables.append_table(rows.select("b", "a"), "sink_t")
    tables.append_table(rows.toDF("p", "q"), "sink_t", by_position=True)
    assert spark.table("sink_t").where("a = 1 AND b = 'x'").count() == 3
    with pytest.raises(ValueError):
        tables.append_table(rows.toDF("p", "q"), "sink_t")


def test_a_replacement_that_breaks_leaves_the_table(spark, rows, tmp_path):
    for path, parts in ((None, ()), (str(tmp_path / "t"), ("a",))):
        tables.replace_table(rows, "kept_t", path, parts)
        broken = spark.range(2000).select(
            F.when(F.col("id") < 1990, F.col("id")).otherwise(F.raise_error(F.lit("broken"))).alias("a"), F.lit("y").alias("b")
        ).repartition(8)
        with pytest.raises(Exception, match="broken"):
            tables.replace_table(broken, "kept_t", path, parts)
        assert as_set(spark.table("kept_t"), "a", "b") == {(1, "x"), (2, None)}
        assert [t.name for t in spark.catalog.listTables() if t.name.startswith("kept_t")] == ["kept_t"]
        # Other columns, from the table itself; the version before is gone then.
        tables.replace_table(spark.table("kept_t").selectExpr("a * 2 AS a", "b", "'new' AS c"), "kept_t", path, parts)
        assert as_set(spark.table("kept_t"), "a", "b", "c") == {(2, "x", "new"), (4, None, "new")}
        if path:
            assert len(list((tmp_path / "t").iterdir())) == 1
        tables.append_table(spark.table("kept_t"), "kept_t")
        assert spark.table("kept_t").count() == 4
    spark.sql("DROP TABLE kept_t")


def test_a_table_written_otherwise_is_replaced(spark, rows):
    spark.range(5).write.mode("overwrite").saveAsTable("plain_t")
    tables.replace_table(rows, "plain_t")
    assert as_set(spark.table("plain_t")) == {(1, "x"), (2, None)}
    spark.sql("DROP TABLE plain_t")


def test_partitioned_table(spark):
    df = spark.range(1000).select("id", (F.col("id") % 4).alias("year"))
    load = registry.table_loader(partition_by={"by_year": ["year"]})
    assert load(df, "by_year") == (1000, "by_year")
    assert len(spark.table("by_year").where("year = 2").inputFiles()) < len(spark.table("by_year").inputFiles())
    tables.append_table(df.select("year", "id"), "by_year")
    assert spark.table("by_year").where("year = 2 AND id % 4 = 2").count() == 500


def test_load_log_and_failure(spark, rows, tmp_path):
    record = registry.LoadLog()
    load = registry.table_loader()
    assert registry.load_one(rows, "logged", load, record)
    assert not registry.load_one(rows, "bad name!", load, record)
    (ok, bad) = as_rows(record.frame(spark).select("table", "rows_loaded", "status"))
    assert ok == ("logged", 2, "SUCCESS - logged")
    assert bad[:2] == ("bad name!", 0) and bad[2].startswith("FAILED: ")


def test_targets():
    assert registry.expand_targets() == ["table"]
    assert registry.expand_targets(["all", "file"]) == ["table", "warehouse"]
    assert registry.expand_targets(["file", "table"]) == ["file", "table"]


def test_load_all_skips_empty_tables(spark, rows, tmp_path):
    loaders = {"file": registry.file_loader(str(tmp_path), "csv")}
    assert registry.load_all({"a": rows, "none": rows.limit(0)}, "file", loaders) == {"a": True, "none": False}
    assert glob(f"{tmp_path}/fact_a_*.csv") and not glob(f"{tmp_path}/fact_none_*")
    with pytest.raises(ValueError):
        registry.load_all({}, "tape", loaders)


def test_paths_carry_the_time(rows, tmp_path):
    at = datetime(2024, 1, 2, 3, 4, 5)
    assert files.export_object(rows, str(tmp_path), "t", at=at) == f"{tmp_path}/data/t/20240102_030405.jsonl"
    assert files.export_object(rows, str(tmp_path), "t", "other", at) == f"{tmp_path}/data/t/20240102_030405.csv"
    assert files.export_file(rows, str(tmp_path), "t", at=at) == f"{tmp_path}/t_20240102_030405.parquet"
    with pytest.raises(ValueError):
        files.export_file(rows, str(tmp_path), "t", "avro", at)


def test_json_keeps_nulls(spark, rows, tmp_path):
    path = files.export_object(rows, str(tmp_path), "t")
    lines = [json.loads(r.value) for r in spark.read.text(path).collect()]
    assert {"a": 2, "b": None} in lines


def test_stage_reads_back_what_was_written(rows, tmp_path):
    staged = files.stage_parquet(rows, f"{tmp_path}/s")
    assert as_set(staged) == {(1, "x"), (2, None)}
    assert as_set(files.stage_parquet(rows.where("a = 1"), f"{tmp_path}/s")) == {(1, "x")}


def test_summaries(spark, rows, tmp_path):
    paths = files.export_summaries({"one": rows, "two": rows.where("a = 2")}, str(tmp_path), "parquet")
    assert {name: spark.read.parquet(p).count() for name, p in paths.items()} == {"one": 2, "two": 1}


def test_documents(rows):
    found = {r.id: r for r in documents.to_documents(rows, "a").collect()}
    assert json.loads(found["2"].jsonData) == {"a": 2, "b": None}
    assert found["1"].structData.asDict() == {"a": 1, "b": "x"}
    numbered = documents.to_documents(rows, "absent", ["b"])
    assert as_set(numbered.select("id", "structData.a")) == {("0", 1), ("1", 2)}
    with pytest.raises(ValueError):
        documents.to_documents(rows, "absent")


def test_warehouse_preparation(spark):
    df = spark.sql(
        "SELECT 1 AS `a b`, CAST('NaN' AS DOUBLE) AS `x.y`, TIMESTAMP'2024-01-02 03:04:05' AS t, true AS ok, 'q' AS s, "
        "CAST(NULL AS TIMESTAMP) AS none, CAST(2.5 AS FLOAT) AS f"
    )
    ready = warehouse.prepare(df)
    assert as_rows(ready) == [(1, None, "2024-01-02 03:04:05", True, "q", None, 2.5)]
    assert warehouse.column_types(ready) == {
        "A_B": "INTEGER",
        "X_Y": "FLOAT",
        "T": "VARCHAR(16777216)",
        "OK": "BOOLEAN",
        "S": "VARCHAR(16777216)",
        "NONE": "VARCHAR(16777216)",
        "F": "FLOAT",
    }
    assert ("X_Y", "FLOAT", 0) in as_set(warehouse.load_plan(df))


def test_unreachable_warehouse_is_a_failed_load(spark, rows):
    record = registry.LoadLog()
    load = registry.warehouse_loader("jdbc:nosuchdriver://nowhere", properties={"user": "u"})
    assert not registry.load_one(rows, "t", load, record)
    assert record.frame(spark).where(F.col("status").startswith("FAILED")).count() == 1
