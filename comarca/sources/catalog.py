"""What tables there are, and what is in them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comarca.operators.combine import union_all

_INFO = "table_name string, row_count long, position int, column_name string, column_type string, error string"


def table_names(spark: SparkSession) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables())


def list_tables(spark: SparkSession, names: Sequence[str] | None = None) -> DataFrame:
    """``(table_name, readable_rows)`` of the catalog's tables: each one is opened and counted."""
    return union_all(
        [
            spark.table(name).agg(F.count(F.lit(1)).alias("readable_rows")).select(
                F.lit(name).alias("table_name"), "readable_rows"
            )
            for name in names or table_names(spark)
        ]
    )


def table_info(spark: SparkSession, name: str) -> DataFrame:
    """One row per column with the table's row count; a missing table gives one error row."""
    try:
        df = spark.table(name)
    except AnalysisException as error:
        return spark.createDataFrame([(name, None, None, None, None, str(error))], _INFO)
    columns = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("column_type"),
            )
            for i, f in enumerate(df.schema, 1)
        ]
    )
    counted = df.agg(F.count(F.lit(1)).alias("row_count"))
    return counted.select(
        F.lit(name).alias("table_name"), "row_count", F.inline(columns), F.lit(None).cast("string").alias("error")
    )


def tables_info(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """The same for several tables: the check that follows a load."""
    return union_all([table_info(spark, name) for name in names])


def profile_tables(spark: SparkSession, names: Sequence[str] | None = None, sample: int = 3) -> DataFrame:
    """``(table_name, columns, row_count, sample)``; samples are any few rows, as JSON."""
    parts = []
    for name in names or table_names(spark):
        df = spark.table(name)
        columns = ", ".join(f"{f.name} ({f.dataType.simpleString()})" for f in df.schema)
        # A few rows by a limit, so that they stay in the one query and out of its text.
        few = df.select(F.to_json(F.struct("*")).alias("row")).limit(sample).agg(F.collect_list("row").alias("sample"))
        counted = df.agg(F.count(F.lit(1)).alias("row_count"))
        # One row on either side.
        parts.append(
            counted.join(few, F.lit(True)).select(
                F.lit(name).alias("table_name"), F.lit(columns).alias("columns"), "row_count", "sample"
            )
        )
    return union_all(parts)


def schema_text(spark: SparkSession, names: Sequence[str] | None = None) -> DataFrame:
    """The catalog as text: a table, columns and rows line for each table."""
    parts = []
    for name in names or table_names(spark):
        df = spark.table(name)
        columns = ", ".join(f"{f.name} ({f.dataType.simpleString()})" for f in df.schema)
        head = F.lit(f"Table: {name}\n  Columns: {columns}\n  Rows: ")
        counted = df.agg(F.count(F.lit(1)).alias("n"))
        parts.append(counted.select(F.lit(name).alias("table_name"), F.concat(head, F.col("n")).alias("schema_text")))
    return union_all(parts)
