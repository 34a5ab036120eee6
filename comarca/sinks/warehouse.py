"""Loads into a cloud warehouse over JDBC."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comarca.functions import naming, scalars

BATCH_ROWS = 1000
TEXT_TYPE = "VARCHAR(16777216)"


def clean_cells(df: DataFrame) -> DataFrame:
    """NaN becomes NULL and timestamps become text."""
    cells = []
    for field in df.schema:
        column = scalars.null_if_nan(field.name, field.dataType)
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            column = scalars.timestamp_text(column)
        cells.append(column.alias(field.name))
    return df.select(*cells)


def prepare(df: DataFrame) -> DataFrame:
    return naming.warehouse_names(clean_cells(df))


def column_types(df: DataFrame) -> dict[str, str]:
    """Warehouse type of every column of a prepared table."""

    def of(data_type: T.DataType) -> str:
        if isinstance(data_type, T.IntegralType):
            return "INTEGER"
        if isinstance(data_type, (T.FloatType, T.DoubleType)):
            return "FLOAT"
        if isinstance(data_type, T.BooleanType):
            return "BOOLEAN"
        return TEXT_TYPE

    return {f.name: of(f.dataType) for f in df.schema}


def load_plan(df: DataFrame) -> DataFrame:
    """``(column_name, sql_type, filled_cells)`` of the load, from one pass over the table."""
    ready = prepare(df)
    cells = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(sql_type).alias("sql_type"),
            F.count(F.col(f"`{name}`")).alias("filled_cells"),
        )
        for name, sql_type in column_types(ready).items()
    ]
    return ready.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def load(
    df: DataFrame, url: str, table: str, mode: str = "replace", properties: Mapping[str, str] | None = None
) -> None:
    """Writes over JDBC; the driver class has to be on the session's class path."""
    ready = prepare(df)
    types = ", ".join(f"`{name}` {sql_type}" for name, sql_type in column_types(ready).items())
    (
        ready.write.format("jdbc")
        .options(url=url, dbtable=table.upper(), batchsize=BATCH_ROWS, createTableColumnTypes=types)
        .options(**dict(properties or {}))
        .mode("overwrite" if mode == "replace" else "append")
        .save()
    )
