"""Rows as search documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comarca.operators.ordered import number_rows


def to_documents(df: DataFrame, id_column: str, order: Sequence[str] = ()) -> DataFrame:
    """``(id, structData, jsonData)``; JSON keeps NULL fields.

    Where there is no ``id_column`` the id is the row's position from 0 along
    ``order``, which must then be given.
    """
    columns = df.columns
    if id_column in columns:
        identified = df.withColumn("_id", F.col(id_column).cast("string"))
    else:
        if not order:
            raise ValueError("row numbers as ids need an order key")
        numbered = number_rows(df, order, "_number")
        identified = numbered.withColumn("_id", (F.col("_number") - 1).cast("string"))
    row = F.struct(*columns)
    return identified.select(
        F.col("_id").alias("id"),
        row.alias("structData"),
        F.to_json(row, {"ignoreNullFields": "false"}).alias("jsonData"),
    )
