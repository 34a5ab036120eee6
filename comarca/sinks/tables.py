"""Catalog tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


_VERSION = "version-"


def replace_table(
    df: DataFrame, name: str, path: str | None = None, partition_by: Sequence[str] = ()
) -> None:
    """Writes the table anew, in folders of ``partition_by`` where reports filter on those columns.

    The rows go to a new folder below ``path`` and to a table of another name first; only
    when they are all there do the names change, which moves no data, and the folder
    before goes. A write that breaks leaves the table as it was. ``df`` may read the table
    itself. Rows of one partition are brought together first, so that tasks do not each
    write a file per partition; adaptive execution splits the large ones.
    """
    spark, mark = df.sparkSession, uuid.uuid4().hex
    base = path or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{name.lower()}_versions"
    new, old = f"{name}__new_{mark}", f"{name}__old_{mark}"
    folder = f"{base.rstrip('/')}/{_VERSION}{mark}"
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format("parquet").option("path", folder)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.saveAsTable(new)
    except Exception:
        _drop(spark, new)
        _delete(spark, folder)
        raise
    before = _version_folder(spark, name)
    exists = spark.catalog.tableExists(name)
    if exists:
        spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {new} RENAME TO {name}")
    except Exception:
        if exists:
            spark.sql(f"ALTER TABLE {old} RENAME TO {name}")
        _drop(spark, new)
        _delete(spark, folder)
        raise
    if exists:
        _drop(spark, old)
    if before:
        _delete(spark, before)
    spark.catalog.refreshTable(name)


def _drop(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def _version_folder(spark: SparkSession, name: str) -> str | None:
    """The folder of a table that ``replace_table`` wrote; others look after their files themselves."""
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
    found = rows[0].data_type if rows else ""
    return found if found.rstrip("/").rsplit("/", 1)[-1].startswith(_VERSION) else None


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def append_table(df: DataFrame, name: str, by_position: bool = False) -> None:
    """Adds rows by column name, or by position as ``INSERT … SELECT *`` does."""
    spark = df.sparkSession
    columns = spark.table(name).columns
    if not by_position:
        if sorted(df.columns) != sorted(columns):
            raise ValueError(f"columns of {name} are {columns}, not {df.columns}")
        df = df.select(*columns)
    df.write.insertInto(name)


def loaded_rows(df: DataFrame, name: str) -> int:
    """Rows the table holds now."""
    return df.sparkSession.table(name).count()
