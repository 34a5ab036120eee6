"""A result written once to the shared folder and read from there."""

from __future__ import annotations

from pyspark.sql import DataFrame

from comarca.session import scratch_path


def pin(df: DataFrame, label: str) -> DataFrame:
    """Cuts the lineage of ``df`` by writing it as Parquet to the shared folder.

    Every later reader sees the same rows even if executors are lost, and Spark
    knows the table's real size, so it broadcasts it in a join only if it is
    below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
