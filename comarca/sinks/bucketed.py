"""Tables written in buckets of a key, so that joins on it move no rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from comarca.session import scratch_path


def bucketed(df: DataFrame, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """Writes ``df`` in buckets of ``key`` and hands on the written copy.

    Two tables with the same number of buckets of their keys, written once at load, are
    joined bucket by bucket, whatever their sizes. Rows are brought to their bucket before
    they are written, so a bucket is one file, save a hot key's, which adaptive execution
    splits. The catalog is asked for a name only while the files are registered: the
    frame keeps files and buckets.
    """
    spark, name = df.sparkSession, f"bucketed_{uuid.uuid4().hex}"
    path = path or scratch_path(spark, "bucketed")
    rows = df.hint("rebalance", key)
    rows.write.bucketBy(buckets, key).sortBy(key).format("parquet").option("path", path).saveAsTable(name)
    found = spark.table(name)
    found.schema  # noqa: B018
    spark.sql(f"DROP TABLE {name}")
    return found
