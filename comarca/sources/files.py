"""Path checks through the Hadoop file system, so every URI scheme works."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def file_name() -> Column:
    """Name of the file a row was read from; Spark's metadata holds it percent-encoded."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def readable_path(encoded: str) -> str:
    """A ``_metadata.file_path`` as a path that a reader takes literally."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", unquote(encoded))


def missing_path(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return not hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop_path)
