"""Small helpers that the operators of this package share."""

from __future__ import annotations

import pickle
from collections.abc import Callable
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def free_names(df: DataFrame, *stems: str) -> list[str]:
    """Names that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    names = []
    for stem in stems:
        name = stem
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        names.append(name)
    return names


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bounded_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Lets at most ``rows`` whole texts at a time into a Python worker; a smaller setting of the session stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def shipped(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """A function that gives tasks a value sent to each executor once, its classes included."""
    packed, held = spark.sparkContext.broadcast(cloudpickle.dumps(value)), []

    def get():
        if not held:
            held.append(pickle.loads(packed.value))
        return held[0]

    return get


def uniform(*columns, seed: int = 0) -> Column:
    """A repeatable number in [0, 1) from the columns' values."""
    return (F.xxhash64(F.lit(seed), *columns).bitwiseAND(F.lit((1 << 53) - 1))).cast("double") / float(1 << 53)


def fold(key: Column, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts``; NULL for a NULL key."""
    return F.crc32(key.cast("string").cast("binary")) % parts
