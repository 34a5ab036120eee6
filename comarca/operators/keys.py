"""Whole numbers for codes of any form, kept from run to run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from comarca.operators.ordered import number_rows
from comarca.session import scratch_path
from comarca.sinks.pinned import pin
from comarca.sources.files import missing_path

KEYS = "code string, key int"


def own_number(code: Column) -> Column:
    """The number that a code of 5 to 9 digits is, as the statistics office gives them; NULL for others."""
    return F.when(code.rlike("^[0-9]{5,9}$"), code.try_cast("int"))


def new_keys(codes: DataFrame, known: DataFrame) -> DataFrame:
    """``(code, key)`` of the codes that ``known`` (code, key) lacks.

    A code of 5 to 9 digits has its own number, if no known code has it; of several new
    ones with one number, as 00123 and 000123, the shortest gets it. All others are
    numbered downwards from -1 or from the least known key, in the order of the codes,
    by blocks: no code is looked at by one task alone. NULL codes get none. A key that
    the integer type can't hold is an error.
    """
    fresh = codes.select(F.col("code").cast("string").alias("code")).where("code IS NOT NULL").distinct()
    fresh = fresh.join(known.select(F.col("code").alias("of")), F.col("code") == F.col("of"), "left_anti")
    fresh = fresh.withColumn("number", own_number(F.col("code")))
    taken = known.where("key >= 0").select(F.col("key").alias("taken"))
    numbered = fresh.where("number IS NOT NULL").join(taken, F.col("number") == F.col("taken"), "left_anti")
    first = numbered.groupBy(F.col("number").alias("key")).agg(F.min(F.struct(F.length("code").alias("n"), "code")).alias("first"))
    own = pin(first.select("first.code", "key"), "own-keys")
    rest = fresh.join(own.select(F.col("code").alias("of")), F.col("code") == F.col("of"), "left_anti").select("code")
    least = known.agg(F.min("key")).first()[0]
    others = number_rows(rest, ["code"], "place").select("code", (F.lit(min(least or 0, 0)) - F.col("place")).cast("int").alias("key"))
    return own.select("code", F.col("key").cast("int").alias("key")).union(others)


class KeyTable:
    """Keys in a folder, handed out once and never changed.

    Every extension is a folder of its own that counts when Spark has marked it as done;
    what a broken one left is written over by the next. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _extensions(self) -> int:
        n = 0
        while not missing_path(self.spark, f"{self.path}/{n:06}/_SUCCESS"):
            n += 1
        return n

    def keys(self) -> DataFrame:
        """``(code, key)`` of all codes so far."""
        n = self._extensions()
        if not n:
            return self.spark.createDataFrame([], KEYS)
        return self.spark.read.schema(KEYS).parquet(*[f"{self.path}/{i:06}" for i in range(n)])

    def extend(self, codes: DataFrame) -> DataFrame:
        """Hands keys to the codes (column ``code``) that have none; returns all keys."""
        fresh = pin(new_keys(codes, self.keys()), "new-keys")
        if not fresh.isEmpty():
            fresh.write.mode("overwrite").parquet(f"{self.path}/{self._extensions():06}")
        return self.keys()


def keys_of(codes: DataFrame, table: KeyTable | None = None) -> DataFrame:
    """Keys of the codes, from ``table`` or, without one, as a first run would hand them out."""
    table = table or KeyTable(codes.sparkSession, scratch_path(codes.sparkSession, "keys"))
    return table.extend(codes)
