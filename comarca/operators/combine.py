"""Stacking, lookups and the dimension tables of the star schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comarca import schemas
from comarca.operators.keys import KeyTable, keys_of
from comarca.sinks.pinned import pin


def union_all(tables: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionAll(b), tables)


def union_by_name(tables: Sequence[DataFrame]) -> DataFrame:
    """Rows of all tables matched by column name; columns a table lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def lookup_codes(
    df: DataFrame,
    codes: Mapping[str, int] = schemas.PROVINCE_CODES,
    name: str = "provincia",
    target: str = "codigo_provincia_ine",
) -> DataFrame:
    """Adds the code of each name; NULL for names not in the fixed list."""
    listed = df.sparkSession.createDataFrame(list(codes.items()), f"_name string, {target} int")
    # The list is part of the program, so its size is known.
    return df.join(F.broadcast(listed), F.col(name) == F.col("_name"), "left").drop("_name")


def conform(df: DataFrame, table: str) -> DataFrame:
    """The declared columns of a star table, in their order and types.

    Columns ``df`` lacks are NULL, undeclared ones are left out. A text longer than
    declared is an error, as it would be in a database.
    """

    def column(field: T.StructField):
        value = F.col(field.name) if field.name in df.columns else F.lit(None)
        if not isinstance(field.dataType, T.VarcharType):
            return value.cast(field.dataType).alias(field.name)
        text, most = value.cast("string"), field.dataType.length
        refused = F.raise_error(F.concat(F.lit(f"{field.name} is longer than {most}: "), text))
        return F.when(text.isNull() | (F.length(text) <= most), text).otherwise(refused).alias(field.name)

    return df.select(*[column(field) for field in schemas.STAR_SCHEMA[table]])


def province_dimension(
    facts: DataFrame, code: str = "codigo_provincia", name: str = "nombre_provincia"
) -> DataFrame:
    """One row per province, keyed by its own code."""
    dim = facts.where(F.col(code).isNotNull()).groupBy(F.col(code).cast("int").alias("codigo_provincia"))
    named = dim.agg(F.min(F.col(name).cast("string")).alias("nombre_provincia"))
    return conform(named.withColumn("created_at", F.current_timestamp()), "dim_provincia")


def municipality_dimension(
    facts: DataFrame,
    code: str = "codigo_municipio",
    name: str = "nombre_municipio",
    province: str = "codigo_provincia",
    keys: KeyTable | None = None,
) -> DataFrame:
    """One row per municipality code.

    ``keys`` holds the numbers of earlier runs: a code keeps its own, new ones get theirs.
    """
    distinct = pin(
        facts.where(F.col(code).isNotNull())
        .groupBy(F.col(code).cast("string").alias("codigo_municipio"))
        .agg(
            F.min(F.col(name).cast("string")).alias("nombre_municipio"),
            F.min(F.col(province).cast("int")).alias("codigo_provincia"),
        ),
        "municipalities",
    )
    numbers = keys_of(distinct.select(F.col("codigo_municipio").alias("code")), keys)
    named = distinct.join(numbers, F.col("codigo_municipio") == F.col("code")).withColumn("id_municipio", F.col("key"))
    return conform(named.withColumn("created_at", F.current_timestamp()), "dim_municipio")


def join_bucketed(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Adds a dimension to facts where ``sinks.bucketed`` wrote both in the same buckets: no row is moved.

    The merge hint keeps Spark from sending a small dimension to every task instead.
    """
    return facts.join(dimension.hint("merge"), key, "left")


def attach_dimension(facts: DataFrame, dimension: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Adds dimension columns to the facts; facts without a match keep NULL.

    The dimension is written first, so Spark broadcasts it only if its real size
    is below the session's limit. Beyond that both sides are shuffled on the key
    and adaptive execution splits the partitions of hot keys.
    """
    small = pin(dimension.select(key, *columns), "dimension")
    return facts.join(small, key, "left")
