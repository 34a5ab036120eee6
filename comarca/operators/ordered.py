"""Operators that need a row order over the whole table.

The table is range-partitioned on the order key and a hash of the row, and written
once, so each block holds a contiguous run of rows of even size: neither a key nor an
order value with a large share of the rows ends up in one block, and rows tied on the
order have one order whatever the blocks are. Rows equal in every column, of which it
makes no difference which comes first, are told apart by where they were read, so they
too go to as many blocks as they fill. There are as many blocks as the session has
shuffle partitions. What passes between blocks is one row of fixed
width per block.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comarca.functions.scalars import null_if_nan
from comarca.sinks.pinned import pin

# monotonically_increasing_id() keeps the partition above bit 33, the row in it below.
_ROW_BITS = 33


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind)
    return not isinstance(kind, (T.MapType, T.VariantType))


def _row_hash(df: DataFrame) -> Column:
    """A hash of the row's columns; maps can't be hashed and are left out."""
    return F.xxhash64(F.lit(0), *[F.col(f"`{f.name}`") for f in df.schema if _hashable(f.dataType)])


def in_order(df: DataFrame, order: Sequence[str], blocks: int | None = None) -> DataFrame:
    """``df`` plus ``_block`` and ``_row``, both increasing along ``order``."""
    keys = [F.col(f"`{c}`").asc_nulls_last() for c in order] + [F.col("_hash").asc(), F.col("_tie").asc()]
    # Hashed again, so that the sampled bounds between equal rows lie evenly.
    hashed = df.withColumn("_hash", _row_hash(df)).withColumn("_tie", F.xxhash64(F.monotonically_increasing_id()))
    ranged = hashed.repartitionByRange(blocks, *keys) if blocks else hashed.repartitionByRange(*keys)
    placed = ranged.sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    numbered = placed.withColumns(
        {
            "_block": F.shiftright("_at", _ROW_BITS),
            "_row": F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
        }
    )
    return pin(numbered.drop("_at", "_hash", "_tie"), "ordered")


def _offsets(sizes: DataFrame) -> DataFrame:
    """``(_block, _offset)`` from ``(_block, _size)``: the sum of all blocks before."""
    # One row per block, so this window is no larger than the block count.
    before = F.sum("_size").over(W.orderBy("_block").rowsBetween(W.unboundedPreceding, -1))
    return sizes.select("_block", F.coalesce(before, F.lit(0)).alias("_offset"))


def number_rows(df: DataFrame, order: Sequence[str], name: str = "id", blocks: int | None = None) -> DataFrame:
    """Adds consecutive numbers from 1 along ``order``."""
    rows = in_order(df, order, blocks)
    offsets = _offsets(rows.groupBy("_block").agg(F.count(F.lit(1)).alias("_size")))
    # Two numbers per block.
    numbered = rows.join(F.broadcast(offsets), "_block")
    return numbered.select((F.col("_offset") + F.col("_row") + 1).alias(name), *df.columns)


def running_total(
    df: DataFrame, order: Sequence[str], amount: str, name: str, blocks: int | None = None
) -> DataFrame:
    """Adds the sum of ``amount`` over all rows up to and including each one along ``order``."""
    rows = in_order(df, order, blocks)
    offsets = _offsets(rows.groupBy("_block").agg(F.sum(amount).alias("_size")))
    in_block = W.partitionBy("_block").orderBy("_row").rowsBetween(W.unboundedPreceding, W.currentRow)
    local = rows.withColumn("_local", F.sum(amount).over(in_block))
    # Two numbers per block.
    summed = local.join(F.broadcast(offsets), "_block")
    return summed.select(*df.columns, (F.col("_offset") + F.col("_local")).alias(name))


def forward_fill(
    df: DataFrame,
    columns: Sequence[str],
    order: Sequence[str],
    by: Sequence[str] = (),
    blocks: int | None = None,
) -> DataFrame:
    """Fills missing cells with the last value before them along ``order``, within ``by``.

    Rows go through blocks along ``(by, order)``. A block is filled within itself and
    from the last known cell before it, which it knows by the number of its block.
    """
    types = {f.name: f.dataType for f in df.schema}
    cleaned = df.withColumns({c: null_if_nan(c, types[c]) for c in columns})
    rows = in_order(cleaned, [*by, *order], blocks)
    key = F.struct(*by) if by else F.struct(F.lit(0).alias("all"))
    known = {c: F.when(F.col(c).isNotNull(), F.struct(key.alias("key"), F.col(c).alias("value"))) for c in columns}

    in_block = W.partitionBy("_block").orderBy("_row").rowsBetween(W.unboundedPreceding, W.currentRow)
    local = rows.withColumns({f"_local_{c}": F.last(known[c], ignorenulls=True).over(in_block) for c in columns})

    # Each block's last known cells by row number: hashed numbers, no sort of the rows.
    ends = pin(
        rows.groupBy("_block").agg(
            *[F.max(F.when(F.col(c).isNotNull(), F.col("_row"))).alias(f"_end_{c}") for c in columns]
        ),
        "block-ends",
    )
    at_end = {c: F.col("_row") == F.col(f"_end_{c}") for c in columns}
    # One row of numbers per block.
    last_rows = rows.join(F.broadcast(ends), "_block").where(reduce(lambda a, b: a | b, at_end.values()))
    last_known = pin(
        last_rows.groupBy("_block").agg(
            *[F.first(F.when(at_end[c], known[c]), ignorenulls=True).alias(c) for c in columns]
        ),
        "block-values",
    )
    # Which earlier block has the last known cell; again one row of numbers per block.
    earlier = W.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    carried = ends.select(
        "_block",
        *[
            F.last(F.when(F.col(f"_end_{c}").isNotNull(), F.col("_block")), ignorenulls=True)
            .over(earlier)
            .alias(f"_from_{c}")
            for c in columns
        ],
    )
    for c in columns:
        value = last_known.select(F.col("_block").alias(f"_from_{c}"), F.col(c).alias(f"_carry_{c}"))
        carried = carried.join(value, f"_from_{c}", "left").drop(f"_from_{c}")
    # Values may be long, so these are written: Spark broadcasts them if their real size is small.
    carried = pin(carried, "carried")

    def filled(c: str) -> Column:
        of_same_key = [
            F.when(F.col(f"{side}.key").eqNullSafe(key), F.col(f"{side}.value"))
            for side in (f"_local_{c}", f"_carry_{c}")
        ]
        return F.coalesce(F.col(c), *of_same_key).alias(c)

    return local.join(carried, "_block").select(*[filled(c) if c in columns else c for c in df.columns])
