"""Sharding by sampled splitters: ranges of one key order, cut at size-weighted sample quantiles.

Records are ordered by (hash of the text, hash of the id, number): copies of a text lie
side by side, and rows equal in both still have an order, as rows are written once with
a number each. A sample in which a record's chance grows with its size gives the
quantile boundaries of many small ranges; ranges that turn out overfull are sampled
again and subdivided until none is; consecutive ranges then make up the shards, whose
sizes are near equal. A boundary lies at the start of a text's copies, so that they
share a shard, unless they fill over ``group_share`` of one: only such a group is cut, between
any two of its rows.

Defined results: a NULL text counts as no bytes and is in one group with empty texts;
repeated rows get slots of their own, in any order among themselves; NULL ids are allowed;
an empty table gives no rows; further columns come back in a struct, whatever their names.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comarca.llm.frames import uniform
from comarca.sinks.pinned import pin

SHARDS = 24
OVERHEAD = 8
RANGES_PER_SHARD = 128
# Sampled keys per range: bounds what reaches the driver, together with the number of ranges.
KEYS_PER_RANGE = 12
OVERFULL = 2.0
# Copies of one text stay in one shard up to this share of it.
GROUP_SHARE = 1 / 16
# Rounds after which a range may hold, beside its share, a group of copies that is not cut.
EVEN_ROUNDS = 4
# Every round cuts each overfull range into its share of parts, so few are ever needed.
MOST_ROUNDS = 40
SEED = 29

Boundary = tuple[int, int, int]
LOWEST = -(1 << 63)


def record_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long")


def quantile_boundaries(keys: list[tuple[int, int, int, float]], ranges: int) -> list[Boundary]:
    """Up to ``ranges`` - 1 boundaries that give each range the same share of the keys' weights."""
    if not keys:
        return []
    keys = sorted(keys)
    reached = np.cumsum([w for *_, w in keys])
    wanted = reached[-1] * np.arange(1, ranges) / ranges
    return [keys[i][:3] for i in np.searchsorted(reached, wanted, side="left")]


def at_group_starts(boundaries: list[Boundary], ranges_per_shard: int, group_share: float = GROUP_SHARE,
                    large: frozenset[int] = frozenset()) -> list[Boundary]:
    """Moves boundaries to the start of a text's copies, save in a text that fills over ``group_share`` of a shard.

    Such are those with so many sampled boundaries, and those known to be ``large``.
    """
    within = Counter(text for text, *_ in set(boundaries))
    large = large | {text for text, times in within.items() if times > ranges_per_shard * group_share}
    return sorted({(text, LOWEST, LOWEST) for text in within} | {b for b in boundaries if b[0] in large})


def range_number(boundaries: list[Boundary], *key: Column) -> Column:
    """The number of boundaries at or below a record's key, looked up in a bounded sorted list."""
    if not boundaries:
        return F.lit(0)
    table = np.array(boundaries, dtype=np.int64)

    @F.pandas_udf(T.IntegerType())
    def lookup(text: pd.Series, row: pd.Series, number: pd.Series) -> pd.Series:
        parts = [part.to_numpy(np.int64) for part in (text, row, number)]
        low, high = np.zeros(len(text), dtype=np.int64), np.full(len(text), len(table))
        # Part by part: among boundaries that agree so far, those below and those equal.
        for i, part in enumerate(parts):
            open_ones = np.flatnonzero(low < high)
            cells = np.column_stack([low[open_ones], high[open_ones]])
            for first, end in np.unique(cells, axis=0).tolist():
                here = open_ones[(cells == (first, end)).all(axis=1)]
                column = table[first:end, i]
                low[here] = first + np.searchsorted(column, part[here], side="left")
                high[here] = first + np.searchsorted(column, part[here], side="right")
        return pd.Series(high.astype(np.int32))

    return lookup(*key)


KEY = ("text_key", "row_key", "number")


def drawn_keys(rows: DataFrame, step: float, seed: int, *first: str) -> list[tuple]:
    """Keys with weights; a record of ``step`` bytes and more is drawn surely, a smaller one by its size."""
    step = max(1.0, step)
    drawn = rows.where(uniform(*KEY, "size", seed=seed) < F.col("size") / step)
    weight = F.greatest(F.col("size").cast("double"), F.lit(step))
    return [tuple(r) for r in drawn.select(*first, *KEY, weight).collect()]


def balanced_boundaries(rows: DataFrame, shards: int, ranges_per_shard: int, seed: int = SEED,
                        group_share: float = GROUP_SHARE) -> tuple[list[Boundary], list]:
    """Boundaries of the ranges, and each range's (range, size, records, …) in order.

    Beside its largest record a range holds up to ``OVERFULL`` times its share, and where a
    group of copies that stays together is in the way, ``group_share`` of a shard more.
    What reaches the driver is bounded by the number of ranges times ``KEYS_PER_RANGE``.
    """
    ranges = shards * ranges_per_shard
    total = rows.agg(F.sum("size")).first()[0] or 0
    fair = total / ranges
    found = quantile_boundaries(drawn_keys(rows, total / (ranges * KEYS_PER_RANGE), seed), ranges)
    large: frozenset[int] = frozenset()
    for again in range(MOST_ROUNDS):
        found = at_group_starts(found, ranges_per_shard, group_share, large)
        number = range_number(found, *[F.col(c) for c in KEY])
        measured = rows.groupBy(number.alias("range")).agg(
            F.sum("size").alias("size"), F.count(F.lit(1)).alias("records"), F.max("size").alias("largest"),
            (F.min("text_key") < F.max("text_key")).alias("texts"),
        )
        measured = sorted(tuple(r) for r in measured.collect())
        # What lies beside the largest record counts, as that one can't be cut.
        group = fair * ranges_per_shard * group_share
        overfull = {
            r: size for r, size, _, largest, texts in measured
            if size - largest > fair * OVERFULL + (0 if texts and again < EVEN_ROUNDS else group)
        }
        if not overfull:
            return found, measured
        inside = rows.withColumn("range", number).where(F.col("range").isin(list(overfull)))
        # Every overfull range gets new quantile boundaries of its own.
        drawn: dict[int, list] = {r: [] for r in overfull}
        for r, *key in drawn_keys(inside, fair / KEYS_PER_RANGE, seed + 1 + again, "range"):
            drawn[r].append(tuple(key))
        for r, keys in drawn.items():
            weights: Counter = Counter()
            for text, *_, weight in keys:
                weights[text] += weight
            large |= {text for text, weight in weights.items() if weight > group}
            found = found + quantile_boundaries(keys, int(np.ceil(overfull[r] / fair)) + 1)
    raise RuntimeError(f"{len(overfull)} ranges are still overfull after {MOST_ROUNDS} rounds")


def shard(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS,
          ranges_per_shard: int = RANGES_PER_SHARD, keep: tuple[str, ...] = (), seed: int = SEED,
          group_share: float = GROUP_SHARE) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot and the struct ``kept`` of the columns named in ``keep``."""
    spark = docs.sparkSession
    value = docs[f"`{text}`"]
    # Written once, so that a row keeps its number in every reading.
    rows = pin(docs.select(
        docs[f"`{doc_id}`"].alias("doc_id"),
        record_size(value).alias("size"),
        F.crc32(F.coalesce(value, F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(F.lit(seed), F.coalesce(value, F.lit(""))).alias("text_key"),
        F.xxhash64(F.lit(seed), docs[f"`{doc_id}`"]).alias("row_key"),
        F.monotonically_increasing_id().alias("number"),
        F.struct(*[docs[f"`{c}`"] for c in keep] or [F.lit(0).alias("none")]).alias("kept"),
    ), "shard-rows")
    boundaries, measured = balanced_boundaries(rows.select(*KEY, "size"), shards, ranges_per_shard, seed, group_share)
    total = sum(size for _, size, *_ in measured)
    table, before, slots = [], 0, [0] * shards
    for number, size, records, *_ in measured:
        of = min(shards - 1, int((before + size / 2) * shards / total))
        table.append((number, of, slots[of]))
        slots[of] += records
        before += size
    # One row per range, of which there are a few thousand whatever the input.
    ranges = spark.createDataFrame(table or [(0, 0, 0)], "range int, shard int, first_slot long")
    in_range = Window.partitionBy("range").orderBy(*KEY)
    return (
        rows.withColumn("range", range_number(boundaries, *[F.col(c) for c in KEY]))
        .withColumn("place", F.row_number().over(in_range) - 1)
        .join(F.broadcast(ranges), "range")
        .select("doc_id", "size", "text_crc32", "shard", (F.col("first_slot") + F.col("place")).alias("slot"), "kept")
    )
