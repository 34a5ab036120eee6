"""Mixing sources to target weights: equal-token blocks dealt out by highest quotients.

Sources are put in order, weighted and given targets; Sainte-Laguë quotients
deal equal blocks of tokens to the sources shard by shard; each source's
documents, in a seeded order, are cut into such blocks, and seeded ranks choose
which blocks the mix takes. A source of few blocks, for which a block is too coarse,
takes its target to the word instead: whole rounds, and the first words of the seeded
order once more. DataFrame operations only.

The seeded order is that of a hash of id and text, so that rows without an id, or with
one id, lie apart; rows equal in both are ordered by the columns that are kept. It
is cut into buckets of some ``BUCKET_ROWS`` rows at every size; rows equal in id and text
share one.

Defined results: a NULL text has size 0; a NULL source is a source of its own,
last in order; documents of size 0 are kept and take nothing; repeated rows are
separate documents that share nothing but their place in the seeded order; an
empty table gives an empty mix; other columns never matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from comarca.sinks.pinned import pin

CEILING = 3
BLOCKS_PER_SOURCE = 200
# A source whose size or target is below so many blocks takes its words without blocks.
FEW_BLOCKS = 50
SHARDS = 8
SEED = 17
# Rows that one window over a bucket of the seeded order holds on average.
BUCKET_ROWS = 256
# Buckets whose sums one window adds up.
RUN_OF_BUCKETS = 4096


def word_count(text: Column) -> Column:
    """Runs of anything but ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, ceiling: int = CEILING, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Targets per source from ``sizes`` (source, source_size), one row per source.

    A source's target is its weight times one common rate, or ``ceiling`` times
    its size where that is less; the rate is such that targets add up to all sizes.
    The frame has one row per source, which is what bounds its ordered windows.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    ranked = sizes.withColumn("rank", F.row_number().over(in_order)).withColumn("weight", weight.cast("long"))
    # Sources reach their ceiling in this order while the rate rises.
    by_ratio = Window.orderBy(F.col("source_size") / F.col("weight"), "rank")
    upto = by_ratio.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy()
    most = F.col("source_size") * ceiling
    totals = (
        ranked.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("weights", F.sum("weight").over(everything))
        .withColumn("used", F.sum(most).over(upto) - most)
        .withColumn("gone", F.sum("weight").over(upto) - F.col("weight"))
    )
    # The first source in that order which stays below its ceiling fixes the rate.
    rate_here = (F.col("total") - F.col("used")).cast("double") / (F.col("weights") - F.col("gone"))
    fits = rate_here * F.col("weight") <= most
    rate = F.min(F.when(fits, F.struct("gone", rate_here.alias("rate")))).over(everything)["rate"]
    return totals.withColumn("rate", rate).select(
        "source",
        "rank",
        "source_size",
        "total",
        F.least(most.cast("double"), F.coalesce(F.col("rate") * F.col("weight"), most.cast("double"))).alias("target"),
    )


def with_block_size(targets: DataFrame, blocks_per_source: int = BLOCKS_PER_SOURCE) -> DataFrame:
    """Adds ``block``, the words of a block, ``seats``, the number of blocks of the mix, and ``exact``.

    ``exact`` holds the words that a source of few blocks takes, and is NULL for the
    others, which share the seats.
    """
    everything = Window.partitionBy()
    block = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("total") / (F.count(F.lit(1)).over(everything) * blocks_per_source)))
    few = F.least(F.col("source_size").cast("double"), "target") < F.col("block") * FEW_BLOCKS
    dealt = F.col("total") - F.coalesce(F.sum("exact").over(everything), F.lit(0))
    return (
        targets.withColumn("block", block).withColumn("exact", F.when(few, F.round("target").cast("long")))
        .withColumn("seats", F.round(dealt / F.col("block")).cast("long"))
    )


def block_quotas(targets: DataFrame, shards: int = SHARDS, ceiling: int = CEILING) -> DataFrame:
    """Blocks of each source in each output shard by Sainte-Laguë: (rank, shard, quota).

    Seats go to the highest quotients target / (2k + 1); a shard is a run of seats
    in that order, so every shard has nearly the mix's proportions. The list that is
    ranked holds a few hundred rows per source, whatever the corpus holds.
    """
    asked = (
        # No source gets more blocks than its ceiling holds.
        targets.withColumn("most", F.floor(F.col("source_size") * ceiling / F.col("block")))
        .withColumn("likely", F.least("most", F.ceil(F.col("target") / F.col("block")) * 2 + 8))
        .where("likely > 0 AND exact IS NULL")
        .select("rank", "seats", "target", F.explode(F.sequence(F.lit(0).cast("long"), F.col("likely") - 1)).alias("k"))
    )
    highest = Window.orderBy((F.col("target") / (F.col("k") * 2 + 1)).desc(), "rank", "k")
    seated = asked.withColumn("seat", F.row_number().over(highest) - 1).where("seat < seats")
    shard = F.floor(F.col("seat") * shards / F.col("seats")).cast("int")
    return seated.groupBy("rank", shard.alias("shard")).agg(F.count(F.lit(1)).alias("quota"))


def chosen_blocks(targets: DataFrame, quotas: DataFrame, seed: int = SEED, ceiling: int = CEILING) -> DataFrame:
    """Every block of every source: how often the mix takes it, and the words it takes from the blocks before.

    A source whose quota is more than its blocks has each of them taken
    ``quota // blocks`` times; seeded ranks choose those that are taken once more. A
    source of few blocks has two: its words up to ``cut_of`` and those behind.
    """
    quota = quotas.groupBy(F.col("rank").alias("of")).agg(F.sum("quota").alias("quota"))
    blocks = (
        targets.where("source_size > 0 AND exact IS NULL").join(quota, F.col("rank") == F.col("of"), "left")
        .withColumn("blocks", F.ceil(F.col("source_size") / F.col("block")))
        .select("rank", "block", "source_size", F.coalesce("quota", F.lit(0)).alias("quota"), "blocks",
                F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("no"))
    )
    by_seed = Window.partitionBy("rank").orderBy(F.md5(F.concat_ws("/", "rank", "no", F.lit(str(seed)))), "no")
    extra = F.when(F.row_number().over(by_seed) <= F.col("quota") % F.col("blocks"), 1).otherwise(0)
    times = F.least(F.lit(ceiling).cast("long"), F.floor(F.col("quota") / F.col("blocks")) + extra)
    words = F.least("block", F.col("source_size") - F.col("no") * F.col("block"))
    before = Window.partitionBy("rank").orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    dealt = blocks.withColumn("times", times).select(
        "rank", "no", "times", (F.col("no") * F.col("block")).alias("start"),
        F.coalesce(F.sum(F.col("times") * words).over(before), F.lit(0)).alias("taken_before"),
    )
    few = targets.where("source_size > 0 AND exact IS NOT NULL").withColumn("cut", cut_of())
    rounds = F.floor(F.col("exact") / F.col("source_size"))
    zero = F.lit(0).cast("long")
    parts = F.array(
        F.struct(zero.alias("no"), (rounds + 1).alias("times"), zero.alias("start"), zero.alias("taken_before")),
        F.struct((zero + 1).alias("no"), rounds.alias("times"), F.col("cut").alias("start"),
                 ((rounds + 1) * F.col("cut")).alias("taken_before")),
    )
    return dealt.unionByName(few.select("rank", F.inline(parts)))


def cut_of() -> Column:
    """Words of a source of few blocks that are taken once more than the others."""
    return F.col("exact") % F.greatest("source_size", F.lit(1).cast("long"))


def seeded_order(doc_id: Column, text: Column, seed: int) -> Column:
    parts = F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    return F.md5(F.concat_ws("/", *parts, F.lit(str(seed))))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", keep: tuple[str, ...] = (),
        seed: int = SEED, blocks_per_source: int = BLOCKS_PER_SOURCE, shards: int = SHARDS, ceiling: int = CEILING) -> DataFrame:
    """doc_id, source, size, source_size, target, taken (words, repeats counted) and copies of every row.

    A block that is taken k times takes each of its words k times, so a document
    on the edge of a block may be taken in part. ``copies`` is taken / size, rounded
    up or down by a seeded draw of the document whose mean is that quotient; of rows that
    are equal, which share the draw, each takes over the remainder of the one before. The
    columns named in ``keep`` come back in the struct ``kept``.
    """
    own_id, value = docs[f"`{doc_id}`"], docs[f"`{text}`"]
    kept = F.struct(*[docs[f"`{c}`"] for c in keep] or [F.lit(0).alias("none")])
    rows = docs.select(
        own_id.alias("doc_id"),
        docs[f"`{source}`"].alias("source"),
        word_count(value).alias("size"),
        seeded_order(own_id, value, seed).alias("order"),
        F.xxhash64(value, F.to_json(kept) if keep else F.lit(0)).alias("tie"),
        kept.alias("kept"),
    )
    # Sizes are read again and again; texts that are kept are not copied for it.
    light = pin(rows.drop("kept"), "mix-rows")
    targets = pin(
        with_block_size(
            source_targets(light.groupBy("source").agg(F.sum("size").alias("source_size")), ceiling), blocks_per_source
        ),
        "mix-targets",
    )
    blocks = pin(chosen_blocks(targets, block_quotas(targets, shards, ceiling), seed, ceiling), "mix-blocks")

    # Where each document begins in its source's seeded order, without sorting a whole source anywhere.
    buckets = max(1, light.count() // BUCKET_ROWS)
    leading = F.conv(F.substring("order", 1, 8), 16, 10).cast("long")
    bucket = F.floor(leading * buckets / F.lit(1 << 32)).cast("long")
    of_source = targets.withColumnRenamed("source", "of_source")

    def in_buckets(frame):
        return frame.join(of_source, F.col("source").eqNullSafe(F.col("of_source"))).withColumn("bucket", bucket)

    # Runs of buckets first, then the buckets of each run, so that no window holds a source's buckets.
    run = F.floor(F.col("in_bucket") / RUN_OF_BUCKETS).alias("run")
    words = in_buckets(light).groupBy(F.col("rank").alias("in_rank"), F.col("bucket").alias("in_bucket")).agg(
        F.sum("size").alias("words")
    ).withColumn("run", run)
    earlier = Window.partitionBy("of").orderBy("in_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = words.groupBy(F.col("in_rank").alias("of"), F.col("run").alias("in_run")).agg(F.sum("words").alias("words")).select(
        "of", "in_run", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("run_start")
    )
    before = Window.partitionBy("in_rank", "run").orderBy("in_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = words.withColumn("upto", F.coalesce(F.sum("words").over(before), F.lit(0))).join(
        runs, (F.col("in_rank") == F.col("of")) & (F.col("run") == F.col("in_run"))
    ).select("in_rank", "in_bucket", (F.col("run_start") + F.col("upto")).alias("start"))
    inside = (
        Window.partitionBy("rank", "bucket").orderBy("order", "doc_id", "size", "tie")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = (
        in_buckets(rows if keep else light.withColumn("kept", F.struct(F.lit(0).alias("none"))))
        .withColumn("within", F.sum("size").over(inside) - F.col("size"))
        .join(starts, (F.col("rank") == F.col("in_rank")) & (F.col("bucket") == F.col("in_bucket")))
        .withColumn("begin", F.col("start") + F.col("within"))
        .withColumn("end", F.col("begin") + F.col("size"))
    )

    def taken_upto(frame, position, at):
        """Adds ``at``: the words that the mix takes from the source up to ``position``."""
        word = F.col(position) - (1 if position == "end" else 0)
        no = F.when(F.col("exact").isNull(), F.floor(word / F.col("block"))).otherwise((word >= cut_of()).cast("long"))
        no = F.when(F.col("size") > 0, no)
        side = blocks.select(F.col("rank").alias("r"), F.col("no").alias("n"), "times", F.col("start").alias("s"), "taken_before")
        joined = frame.join(side, (F.col("rank") == F.col("r")) & (no == F.col("n")), "left")
        return joined.withColumn(
            at, F.col("taken_before") + F.col("times") * (F.col(position) - F.col("s"))
        ).drop("r", "n", "times", "s", "taken_before")

    both = taken_upto(taken_upto(placed, "begin", "first"), "end", "last")
    taken = F.coalesce(F.col("last") - F.col("first"), F.lit(0)).cast("long")
    draw = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "tie"), F.greatest("size", F.lit(1).cast("long")))
    copies = F.when(F.col("size") > 0, F.expr("(`last` + draw) div size - (`first` + draw) div size"))
    return both.withColumn("draw", draw).select(
        "doc_id", "source", "size", "source_size", "target", taken.alias("taken"),
        F.coalesce(copies, F.lit(0)).cast("int").alias("copies"), "kept",
    )
