"""Connected components of a link table, in rounds of joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comarca.sinks.pinned import pin

MOST_ROUNDS = 60


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    return tuple(row)


def _towards_least(pairs: DataFrame) -> DataFrame:
    """(node, least) with the least node among a node's partners and itself."""
    return pairs.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("least")).withColumn(
        "least", F.least("least", "node")
    )


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b: long); the component is its smallest node.

    Each round hangs the larger partners of a node, then the smaller ones, under the
    least of them (star contraction), so the rounds grow with the logarithm of the
    longest chain. Minima are summed per task before the shuffle and hubs only meet
    one row each in a join, so that a node with many links does not fill a task.
    Every round is written to the shared folder. Links of a node to itself are
    ignored; no links give no rows.
    """
    edges = pin(
        links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    state = _state(edges)
    for _ in range(MOST_ROUNDS):
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        large = (
            both.where("v > u").join(_towards_least(both), F.col("u") == F.col("node"))
            .select(F.col("v").alias("a"), F.col("least").alias("b")).where("a <> b").distinct()
        )
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        least = _towards_least(down)
        small = (
            down.join(least, F.col("u") == F.col("node")).select(F.col("v").alias("a"), F.col("least").alias("b"))
            .union(least.select(F.col("node").alias("a"), F.col("least").alias("b")))
            .where("a <> b").distinct()
        )
        edges = pin(small, "links")
        now = _state(edges)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("the components did not settle")
    return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).union(
        edges.select(F.col("b"), F.col("b")).distinct()
    )
