"""Near-duplicate vectors through a flat graph with robust pruning.

Vectors are compared within their label only. Equal vectors are one node. Nodes go
to the shards of their nearest centroids, so shards overlap; in each shard a graph is
built by inserting nodes in growing batches, each linked to a robustly pruned choice of
what a greedy search for it visits. The adjacency lists of all shards are united per
node. Then every node searches each of its shards: greedily from the shard's medoid,
and from what is in range on through every neighbour in range. Links are verified in
double precision where they are found, and counted once, in the first shard that both
ends share. Two samples of nodes are compared with all others, one of nodes for which the
search found something near and one of the rest, and measure recall per node; so tables
with few near copies are measured where those lie. Below the target the work is repeated
with more overlap and wider searches; only if the measured recall of the last round is
below ``floor`` are all pairs within a label compared, block by block.

A shard with too many nodes is split into blocks at random; each pair of its blocks
becomes a unit with a graph of its own, so no group of near copies fills a task.

Defined results: vectors without label or id, NULL, empty or zero vectors and those
with a NULL or non-finite component link with nothing; vectors of different lengths
never link; rows that repeat a vector link with each other; an empty table gives no
rows; other columns never matter.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comarca.llm.components import components
from comarca.llm.frames import shuffle_partitions, uniform
from comarca.llm.simhash_trie import Forest
from comarca.sinks.pinned import pin

THRESHOLD = 0.93
SEED = 67
# Bounds of a shard's nodes, and of all centroids (which every task holds).
LEAST_SHARD, MOST_SHARD = 256, 4096
MOST_CENTROIDS = 65_536
# Nodes of each of the two samples of an audit, and how far below the threshold something is near.
AUDIT_NODES = 1000
NEAR = 0.05
TARGET_RECALL = 0.99
FLOOR_RECALL = 0.9


@dataclass(frozen=True)
class Search:
    """``overlap`` shards per node, ``degree`` neighbours kept, ``beam`` nodes held by a greedy search."""

    overlap: int = 2
    degree: int = 16
    beam: int = 24
    alpha: float = 1.2

    def wider(self) -> Search:
        return Search(self.overlap + 2, self.degree + 8, self.beam * 2, self.alpha)


# ---- the graph of one shard ------------------------------------------------------


def greedy(graph: np.ndarray, x: np.ndarray, queries: np.ndarray, start: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``beam`` nearest nodes that a greedy search from ``start`` finds for each query: (nodes, similarities)."""
    q = len(queries)
    nodes = np.full((q, beam), -1)
    near = np.full((q, beam), -np.inf, dtype=np.float32)
    done = np.ones((q, beam), dtype=bool)
    nodes[:, 0], near[:, 0], done[:, 0] = start, x[queries] @ x[start], False
    active = np.arange(q)
    while len(active):
        at = np.argmax(~done[active], axis=1)
        more = ~done[active, at]
        active, at = active[more], at[more]
        if not len(active):
            break
        done[active, at] = True
        found = graph[nodes[active, at]]
        held = nodes[active]
        new = (found >= 0) & ~(found[:, :, None] == held[:, None, :]).any(axis=2)
        close = np.einsum("qrd,qd->qr", x[np.maximum(found, 0)], x[queries[active]])
        close = np.where(new, close, -np.inf)
        all_near = np.concatenate([near[active], close], axis=1)
        best = np.argsort(-all_near, axis=1, kind="stable")[:, :beam]
        row = np.arange(len(active))[:, None]
        nodes[active] = np.concatenate([held, found], axis=1)[row, best]
        near[active] = all_near[row, best]
        done[active] = np.concatenate([done[active], ~new], axis=1)[row, best] | np.isneginf(near[active])
        nodes[active] = np.where(np.isneginf(near[active]), -1, nodes[active])
    return nodes, near


def robust_prune(x: np.ndarray, owners: np.ndarray, choices: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """At most ``degree`` of each owner's choices (-1: none): the nearest that no kept one stands in front of."""
    valid = (choices >= 0) & (choices != owners[:, None])
    v = x[np.maximum(choices, 0)]
    away = np.where(valid, 1 - np.einsum("ncd,nd->nc", v, x[owners]), np.inf)
    between = 1 - np.einsum("nad,nbd->nab", v, v)
    kept = np.full((len(owners), degree), -1)
    row = np.arange(len(owners))
    for i in range(degree):
        best = np.argmin(away, axis=1)
        some = np.isfinite(away[row, best])
        if not some.any():
            break
        kept[some, i] = choices[some, best[some]]
        covered = alpha * between[row, best] <= away
        covered[row, best] = True
        away[covered & some[:, None]] = np.inf
    return kept


def build(x: np.ndarray, search: Search) -> np.ndarray:
    """The adjacency lists (-1: none) of a graph over unit vectors, built in growing batches."""
    n = len(x)
    graph = np.full((n, search.degree), -1)
    order = np.random.default_rng(SEED).permutation(n)
    medoid = int(np.argmax(x @ x.mean(axis=0)))
    order = np.concatenate([[medoid], order[order != medoid]])
    done = 1
    while done < n:
        batch = order[done : min(n, done + max(1, min(done, 256)))]
        found, _ = greedy(graph, x, batch, medoid, search.beam)
        graph[batch] = robust_prune(x, batch, found, search.degree, search.alpha)
        # Links back; a node that gets too many chooses anew.
        source = np.repeat(batch, search.degree)
        target = graph[batch].ravel()
        source, target = source[target >= 0], target[target >= 0]
        order_by = np.argsort(target, kind="stable")
        source, target = source[order_by], target[order_by]
        first = np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]]))
        place = np.arange(len(target)) - np.repeat(first, np.diff(np.append(first, len(target))))
        owners = target[first]
        for low in range(0, int(place.max(initial=-1)) + 1, search.degree):
            here = (place >= low) & (place < low + search.degree)
            back = np.full((len(owners), search.degree), -1)
            back[np.searchsorted(owners, target[here]), place[here] - low] = source[here]
            some = (back >= 0).any(axis=1)
            choices = np.concatenate([graph[owners[some]], back[some]], axis=1)
            graph[owners[some]] = robust_prune(x, owners[some], choices, search.degree, search.alpha)
        done += len(batch)
    return graph


def in_range(graph: np.ndarray, x: np.ndarray, exact: np.ndarray, search: Search, threshold: float):
    """Pairs (query, node) at or above the threshold, verified in double precision, block by block of queries.

    With each block come its queries and the similarity of the nearest other node they met.
    """
    medoid = int(np.argmax(x @ x.mean(axis=0)))
    # From what is in range the search goes on along edges of either direction.
    source, target = np.nonzero(graph >= 0)[0], graph[graph >= 0]
    source, target = np.concatenate([source, target]), np.concatenate([target, source])
    target = target[np.argsort(source, kind="stable")]
    degree = np.bincount(source, minlength=len(x))
    starts = np.cumsum(degree) - degree
    slack = threshold - 1e-4
    for first in range(0, len(x), 256):
        queries = np.arange(first, min(len(x), first + 256))
        nodes, near = greedy(graph, x, queries, medoid, search.beam)
        seen = np.zeros((len(queries), len(x)), dtype=bool)
        seen[np.arange(len(queries)), queries] = True
        q, i = np.nonzero(nodes >= 0)
        seen[q, nodes[q, i]] = True
        # A query's own neighbours are looked at too, whether the search found them or not.
        q0, i0 = np.nonzero(near >= slack)
        q, v = np.concatenate([q0, np.arange(len(queries))]), np.concatenate([nodes[q0, i0], queries])
        found = [(q0, nodes[q0, i0])]
        while len(q):
            codes = [np.zeros(0, dtype=np.int64)]
            for low in range(0, len(q), 8192):
                of, at = q[low : low + 8192], v[low : low + 8192]
                n = degree[at]
                of = np.repeat(of, n)
                at = target[np.repeat(starts[at] - np.cumsum(n) + n, n) + np.arange(n.sum())]
                keep = ~seen[of, at]
                codes.append(np.unique(of[keep] * len(x) + at[keep]))
            code = np.unique(np.concatenate(codes))
            q, v = code // len(x), code % len(x)
            seen[q, v] = True
            close = np.concatenate([
                np.einsum("nd,nd->n", x[v[k : k + 65_536]], x[queries[q[k : k + 65_536]]]) for k in range(0, len(v), 65_536)
            ] or [np.zeros(0, np.float32)])
            q, v = q[close >= slack], v[close >= slack]
            found.append((q, v))
        q, v = (np.concatenate(x) for x in zip(*found))
        a = queries[q]
        q, v = a[a != v], v[a != v]
        close = np.concatenate([
            np.einsum("nd,nd->n", exact[q[k : k + 65_536]], exact[v[k : k + 65_536]]) for k in range(0, len(q), 65_536)
        ] or [np.zeros(0)])
        nearest = np.where((nodes >= 0) & (nodes != queries[:, None]), near, -np.inf).max(axis=1)
        yield q[close >= threshold], v[close >= threshold], queries, nearest


# ---- shards and units --------------------------------------------------------------


def unit_rows(vectors) -> np.ndarray:
    """Vectors in double precision, scaled to length 1."""
    table = np.array(list(vectors), dtype=np.float64)
    return table / np.linalg.norm(table, axis=1, keepdims=True)


def apart(table: np.ndarray, threshold: float) -> np.ndarray:
    """Places of the unit vectors that stay when each one within ``threshold`` of an earlier stayer goes."""
    kept = np.zeros(0, dtype=np.int64)
    for low in range(0, len(table), 1024):
        block = np.arange(low, min(len(table), low + 1024))
        free = np.ones(len(block), dtype=bool)
        for first in range(0, len(kept), 8192):
            free &= (table[block] @ table[kept[first : first + 8192]].T).max(axis=1) < threshold
        block = block[free]
        close = table[block] @ table[block].T >= threshold
        free = np.ones(len(block), dtype=bool)
        for i in range(len(block)):
            if free[i]:
                free[i + 1 :] &= ~close[i, i + 1 :]
        kept = np.concatenate([kept, block[free]])
    return kept


def shards_of(nodes: DataFrame, total: int, shard: int, overlap: int, threshold: float) -> DataFrame:
    """Adds ``shards``: the ``overlap`` nearest centroids of the node's label, as sorted numbers.

    Centroids are nodes drawn by a hash, as many as give shards of the wanted size, but
    at most ``MOST_CENTROIDS`` over all labels. Of centroids that would link with each
    other one stays, so that the border between two shards does not cut through a group
    of near copies, however large; its shard is split into pairs of blocks instead.
    """
    wanted = min(MOST_CENTROIDS, total * overlap / shard)
    drawn = nodes.where(uniform("node", seed=SEED) < wanted / max(1, total)).select("label", "node", "embedding").collect()
    centroids: dict = {}
    for r in sorted(drawn, key=lambda r: r["node"]):
        centroids.setdefault((r["label"], len(r["embedding"])), []).append((r["node"], r["embedding"]))
    tables = {}
    for key, drawn_here in centroids.items():
        names, table = np.array([n for n, _ in drawn_here]), unit_rows(e for _, e in drawn_here).astype(np.float32)
        stay = apart(table, threshold)
        tables[key] = names[stay], table[stay]
    shared = nodes.sparkSession.sparkContext.broadcast(tables)

    @F.pandas_udf("array<long>")
    def nearest(labels: pd.Series, vectors: pd.Series) -> pd.Series:
        out = [None] * len(labels)
        groups = pd.Series(range(len(labels))).groupby([labels.to_numpy(), vectors.str.len().to_numpy()])
        for key, at in groups:
            at = at.to_numpy()
            if key not in shared.value:
                for i in at:
                    out[i] = [-1]
                continue
            names, table = shared.value[key]
            k = min(overlap, len(names))
            for low in range(0, len(at), 1024):
                close = unit_rows(vectors.iloc[at[low : low + 1024]]).astype(np.float32) @ table.T
                best = np.sort(names[np.argpartition(-close, k - 1, axis=1)[:, :k]], axis=1)
                for i, row in zip(at[low : low + 1024], best):
                    out[i] = row.tolist()
        return pd.Series(out)

    return nodes.withColumn("shards", nearest("label", "embedding"))


def units_of(placed: DataFrame, shard: int) -> DataFrame:
    """A row per node and unit: (unit, node, label, embedding, copies, shards, of, own, low, high)."""
    rows = placed.withColumn("dims", F.size("embedding")).withColumn("of", F.explode("shards"))
    keys = ["label", "dims", "of"]
    large = (
        rows.groupBy(*keys).count().where(F.col("count") > shard)
        .select(*[F.col(k).alias(f"large_{k}") for k in keys], F.ceil(F.col("count") / shard).cast("int").alias("blocks"))
    )
    same = [F.col(k) == F.col(f"large_{k}") for k in keys]
    rows = rows.join(large, same[0] & same[1] & same[2], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node", "of"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    unit = F.concat_ws("/", "label", "dims", "of", low, high)
    return rows.select(unit.alias("unit"), "node", "embedding", "copies", "shards", "of", "own",
                       low.alias("low"), high.alias("high"))


def per_unit(batches, work):
    """Runs ``work`` on each unit of a partition, whose rows come sorted by unit."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        cuts = np.flatnonzero(np.append(True, batch["unit"].to_numpy()[1:] != batch["unit"].to_numpy()[:-1]))
        for a, b in zip(cuts, np.append(cuts[1:], len(batch))):
            part = batch.iloc[a:b]
            if held and held[0]["unit"].iloc[0] != part["unit"].iloc[0]:
                yield work(pd.concat(held, ignore_index=True))
                held = []
            held.append(part)
    if held:
        yield work(pd.concat(held, ignore_index=True))


def dealt(units: DataFrame) -> DataFrame:
    return units.repartition(shuffle_partitions(units.sparkSession), "unit").sortWithinPartitions("unit", "node")


def links_of(nodes: DataFrame, search: Search, threshold: float) -> DataFrame:
    """(node, n, root): links counted by a unit for a node, weighted with copies, and a node it hangs on there."""
    total = nodes.count()
    partitions = shuffle_partitions(nodes.sparkSession)
    shard = int(min(MOST_SHARD, max(LEAST_SHARD, total * search.overlap // (2 * partitions))))
    placed = pin(shards_of(nodes, total, shard, search.overlap, threshold), "placed")
    units = units_of(placed, shard)

    def graph_of(rows):
        x = unit_rows(rows["embedding"]).astype(np.float32)
        graph, names = build(x, search), rows["node"].to_numpy()
        return pd.DataFrame({"node": names, "near": [names[g[g >= 0]].tolist() for g in graph]})

    lists = dealt(units.select("unit", "node", "embedding")).mapInPandas(
        lambda batches: per_unit(batches, graph_of), "node long, near array<long>"
    )
    united = pin(
        lists.groupBy(F.col("node").alias("of_node")).agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")),
        "graph",
    )

    def search_of(rows):
        names = rows["node"].to_numpy()
        exact = unit_rows(rows["embedding"])
        x = exact.astype(np.float32)
        lists = [np.array(v, dtype=np.int64) for v in rows["near"]]
        flat = np.concatenate(lists)
        owner = np.repeat(np.arange(len(lists)), [len(v) for v in lists])
        # Of the united lists, the nodes that are in this unit.
        at = np.minimum(np.searchsorted(names, flat), len(names) - 1)
        here = names[at] == flat
        owner, at = owner[here], at[here]
        starts = np.searchsorted(owner, np.arange(len(names)))
        graph = np.full((len(names), max(1, int(np.bincount(owner, minlength=1).max(initial=0)))), -1)
        graph[owner, np.arange(len(owner)) - starts[owner]] = at
        copies, own = rows["copies"].to_numpy(), rows["own"].to_numpy()
        of, low, high = (int(rows[c].iloc[0]) for c in ("of", "low", "high"))
        width = max(len(s) for s in rows["shards"])
        shards = np.array([list(s) + [-2 - i] * (width - len(s)) for i, s in enumerate(rows["shards"])])
        count, forest, nearest = np.zeros(len(names), dtype=np.int64), Forest(len(names)), np.full(len(names), -np.inf)
        for q, v, asked, met in in_range(graph, x, exact, search, threshold):
            nearest[asked] = met
            if low != high:
                keep = own[q] != own[v]
                q, v = q[keep], v[keep]
            # Counted in the first shard that both ends share.
            common = np.where((shards[q][:, :, None] == shards[v][:, None, :]).any(axis=2), shards[q], np.iinfo(np.int64).max)
            keep = common.min(axis=1, initial=np.iinfo(np.int64).max) == of
            q, v = q[keep], v[keep]
            np.add.at(count, q, copies[v])
            forest.link(q, v)
        return counted_rows(names, count, forest, nearest >= threshold - NEAR)

    rows = units.join(united, F.col("node") == F.col("of_node")).drop("of_node")
    return dealt(rows).mapInPandas(
        lambda batches: per_unit(batches, search_of), "node long, n long, root long"
    )


def counted_rows(names: np.ndarray, count: np.ndarray, forest: Forest, near: np.ndarray | bool = False) -> pd.DataFrame:
    """The nodes that have links or something near, with their links and a node they hang on."""
    some = (count > 0) | (forest.root != np.arange(len(names))) | near
    return pd.DataFrame({"node": names[some], "n": count[some], "root": names[forest.root[some]]})


def exact_links(nodes: DataFrame, threshold: float) -> DataFrame:
    """As ``links_of``, from all pairs of a label: each pair of its blocks is compared in a unit of its own."""
    partitions = shuffle_partitions(nodes.sparkSession)
    shard = int(min(MOST_SHARD, max(LEAST_SHARD, nodes.count() // partitions)))
    units = units_of(nodes.withColumn("shards", F.array(F.lit(-1).cast("long"))), shard)

    def compare(rows):
        names, copies, own = (rows[c].to_numpy() for c in ("node", "copies", "own"))
        exact = unit_rows(rows["embedding"])
        low, high = int(rows["low"].iloc[0]), int(rows["high"].iloc[0])
        left, right = np.flatnonzero(own == low), np.flatnonzero(own == high)
        count, forest = np.zeros(len(names), dtype=np.int64), Forest(len(names))
        for first in range(0, len(left), 256):
            a = left[first : first + 256]
            close = (exact[a] @ exact[right].T >= threshold) & (a[:, None] != right[None, :])
            count[a] += close @ copies[right]
            if low != high:
                count[right] += copies[a] @ close
            q, v = np.nonzero(close)
            forest.link(a[q], right[v])
        return counted_rows(names, count, forest)

    return dealt(units.select("unit", "node", "embedding", "copies", "own", "low", "high")).mapInPandas(
        lambda batches: per_unit(batches, compare), "node long, n long, root long"
    )


def audited_recall(nodes: DataFrame, counted: DataFrame, threshold: float, sample: int) -> tuple[float, float | None]:
    """Mean share of a linked node's links that were counted, and the lower end of its 95 % interval.

    Of the nodes in ``counted``, which have links or something near, and of the others about
    ``sample`` each are compared with all nodes; each stands for its part of its kind. The
    interval is None where no node that was asked has links, and the share then 1.
    """
    total, likely = nodes.count(), counted.count()
    of = counted.select(F.col("node").alias("of"), F.col("n").alias("found"))
    asked_likely = of.where(uniform("of", seed=SEED + 1) < sample / max(1, likely))
    # Both sides of these joins that are not all nodes hold about ``sample`` rows.
    first = nodes.join(F.broadcast(asked_likely), F.col("node") == F.col("of")).select("node", "label", "embedding", "found")
    drawn = nodes.where(uniform("node", seed=SEED + 2) < sample / max(1, total - likely)).select("node", "label", "embedding")
    rest = drawn.join(of, F.col("node") == F.col("of"), "left_anti").withColumn("found", F.lit(None).cast("long"))
    asked = first.union(rest).collect()
    found = {r["node"]: r["found"] for r in asked}
    expected = {r["asked"]: r["expected"] for r in true_links(nodes, asked, threshold).collect()}
    top = bottom = spread = 0.0
    for kind, size in ((True, likely), (False, total - likely)):
        of_kind = [n for n, f in found.items() if (f is not None) is kind]
        shares = np.array([min(1.0, (found[n] or 0) / expected[n]) if expected.get(n) else np.nan for n in of_kind])
        linked = ~np.isnan(shares)
        weight = size / max(1, len(of_kind))
        top, bottom = top + weight * np.nansum(shares), bottom + weight * linked.sum()
        spread += weight**2 * len(of_kind) * float(np.var(np.where(linked, 1 - np.nan_to_num(shares), 0.0))) if len(of_kind) else 0.0
    if not bottom:
        return 1.0, None
    recall = float(top / bottom)
    return recall, max(0.0, recall - 1.96 * float(np.sqrt(spread)) / float(bottom))


def true_links(nodes: DataFrame, asked: list, threshold: float) -> DataFrame:
    """(asked, expected): the links of the given nodes, found among all nodes of their label; none without any."""
    tables: dict = {}
    for r in asked:
        tables.setdefault((r["label"], len(r["embedding"])), []).append((r["node"], r["embedding"]))
    tables = {k: (np.array([n for n, _ in v]), unit_rows(e for _, e in v)) for k, v in tables.items()}
    shared = nodes.sparkSession.sparkContext.broadcast(tables)

    def compare(batches):
        for batch in batches:
            rows = []
            for key, group in batch.groupby([batch["label"], batch["embedding"].str.len()]):
                if key in shared.value:
                    names, table = shared.value[key]
                    close = unit_rows(group["embedding"]) @ table.T >= threshold
                    close &= group["node"].to_numpy()[:, None] != names[None, :]
                    weight = group["copies"].to_numpy() @ close
                    rows.append(pd.DataFrame({"asked": names, "expected": weight}))
            yield pd.concat(rows) if rows else pd.DataFrame({"asked": [], "expected": []}, dtype="int64")

    true = nodes.select("node", "label", "embedding", "copies").mapInPandas(compare, "asked long, expected long")
    return true.groupBy("asked").agg(F.sum("expected").alias("expected")).where("expected > 0")


def near_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
                 threshold: float = THRESHOLD, search: Search = Search(), target: float = TARGET_RECALL,
                 audit_nodes: int = AUDIT_NODES, rounds: int = 3, floor: float = FLOOR_RECALL) -> DataFrame:
    """(vec_id, n_links, component_id, kept, recall, recall_low) of every row.

    ``recall`` is what the audit measured and ``recall_low`` the lower end of its interval; both
    are 1 where all pairs were compared.
    """
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("embedding"), F.col(label).alias("label"))
    infinite = float("inf")
    usable = (
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
        & F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < infinite))
        & F.exists("embedding", lambda v: v != 0)
    )
    usable = F.coalesce(usable, F.lit(False))
    nodes = pin(
        rows.where(usable).groupBy("label", "embedding").agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .withColumn("node", F.monotonically_increasing_id()),
        "vector-nodes",
    )
    for left in reversed(range(rounds)):
        found = pin(links_of(nodes, search, threshold), "vector-links")
        counted = found.groupBy("node").agg(F.sum("n").alias("n"))
        recall, low = audited_recall(nodes, counted, threshold, audit_nodes)
        if recall >= target or not left:
            break
        search = search.wider()
    if recall < floor:
        found = pin(exact_links(nodes, threshold), "vector-links")
        counted, recall, low = found.groupBy("node").agg(F.sum("n").alias("n")), 1.0, 1.0
    tree = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    named = (
        nodes.select("node", "first_id", "copies", F.col("label").alias("node_label"), F.col("embedding").alias("vector"))
        .join(tree.withColumnRenamed("node", "in_tree"), F.col("node") == F.col("in_tree"), "left")
        .withColumn("tree", F.coalesce("component", "node"))
    )
    least = named.groupBy(F.col("tree").alias("of_tree")).agg(F.min("first_id").alias("least_id"))
    counts = counted.withColumnRenamed("node", "of_node")
    known = (
        named.join(least, F.col("tree") == F.col("of_tree"))
        .join(counts, F.col("node") == F.col("of_node"), "left")
        .select("node_label", "vector", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("links"), "least_id")
    )
    joined = rows.withColumn("usable", usable).join(
        known, F.col("usable") & (F.col("label") == F.col("node_label")) & (F.col("embedding") == F.col("vector")), "left"
    )
    component = F.coalesce("least_id", "vec_id")
    return joined.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.cast("long").alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"), F.lit(float(recall)).alias("recall"),
        F.lit(low).cast("double").alias("recall_low"),
    )
