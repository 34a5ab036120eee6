"""SimHash near duplicates: fingerprints joined with themselves in binary tries.

Every distinct fingerprint stands in four tries, one per rotation by 16 bits. Two
fingerprints within three bits agree in one of four 16-bit parts, so in one of the
tries they share the first 16 levels; there the join goes on with the budget left:
pairs of nodes descend together, differing bits add up, and a pair whose sum exceeds
the budget is dropped. Pairs of small nodes are compared outright. What shares its
first 16 levels with too many others is split into blocks whose pairs are joined
in tasks of their own. Tasks report links as forests, never all pairs.

Defined results: a NULL or wordless text has fingerprint zero and links like any
other; fewer words than a shingle are one shingle; a fingerprint all of whose rows
lack an id has the component of the ids it is linked with, else NULL; equal
fingerprints are one node, so copies cost nothing; an empty table gives no rows;
other columns never matter.

``distinct_similar_rows`` looks for texts of a similarity: the share of shingles two texts
have in common. There every text has ``FAMILIES`` fingerprints of its set of shingles, and
the tries find candidates: texts that in one of them agree in a 16-bit part and differ in
``CANDIDATE_BUDGET`` bits at most. Groups of candidates are then gone through by leaders:
the text with the smallest id stays, those whose exact similarity to it reaches the
limit go, and the rest of the group has its next leader, for ``LEADERS`` rounds. What no
leader covers by then is compared by shingles that it has and most of its group lack, or the
other way round: two texts of the similarity share one of the rarest of each, with enough left
behind it in both, so all such pairs of a group are met and few others, and of those the text
with the smaller id stays again. So nothing goes without a similar text that stays, and of two similar
texts of a group one goes; what the fingerprints miss stays, the more the lower the similarity.
"""

from __future__ import annotations

from functools import reduce
from itertools import count

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comarca.llm.components import components
from comarca.llm.frames import bounded_batches, free_names, shuffle_partitions
from comarca.sinks.pinned import pin

SHINGLE = 3
HASH_SEED = 42
BUDGET = 3
BITS = 64
PARTS = 4
PART_BITS = BITS // PARTS
# Texts of a similarity: words of a shingle, limit, fingerprints a text, differing bits of a candidate, rounds.
SIMILAR_SHINGLE = 5
SIMILARITY = 0.8
FAMILIES = 6
CANDIDATE_BUDGET = 8
LEADERS = 8
# Texts with a shingle in common are met by the first of them while there are more pairs than so many times
# the shingles, for so many rounds; then pair by pair.
PAIRS_A_KEY = 16
HEADS = 8
# Stands for a shingle of texts that have hardly any that sets them apart; a hash equal to it does no harm.
NOTHING_ODD = 0
# Rounds in which of linked texts the smaller id stays; chains longer than that go on in a shuffled order.
ID_ROUNDS = 40
# The order of members.
RANK = ("no_id", "least", "node")
# Pairs of nodes with at most so many pairs of fingerprints are compared outright.
OUTRIGHT = 64
# Pairs handled at once in a task, for its memory.
AT_ONCE = 1 << 20
LEAST_BLOCK = 256


def shingle_hashes(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """A hash of every shingle of a text, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype="<u8")
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, HASH_SEED)]
    else:
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
        ends = np.cumsum(lengths) - 1
        starts = (ends - lengths + 1)[: len(words) - shingle + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], HASH_SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist())]
    return np.array(hashes, dtype="<u8")


def fingerprint_of(hashes: np.ndarray) -> int:
    """The bits that more than half the hashes have, as a signed number; 0 without any."""
    table = hashes.view(np.uint8).reshape(len(hashes), 8)
    set_bits = np.zeros(BITS, dtype=np.int64)
    for first in range(0, len(table), 4096):
        set_bits += np.unpackbits(table[first : first + 4096], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The SimHash of a text as a signed 64-bit number."""
    return fingerprint_of(shingle_hashes(text, shingle))


def family(hashes: np.ndarray, number: int) -> np.ndarray:
    """The hashes mixed anew for each number but 0, so that their bits tell something else."""
    if not number:
        return hashes
    mixed = (hashes ^ np.uint64(number * 0x9E3779B97F4A7C15 % (1 << 64))) * np.uint64(0xD6E8FEB86659FD93)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return mixed ^ (mixed >> np.uint64(32))


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    @F.pandas_udf(T.LongType())
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return of(text)


def hexadecimal(bits: Column) -> Column:
    return F.lpad(F.lower(F.hex(bits)), 16, "0")


class Forest:
    """Which of ``n`` nodes hang together, kept as the least node of each tree."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray):
        while len(a):
            ra, rb = self.root[a], self.root[b]
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.root, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up


def _pairs(a0, a1, b0, b1, same):
    """All (i, j) of each pair of ranges, in chunks; i < j where both ranges are the same."""
    sizes = (a1 - a0) * (b1 - b0)
    first = 0
    while first < len(sizes):
        upto = first + max(1, int(np.searchsorted(np.cumsum(sizes[first:]), AT_ONCE, side="right")))
        n = sizes[first:upto]
        of = np.repeat(np.arange(first, upto), n)
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        width = (b1 - b0)[of]
        i, j = a0[of] + k // width, b0[of] + k % width
        keep = ~same[of] | (i < j)
        yield i[keep], j[keep]
        first = upto


def join_tries(values: np.ndarray, roots: tuple[np.ndarray, ...], forest: Forest, budget: int, depth: int = PART_BITS):
    """Links values within ``budget`` bits, for pairs of tries given as ranges of sorted values.

    ``roots`` holds starts and ends of the left and right tries and whether both are
    the same one. All values of a trie share their bits above ``depth``.
    """
    waiting = [(depth, *roots, np.zeros(len(roots[0]), dtype=np.int64))]
    while waiting:
        depth, a0, a1, b0, b1, same, spent = waiting.pop()
        if len(a0) > AT_ONCE:
            half = len(a0) // 2
            rest = (a0, a1, b0, b1, same, spent)
            waiting += [(depth, *(x[:half] for x in rest)), (depth, *(x[half:] for x in rest))]
            continue
        small = ((a1 - a0) * (b1 - b0) <= OUTRIGHT) | (depth == BITS)
        for i, j in _pairs(a0[small], a1[small], b0[small], b1[small], same[small]):
            near = np.bitwise_count(values[i] ^ values[j]) <= budget
            forest.link(i[near], j[near])
        a0, a1, b0, b1, same, spent = (x[~small] for x in (a0, a1, b0, b1, same, spent))
        if not len(a0):
            continue
        # Children of a node: the values with the next bit clear come first.
        ones = np.concatenate([[0], np.cumsum((values >> np.uint64(BITS - 1 - depth)) & np.uint64(1), dtype=np.int64)])
        am, bm = a1 - (ones[a1] - ones[a0]), b1 - (ones[b1] - ones[b0])
        down = [
            (a0, am, b0, bm, same, spent),
            (am, a1, bm, b1, same, spent),
            (a0, am, bm, b1, np.zeros_like(same), spent + 1),
            # In a join of a trie with itself this pair is the one before.
            *[(x[~same] for x in (am, a1, b0, bm, same, spent + 1))],
        ]
        a0, a1, b0, b1, same, spent = (np.concatenate(x) for x in zip(*(tuple(d) for d in down)))
        alive = (a1 > a0) & (b1 > b0) & (spent <= budget)
        waiting.append((depth + 1, *(x[alive] for x in (a0, a1, b0, b1, same, spent))))


def linked_fingerprints(nodes: DataFrame, budget: int = BUDGET) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``bits``, enough to join all that are within the budget."""
    if budget >= PARTS:
        raise ValueError(f"{PARTS} tries find pairs of at most {PARTS - 1} differing bits")
    return trie_links(nodes.select(F.lit(0).alias("family"), "bits"), budget).select("a", "b")


def trie_links(nodes: DataFrame, budget: int) -> DataFrame:
    """Links (family, a, b) between distinct (family, bits) that agree in one of the parts and are within the budget.

    Up to ``PARTS`` - 1 differing bits there always is such a part.
    """
    spark = nodes.sparkSession
    partitions = shuffle_partitions(spark)
    block = max(LEAST_BLOCK, nodes.count() * PARTS // (2 * partitions))

    def rotated(r):
        turn = F.shiftleft("bits", PART_BITS * r).bitwiseOR(F.shiftrightunsigned("bits", BITS - PART_BITS * r))
        return turn if r else F.col("bits")

    turns = F.explode(F.array(*[F.struct(F.lit(r).alias("turn"), rotated(r).alias("value")) for r in range(PARTS)]))
    rows = nodes.select("family", "bits", turns.alias("t")).select(
        "bits", (F.col("family") * PARTS + F.col("t.turn")).alias("turn"), "t.value"
    )
    rows = rows.withColumn("part", F.shiftrightunsigned("value", BITS - PART_BITS))
    large = (
        rows.groupBy("turn", "part").count().where(F.col("count") > block)
        .select(F.col("turn").alias("of_turn"), F.col("part").alias("of_part"),
                F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    )
    # A large part is split at random; each pair of its blocks is joined somewhere.
    placed = rows.join(
        large, (F.col("turn") == F.col("of_turn")) & (F.col("part") == F.col("of_part")), "left"
    ).withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    placed = placed.withColumn("own", F.pmod(F.xxhash64("bits"), F.col("blocks")).cast("int"))
    units = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "bits", "value", "own",
        F.struct("turn", "part", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")).alias("unit"),
    ).select("bits", "value", "own", F.xxhash64("unit").alias("spread"), "unit.*")

    def join(batches):
        held = [b for b in batches if len(b)]
        if not held:
            return
        whole = pd.concat(held, ignore_index=True)
        keys = ["turn", "part", "low", "high", "own"]
        value = whole["value"].to_numpy(np.int64).view(np.uint64)
        order = np.lexsort([value, *(whole[k].to_numpy() for k in reversed(keys))])
        whole, value = whole.iloc[order], value[order]
        table = whole[keys].to_numpy(np.int64)
        starts = np.flatnonzero(np.concatenate([[True], (table[1:] != table[:-1]).any(axis=1)]))
        ends = np.append(starts[1:], len(table))
        low, high, own = table[starts, 2], table[starts, 3], table[starts, 4]
        alone = low == high
        # Both blocks of a pair lie side by side.
        left = np.flatnonzero(~alone & (own == low))
        left = left[left + 1 < len(starts)]
        left = left[(table[starts[left], :4] == table[starts[left + 1], :4]).all(axis=1)]
        a = np.concatenate([np.flatnonzero(alone), left])
        b = np.concatenate([np.flatnonzero(alone), left + 1])
        forest = Forest(len(value))
        same = np.arange(len(a)) < alone.sum()
        join_tries(value, (starts[a], ends[a], starts[b], ends[b], same), forest, budget)
        bits = whole["bits"].to_numpy()
        hung = np.flatnonzero(forest.root != np.arange(len(value)))
        yield pd.DataFrame({"family": table[hung, 0] // PARTS, "a": bits[hung], "b": bits[forest.root[hung]]})

    dealt = units.repartition(partitions, "spread").drop("spread")
    return dealt.mapInPandas(join, "family int, a long, b long").where("a <> b")


def _trees(rows: DataFrame, budget: int) -> DataFrame:
    """(bits, tree, least): each distinct fingerprint, what it hangs together with, and its smallest doc_id."""
    nodes = pin(rows.groupBy("bits").agg(F.min("doc_id").alias("least")), "nodes")
    linked = components(linked_fingerprints(nodes, budget))
    return nodes.join(linked, F.col("bits") == F.col("node"), "left").select(
        "bits", F.coalesce("component", "bits").alias("tree"), "least"
    )


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    budget: int = BUDGET) -> DataFrame:
    """(doc_id, bits, component_id) of every row."""
    bounded_batches(docs.sparkSession)
    rows = pin(docs.select(F.col(doc_id).alias("doc_id"), fingerprints(F.col(text), shingle).alias("bits")), "fingerprints")
    tree = _trees(rows, budget)
    of_tree = tree.groupBy(F.col("tree").alias("of")).agg(F.min("least").alias("component_id"))
    named = tree.join(of_tree, F.col("tree") == F.col("of")).select(F.col("bits").alias("same"), "component_id")
    return rows.join(named, F.col("bits") == F.col("same")).select("doc_id", "bits", "component_id")


def distinct_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                  budget: int = BUDGET) -> DataFrame:
    """One row of ``docs``, all columns, for each group of near duplicates: one with the smallest id, if any has one.

    Of rows that repeat that id and fingerprint, one stays.
    """
    bounded_batches(docs.sparkSession)
    bits, own_bits, own_id = free_names(docs, "bits", "own_bits", "own_id")
    marked = pin(docs.withColumn(bits, fingerprints(F.col(text), shingle)), "fingerprinted")
    tree = _trees(marked.select(F.col(doc_id).alias("doc_id"), F.col(bits).alias("bits")), budget)
    first = F.min(F.struct(F.col("least").isNull().alias("no_id"), "least", "bits")).alias("first")
    winners = tree.groupBy("tree").agg(first).select(
        F.col("first.bits").alias(own_bits), F.col("first.least").alias(own_id)
    )
    same = (F.col(bits) == F.col(own_bits)) & F.col(doc_id).eqNullSafe(F.col(own_id))
    return marked.join(winners, same).dropDuplicates([own_bits, own_id]).select(*docs.columns)


def described(text: Column, shingle: int, families: int) -> Column:
    """struct<same, prints>: a name of the text's set of shingles, and the set's fingerprints.

    Repeats don't count, as they don't in the similarity: else a line that unlike texts repeat makes them candidates.
    """
    @F.pandas_udf("same string, prints array<long>")
    def of(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            hashes = np.unique(shingle_hashes(text, shingle))
            rows.append((xxhash.xxh128_hexdigest(hashes.tobytes()), [fingerprint_of(family(hashes, k)) for k in range(families)]))
        return pd.DataFrame(rows, columns=["same", "prints"])

    return of(text)


def shingle_sets(text: Column, shingle: int) -> Column:
    @F.pandas_udf("array<long>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([np.unique(shingle_hashes(t, shingle)).view(np.int64) for t in texts])

    return of(text)


def candidate_groups(nodes: DataFrame, budget: int) -> DataFrame:
    """(node, component) of the nodes (node, prints) that hang together by candidates."""
    prints = pin(nodes.select("node", F.posexplode("prints").alias("family", "bits")), "prints")
    first = pin(prints.groupBy("family", "bits").agg(F.min("node").alias("first")), "first-prints")
    links = trie_links(first.select("family", "bits"), budget)
    equal = prints.join(first, ["family", "bits"]).where("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b"))
    ends = [first.select(F.col("family").alias(f"family_{e}"), F.col("bits").alias(e), F.col("first").alias(f"node_{e}")) for e in "ab"]
    near = links.join(ends[0], (F.col("family") == F.col("family_a")) & (links.a == ends[0].a)).select("family", links.b, "node_a")
    near = near.join(ends[1], (F.col("family") == F.col("family_b")) & (near.b == ends[1].b))
    return components(equal.union(near.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))))


def similar(common: Column, a: Column, b: Column, similarity: float) -> Column:
    """Whether sets of sizes ``a`` and ``b`` reach the similarity; empty sets are alike."""
    return F.when(a + b == 0, True).otherwise(common / (a + b - common) >= similarity)


def rare_shingles(members: DataFrame, similarity: float) -> DataFrame:
    """(component, shingle, size, rank, rest, excess): two members of a component that reach the similarity share one of these.

    A member is told by its odd shingles: those it has and most of its component lack, and those it
    lacks and most have. Sets of sizes a and b that reach the similarity differ in at most
    k * (a + b) shingles, k = (1 - similarity) / (1 + similarity), so their odd shingles in common
    are at least half the sum of both ``excess``: the number of odd ones less k times the size.
    Of these, rarest in the component first, a member has as many as leave too few for that behind
    them; ``rest`` counts a shingle and those behind it. Odd shingles of one member only come
    before all others and are none of them. Members that may be similar without an odd shingle in
    common share ``NOTHING_ODD``.
    """
    k = (1 - similarity) / (1 + similarity)
    size, none = F.size("shingles"), F.array().cast("array<bigint>")
    own = ["component", "size", "rank"]
    # Read twice, to count and to rank.
    held = pin(members.select("component", size.alias("size"), F.struct(*RANK).alias("rank"), F.explode("shingles").alias("shingle")), "held")
    n = members.groupBy(F.col("component").alias("of")).agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    times = held.groupBy("component", "shingle").agg(F.count(F.lit(1)).alias("had")).where("had > 1")
    common = F.col("had") * 2 > F.col("members")
    # Odd is a shingle to those that have it, a common one to those that lack it.
    times = pin(
        times.join(n, F.col("component") == F.col("of"))
        .select("component", "shingle", common.alias("common"), F.when(common, F.col("members") - F.col("had")).otherwise(F.col("had")).alias("times")),
        "times",
    )
    core = times.where("common").groupBy(F.col("component").alias("core_of")).agg(F.collect_list("shingle").alias("core"))
    core = pin(n.join(core, F.col("of") == F.col("core_of"), "left").select("of", F.coalesce("core", none).alias("core")), "common-shingles")
    told = members.join(core, F.col("component") == F.col("of")).select(
        "component", size.alias("size"), F.struct(*RANK).alias("rank"), F.size("core").alias("core"),
        F.size(F.array_except("shingles", "core")).alias("extra"), F.array_except("core", "shingles").alias("lacks"),
    ).withColumn("odd", F.col("extra") + F.size("lacks"))
    # The other set has at most size / similarity shingles; with no common shingles both share similarity * size.
    over = F.col("odd") - F.col("size") * (k + k / similarity)
    least = F.when(F.col("core") == 0, F.col("size") * similarity).otherwise(F.greatest(over, over / 2))
    # A little less than the product, which may be rounded up.
    told = pin(told.withColumn("excess", F.col("odd") - F.col("size") * k).withColumn("least", F.ceil(least - 1e-6).cast("int")), "told")
    shared = times.where("times > 1")
    odd = held.join(shared.where("NOT common"), ["component", "shingle"]).select(*own, "times", "shingle").union(
        told.select(*own, F.explode("lacks").alias("shingle")).join(shared.where("common"), ["component", "shingle"]).select(*own, "times", "shingle")
    )
    bounds = told.select(F.col("rank.node").alias("of_node"), "excess", "least")
    ranked = odd.groupBy(*own).agg(F.sort_array(F.collect_list(F.struct("times", "shingle"))).alias("ranked"))
    ranked = ranked.join(bounds, F.col("rank.node") == F.col("of_node"))
    own.append("excess")
    first = F.slice("ranked", F.lit(1), F.greatest(F.size("ranked") - F.col("least") + 1, F.lit(0)))
    placed = ranked.select(*own, F.size("ranked").alias("shared"), F.posexplode(first).alias("before", "key"))
    columns = ["component", "shingle", "size", "rank", "rest", "excess"]
    return (
        placed.select(*own, "key.shingle", (F.col("shared") - F.col("before")).alias("rest")).select(*columns)
        .union(told.where("least <= 0").select(*own, F.lit(NOTHING_ODD).cast("long").alias("shingle"), F.lit(0).alias("rest")).select(*columns))
    )


def met_by_shingles(keys: DataFrame, similarity: float) -> DataFrame:
    """(node, leader) of members that share a rare shingle with enough behind it in both, once for each such shingle.

    The first odd shingle that two members of the similarity share has all others they share behind it
    in both. The one of less excess is looked for only by shingles that leave enough for two of its excess.
    """
    a, b = (
        keys.select("component", "shingle", *[F.col(c).alias(f"{c}_{e}") for c in ("size", "rank", "rest", "excess")]) for e in "ab"
    )
    once = (F.col("excess_a") < F.col("excess_b")) | ((F.col("excess_a") == F.col("excess_b")) & (F.col("rank_a") < F.col("rank_b")))
    enough = F.least("rest_a", "rest_b") >= (F.col("excess_a") + F.col("excess_b")) / 2 - 1e-6
    sizes = F.least("size_a", "size_b") >= F.greatest("size_a", "size_b") * similarity - 1e-6
    met = a.where("rest_a >= excess_a - 1e-6").join(b, ["component", "shingle"]).where(once & enough & sizes)
    return met.select(F.greatest("rank_a", "rank_b")["node"].alias("node"), F.least("rank_a", "rank_b")["node"].alias("leader"))


def verified(pairs: DataFrame, members: DataFrame, similarity: float) -> DataFrame:
    """The pairs (node, leader) of members that reach the similarity."""
    sets = [members.select(F.col("node").alias(f"of_{e}"), F.col("shingles").alias(f"set_{e}")) for e in "ab"]
    both = pairs.join(sets[0], F.col("node") == F.col("of_a")).join(sets[1], F.col("leader") == F.col("of_b"))
    common = F.size(F.array_intersect("set_a", "set_b"))
    return both.where(similar(common, F.size("set_a"), F.size("set_b"), similarity)).select("node", "leader")


def _without(rows: DataFrame, node: Column, gone: DataFrame) -> DataFrame:
    return rows.join(gone.select(F.col("node").alias("left_out")), node == F.col("left_out"), "left_anti")


def covered_by_links(links: DataFrame) -> list[DataFrame]:
    """(node, leader) from links (node, leader), the leader before the node in one order: nodes that go, each beside one that stays.

    A round keeps the nodes without a leader; those they lead go, and so do all their links.
    """
    found = []
    for number in count():
        if links.isEmpty():
            return found
        if number == ID_ROUNDS:
            # A chain in the order of its ids takes a round for each link, in any other order few.
            a, b = (F.struct(F.xxhash64(c).alias("turn"), F.col(c).alias("node")) for c in ("leader", "node"))
            links = pin(links.select(F.greatest(a, b)["node"].alias("node"), F.least(a, b)["node"].alias("leader")), "links")
        stay = links.select(F.col("leader").alias("stays")).distinct()
        stay = stay.join(links.select("node").distinct(), F.col("stays") == F.col("node"), "left_anti")
        gone = pin(
            links.join(stay, F.col("leader") == F.col("stays")).groupBy("node").agg(F.min("leader").alias("leader")), "gone"
        )
        found.append(gone)
        links = pin(_without(_without(links, links.node, gone), links.leader, gone), "links")


def covered_by_pairs(members: DataFrame, similarity: float) -> list[DataFrame]:
    """(node, leader) of all members similar to one that stays, whatever number of leaders that takes."""
    keys, found = pin(rare_shingles(members, similarity), "rare-shingles"), []
    for _ in range(HEADS):
        heads = keys.groupBy("component", "shingle").agg(
            F.min("rank").alias("head"), F.count(F.lit(1)).cast("double").alias("n"),
            F.count_if(F.col("rest") >= F.col("excess") - 1e-6).alias("looked_for"),
        )
        n, pairs = heads.agg(F.sum("n"), F.sum(F.col("looked_for") * (F.col("n") - 1))).first()
        if not n or pairs <= PAIRS_A_KEY * n:
            break
        # Whoever comes first under each of its shingles has no similar one before it.
        led = pin(
            keys.join(heads, ["component", "shingle"]).select(F.col("rank.node").alias("node"), F.col("head.node").alias("leader")).distinct(),
            "led",
        )
        stay = led.groupBy("node").agg(F.max(F.col("node") != F.col("leader")).alias("later")).where("NOT later").select("node")
        near = led.where("node <> leader").join(stay.select(F.col("node").alias("stays")), F.col("leader") == F.col("stays"))
        gone = pin(verified(near.select("node", "leader"), members, similarity), "gone")
        found.append(gone.groupBy("node").agg(F.min("leader").alias("leader")))
        keys = pin(_without(keys, F.col("rank.node"), stay.union(gone.select("node").distinct())), "rare-shingles")
    pairs = pin(met_by_shingles(keys, similarity).distinct(), "pairs")
    return found + covered_by_links(pin(verified(pairs, members, similarity), "links"))


def covered_nodes(members: DataFrame, similarity: float, leaders: int) -> DataFrame:
    """(node, leader) of members (node, component, no_id, least, shingles) that one of their component that stays covers.

    The first ``leaders`` that stay are each compared with all of their component, the rest by their rare shingles.
    """
    found = []
    for _ in range(leaders):
        first = members.groupBy(F.col("component").alias("of")).agg(F.min(F.struct(*RANK)).alias("first"))
        chosen = first.select(F.col("first.node").alias("leader"))
        led = pin(
            members.join(chosen, F.col("node") == F.col("leader"))
            .select(F.col("component").alias("of"), "leader", F.col("shingles").alias("leads")), "leaders",
        )
        # One leader for each component on this side, so a large component's rows can be split.
        both = members.join(led, F.col("component") == F.col("of")).where("node <> leader")
        common = F.size(F.array_intersect("shingles", "leads"))
        judged = pin(
            both.withColumn("covered", similar(common, F.size("shingles"), F.size("leads"), similarity)).drop("of", "leads"), "judged"
        )
        found.append(judged.where("covered").select("node", "leader"))
        members = judged.where("NOT covered").drop("covered", "leader")
        if members.isEmpty():
            break
    else:
        found += covered_by_pairs(members, similarity)
    return reduce(DataFrame.union, found, members.select("node", F.col("node").alias("leader")).where("false"))


def distinct_similar_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SIMILAR_SHINGLE,
                          similarity: float = SIMILARITY, families: int = FAMILIES, budget: int = CANDIDATE_BUDGET,
                          leaders: int = LEADERS) -> DataFrame:
    """The rows of ``docs``, all columns, without those whose text is similar to that of a row which stays.

    Texts of one set of shingles are one; of their rows the one with the smallest id stays, if
    any has one. Texts without words are one too.
    """
    bounded_batches(docs.sparkSession)
    described_as, row = free_names(docs, "described", "row")
    marked = pin(
        docs.withColumn(described_as, described(docs[f"`{text}`"], shingle, families)).withColumn(row, F.monotonically_increasing_id()),
        "described",
    )
    own_id = marked[f"`{doc_id}`"]
    first = F.min(F.struct(own_id.isNull().alias("no_id"), own_id.alias("least"), F.col(row).alias("row"))).alias("first")
    nodes = pin(
        marked.groupBy(F.col(f"{described_as}.same").alias("same"))
        .agg(first, F.min(f"{described_as}.prints").alias("prints"))
        .select("first.*", "prints").withColumn("node", F.col("row")),
        "nodes",
    )
    groups = pin(candidate_groups(nodes, budget).select(F.col("node").alias("of"), "component"), "groups")
    grouped = nodes.join(groups, F.col("node") == F.col("of")).select("node", "component", "no_id", "least")
    texts = marked.select(F.col(row).alias("at"), marked[f"`{text}`"].alias("text"))
    members = pin(
        texts.join(grouped, F.col("at") == F.col("node"))
        .select("node", "component", "no_id", "least", shingle_sets(F.col("text"), shingle).alias("shingles")),
        "members",
    )
    gone = covered_nodes(members, similarity, leaders).select(F.col("node").alias("gone"))
    stay = nodes.select("node").join(gone, F.col("node") == F.col("gone"), "left_anti").select(F.col("node").alias("stays"))
    return marked.join(pin(stay, "stay"), F.col(row) == F.col("stays")).select(*[marked[f"`{c}`"] for c in docs.columns])
