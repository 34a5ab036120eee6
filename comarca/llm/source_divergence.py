"""How much the sources of a language differ in the words they use.

Terms are counted by single-pass in-memory indexing:

1. each task collects a block of ``BLOCK_WORDS`` words (or one longer text), turns it into
   postings and lets them go as a run sorted by term, in parts by hash shard; so a term is
   there once per block, however frequent it is;
2. a task that gets the parts of a shard heap-merges them, ``MERGE_POSTINGS`` at a time, and
   adds up the postings of each term;
3. Spark adds up what several merges left apart, keeps the terms of at least
   ``least_documents`` rows of a language and gives each group its shares.

A group is a (language, source) that occurs. A kept term's share in a group is
p = 1 + floor(1e9 * (count + 5) / (N + 5 V)), in whole numbers throughout; N is the sum of
the group's counts and V the number of the language's kept terms. Part ``pair`` compares
all sources of a language: two groups that both lack a term differ in it by what their
shares of an absent term differ, so V times that difference, known without the terms, is
corrected while the postings go by, term by term, in blocks of ``SOURCES`` by ``SOURCES``
sources. Part ``term`` ranks the terms that a group has more of than its language.

Defined results: NULL text, language and source count as ''; a row without terms still
makes its group occur; a language without kept terms has pairs of value 0 and no terms;
a language of one source has no pairs; repeated rows count as documents each; ties
rank by the item's UTF-8 bytes; an empty table gives no rows; other columns never matter.
"""

from __future__ import annotations

import heapq
import itertools
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from comarca.llm.frames import bounded_batches, shuffle_partitions
from comarca.llm.packing import packed, unpacked
from comarca.sinks.pinned import pin

LEAST_DOCUMENTS = 30
TERM_RANKS = 50
UNIT = 1_000_000_000
ADDED = 5
# Words of a block, and of the runs that one merge holds; some 30 bytes each in a task.
BLOCK_WORDS = 4_000_000
MERGE_POSTINGS = 4_000_000
# Bytes of one text that are cut into terms at a time.
PIECE = 1 << 20
# Sources to a side of a block of pairs, and parts that the terms of such a block are dealt to.
SOURCES = 256
PARTS = 16

# Bytes of `[^\x00-\x40\x5B-\x60\x7B-\x7F]` once A-Z are lower-cased: in UTF-8 all others are below 0x80.
_TERMS = re.compile(rb"[a-z\x80-\xff]+")
_BREAK = re.compile(rb"[^A-Za-z\x80-\xff]")
RUN = pa.schema([
    ("lang", pa.string()), ("shard", pa.int32()), ("n", pa.int64()), ("terms", pa.binary()), ("docs", pa.binary()),
    ("lengths", pa.binary()), ("places", pa.binary()), ("counts", pa.binary()), ("sources", pa.list_(pa.string())),
])
RUN_DDL = (
    "lang string, shard int, n long, terms binary, docs binary, lengths binary, places binary, counts binary, "
    "sources array<string>"
)
POSTINGS = pa.schema([
    ("lang", pa.string()), ("term", pa.binary()), ("docs", pa.int64()),
    ("sources", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())),
])
POSTINGS_DDL = "lang string, term binary, docs long, sources array<string>, counts array<long>"


def term_lists(data: bytes) -> Iterator[list[bytes]]:
    """The terms of a whole text, some at a time, cut where no term goes on."""
    at = 0
    while at < len(data):
        end = at + PIECE
        if end < len(data):
            found = _BREAK.search(data, end)
            end = found.start() if found else len(data)
        yield _TERMS.findall(data[at:end].lower())
        at = end


class Block:
    """The texts of some documents as numbers of their terms."""

    def __init__(self):
        self.numbers: dict[bytes, int] = defaultdict(count().__next__)
        self.groups: dict[tuple[str, str], int] = defaultdict(count().__next__)
        self.words: list[np.ndarray] = []
        self.group_of: list[int] = []
        self.size = 0

    def add(self, lang: str, source: str, text: bytes) -> None:
        number = self.numbers.__getitem__
        pieces = [np.fromiter(map(number, t), dtype=np.int64, count=len(t)) for t in term_lists(text)]
        self.words.append(np.concatenate(pieces) if pieces else np.zeros(0, dtype=np.int64))
        self.group_of.append(self.groups[lang, source])
        self.size += len(self.words[-1])

    def run(self, shards: int) -> Iterator[pa.RecordBatch]:
        """For each language and shard its terms in order, with their documents and their occurrences by source.

        A row without terms lists the sources that occur in a language.
        """
        langs = {lang: i for i, lang in enumerate(dict.fromkeys(lang for lang, _ in self.groups))}
        names, sources = list(langs), [source for _, source in self.groups]
        lang_of = np.array([langs[lang] for lang, _ in self.groups])
        rows = [(name, 0, 0, *[None] * 5, [s for s, i in zip(sources, lang_of) if i == k]) for k, name in enumerate(names)]
        terms = list(self.numbers)
        if terms:
            v, words = len(terms), np.concatenate(self.words)
            text_of = np.repeat(np.arange(len(self.words)), [*map(len, self.words)])
            group_of = np.array(self.group_of)
            # Once for each text that has the term; once for each source that has it.
            each = np.unique(text_of * v + words)
            owners, docs = np.unique(lang_of[group_of[each // v]] * v + each % v, return_counts=True)
            postings, counts = np.unique(group_of[text_of] * v + words, return_counts=True)
            rank = np.empty(v, dtype=np.int64)
            rank[sorted(range(v), key=terms.__getitem__)] = np.arange(v)
            shard = np.fromiter((zlib.crc32(t) % shards for t in terms), dtype=np.int64, count=v)
            # Language, shard, term; then the sources of a term in the same order.
            lang, term = owners // v, owners % v
            order = np.lexsort((rank[term], shard[term], lang))
            lang, term, docs = lang[order], term[order], docs[order]
            group, of = postings // v, postings % v
            order = np.lexsort((group, rank[of], shard[of], lang_of[group]))
            group, counts = group[order], counts[order]
            key = (lang_of[group] * v + of[order])
            lengths = np.diff(np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]])))
            ends = np.concatenate([[0], np.cumsum(lengths)])
            cuts = np.flatnonzero(np.diff(lang * shards + shard[term])) + 1
            for first, end in itertools.pairwise([0, *cuts.tolist(), len(term)]):
                here = slice(ends[first], ends[end])
                used, places = np.unique(group[here], return_inverse=True)
                rows.append((
                    names[lang[first]], int(shard[term[first]]), end - first,
                    packed(np.zeros(0), b"\n".join([terms[i] for i in term[first:end]])), packed(docs[first:end]),
                    packed(lengths[first:end]), packed(places), packed(counts[here]), [sources[i] for i in used],
                ))
        for first in range(0, len(rows), 1000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows[first : first + 1000]), RUN)], schema=RUN
            )


def indexed_blocks(shards: int):
    """A function from the rows (lang, source, text) of a task to its runs."""

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block()
        for batch in batches:
            langs, sources = batch["lang"].to_pylist(), batch["source"].to_pylist()
            for lang, source, text in zip(langs, sources, batch["text"]):
                block.add(lang, source, text.as_py())
                if block.size >= BLOCK_WORDS:
                    yield from block.run(shards)
                    block = Block()
        if block.groups:
            yield from block.run(shards)

    return per_task


@dataclass
class Run:
    """A language's terms of one shard and block, sorted, and their postings one after the other."""

    terms: list[bytes]
    docs: np.ndarray
    lengths: np.ndarray
    places: np.ndarray
    counts: np.ndarray
    sources: list[str]


def merged_runs(least_documents: int):
    """A function that heap-merges the runs of shards, as many at a time as fit.

    A term may come again in the next merge of its task. Where one merge was enough its
    documents are all there, so terms of fewer than ``least_documents`` can go.
    """

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards: dict[tuple, list[Run]] = defaultdict(list)
        sources: dict[str, set] = defaultdict(set)
        held, whole = 0, True
        for batch in batches:
            for row in batch.to_pylist():
                if row["terms"] is None:
                    sources[row["lang"]].update(row["sources"])
                    continue
                run = Run(unpacked(row["terms"], 0)[1].split(b"\n"),
                          *(unpacked(row[c])[0].astype(np.int64) for c in ("docs", "lengths", "places", "counts")), row["sources"])
                shards[row["lang"], row["shard"]].append(run)
                held += len(run.terms) + len(run.counts)
                if held >= MERGE_POSTINGS:
                    for (lang, _), runs in shards.items():
                        yield merge(lang, runs, 0)
                    shards, held, whole = defaultdict(list), 0, False
        for (lang, _), runs in shards.items():
            yield merge(lang, runs, least_documents if whole else 0)
        for lang, names in sources.items():
            yield _postings(lang, [None], [0], np.array([0, len(names)]), list(names), np.zeros(len(names), np.int64))

    return per_task


def merge(lang: str, runs: list[Run], least_documents: int) -> pa.RecordBatch:
    """One row per term that has ``least_documents`` in the runs."""
    merged = heapq.merge(*(zip(run.terms, repeat(i), count()) for i, run in enumerate(runs)))
    terms, run_of, at = zip(*merged)
    first = np.cumsum([0, *(len(run.terms) for run in runs)])[:-1]
    rows = first[np.array(run_of)] + np.array(at)
    starts = np.array([i for i, t in enumerate(terms) if not i or t != terms[i - 1]])
    docs = np.add.reduceat(np.concatenate([run.docs for run in runs])[rows], starts)
    number = np.repeat(np.arange(len(starts)), np.diff([*starts, len(rows)]))
    names: dict[str, int] = defaultdict(count().__next__)
    places = np.concatenate([np.array([names[s] for s in run.sources], dtype=np.int64)[run.places] for run in runs])
    counts = np.concatenate([run.counts for run in runs])
    lengths = np.concatenate([run.lengths for run in runs])
    begins = (np.cumsum(lengths) - lengths)[rows]
    keep = docs[number] >= least_documents
    rows, begins, number = rows[keep], begins[keep], number[keep]
    each = lengths[rows]
    at = np.repeat(begins - (np.cumsum(each) - each), each) + np.arange(each.sum())
    key, inverse = np.unique(np.repeat(number, each) * len(names) + places[at], return_inverse=True)
    sums = np.zeros(len(key), dtype=np.int64)
    np.add.at(sums, inverse, counts[at])
    kept = np.flatnonzero(docs >= least_documents)
    offsets = np.searchsorted(key // len(names), [*kept, len(starts)])
    every = list(names)
    return _postings(lang, [terms[i] for i in starts[kept]], docs[kept], offsets, [every[i] for i in key % len(names)], sums)


def _postings(lang: str, terms: list, docs, offsets: np.ndarray, sources: list[str], counts: np.ndarray) -> pa.RecordBatch:
    cuts = pa.array(offsets.astype(np.int32))
    return pa.RecordBatch.from_arrays([
        pa.array([lang] * len(terms), pa.string()), pa.array(terms, pa.binary()), pa.array(docs, pa.int64()),
        pa.ListArray.from_arrays(cuts, pa.array(sources, pa.string())), pa.ListArray.from_arrays(cuts, pa.array(counts, pa.int64())),
    ], schema=POSTINGS)


def index(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
          least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """(lang, term, docs, sources, counts): postings in which a term may have several rows to add up.

    Rows without a term list the sources that occur in the language. Terms that can't
    reach ``least_documents`` may be missing.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shards = shuffle_partitions(spark)

    def filled(name: str) -> Column:
        return F.coalesce(docs[f"`{name}`"].cast("string"), F.lit(""))

    rows = docs.select(
        filled(lang).alias("lang"), filled(source).alias("source"), filled(text).cast("binary").alias("text")
    )
    runs = rows.mapInArrow(indexed_blocks(shards), RUN_DDL).repartition(shards, "lang", "shard")
    return pin(
        runs.mapInArrow(merged_runs(least_documents), POSTINGS_DDL).withColumn("term", F.col("term").cast("string")),
        "postings",
    )


def share(times: Column, n: Column, v: Column) -> Column:
    """1 + floor(1e9 * (times + 5) / (n + 5 v)), in whole numbers of up to 38 digits."""
    above = F.lit(UNIT).cast("decimal(10,0)") * (times + ADDED).cast("decimal(20,0)")
    return F.lit(1).cast("long") + F.call_function("div", above, (n + ADDED * v).cast("decimal(20,0)"))


@dataclass(frozen=True)
class Frequencies:
    """``kept`` (lang, term, docs, times), ``groups`` (lang, source, n, v, place, p of an absent term), ``counts`` of both with p."""

    kept: DataFrame
    groups: DataFrame
    counts: DataFrame


def frequencies(postings: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> Frequencies:
    """The counts of kept terms, exact: what the merges left apart is added up."""
    terms = postings.where("term IS NOT NULL")
    documents = terms.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= least_documents)
    each = F.arrays_zip(F.col("sources").alias("source"), F.col("counts").alias("times"))
    counts = pin(
        terms.join(documents.select("lang", "term"), ["lang", "term"])
        .select("lang", "term", F.explode(each).alias("each")).select("lang", "each.source", "term", "each.times")
        .groupBy("lang", "source", "term").agg(F.sum("times").alias("times")).where("times > 0"),
        "term-counts",
    )
    kept = documents.join(counts.groupBy("lang", "term").agg(F.sum("times").alias("times")), ["lang", "term"])
    whole = pin(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("times").alias("lang_n")), "languages")
    by_source = counts.groupBy("lang", "source").agg(F.sum("times").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = pin(
        postings.where("term IS NULL").select("lang", F.explode("sources").alias("source")).distinct()
        .join(by_source, ["lang", "source"], "left").join(whole, "lang", "left")
        .select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "v", "lang_n")])
        .withColumn("absent", F.when(F.col("v") > 0, share(F.lit(0), F.col("n"), F.col("v"))).otherwise(0))
        .withColumn("place", place),
        "groups",
    )
    shared = counts.join(groups, ["lang", "source"]).withColumn("p", share(F.col("times"), F.col("n"), F.col("v")))
    return Frequencies(kept, groups, pin(shared.select("lang", "source", "place", "term", "p", "lang_n", "v"), "shares"))


def telling_terms(found: Frequencies, ranks: int = TERM_RANKS) -> DataFrame:
    """(lang, source, item, value, rank): the terms whose share exceeds the language's by most."""
    whole = found.kept.select("lang", "term", F.col("times").alias("lang_times"))
    excess = F.col("p") - share(F.col("lang_times"), F.col("lang_n"), F.col("v"))
    above = found.counts.join(whole, ["lang", "term"]).select("lang", "source", F.col("term").alias("item"), excess.alias("value"))
    return _ranked(above.where("value > 0")).where(F.col("rank") <= ranks)


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order))


CORRECTION = "lang string, place int, other int, value long"


def corrections(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Streams rows (lang, i, j, part, term, side, at, p) in this order and yields what pairs differ by.

    Rows without a term, in front of a part's others, are the sources of the blocks i and j
    with the share of a term they lack. Only the term at the end of a batch is held back.
    """
    pairs, rest = None, None
    for batch in itertools.chain(batches, [None]):
        if batch is None:
            if rest is None:
                return
            batch, upto = rest, len(rest)
        else:
            batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            upto = None
        keys = batch[["lang", "i", "j", "part", "term"]].to_numpy(object)
        same = keys[1:] == keys[:-1]
        if upto is None:
            ends = np.flatnonzero(~same.all(axis=1))
            upto = int(ends[-1]) + 1 if len(ends) else 0
        rest = batch.iloc[upto:]
        starts = [0, *(np.flatnonzero(~same[:, :3].all(axis=1)) + 1), len(batch)]
        for first, end in itertools.pairwise(starts):
            if first >= min(end, upto):
                continue
            key = tuple(keys[first, :3])
            if pairs is None or pairs.key != key:
                if pairs is not None:
                    yield from pairs.result()
                pairs = _Pairs(key)
            pairs.add(batch.iloc[first : min(end, upto)])
    if pairs is not None:
        yield from pairs.result()


class _Pairs:
    """Sums over terms of |p - q| less what it is where both lack the term, for sources of two blocks."""

    def __init__(self, key):
        self.key = key
        self.sides = 1 if key[1] == key[2] else 2
        self.absent = [np.zeros(0, dtype=np.int64) for _ in range(self.sides)]
        self.total = None

    def add(self, rows: pd.DataFrame) -> None:
        heads = rows["term"].isna().to_numpy()
        side, at, p = (rows[c].to_numpy(np.int64) for c in ("side", "at", "p"))
        for s in range(self.sides):
            here = heads & (side == s)
            if here.any():
                size = max(len(self.absent[s]), int(at[here].max()) + 1)
                grown = np.zeros(size, dtype=np.int64)
                grown[: len(self.absent[s])] = self.absent[s]
                grown[at[here]] = p[here]
                self.absent[s] = grown
        if heads.all():
            return
        a, b = self.absent[0], self.absent[-1]
        if self.total is None:
            self.total = np.zeros((len(a), len(b)), dtype=np.int64)
        terms = rows["term"].to_numpy()[~heads]
        number = np.concatenate([[0], np.cumsum(terms[1:] != terms[:-1])]).astype(np.int64)
        side, at, p = side[~heads], at[~heads], p[~heads]
        # So many terms at a time that a table of them by sources stays small.
        for first in range(0, int(number[-1]) + 1, 2048):
            here = slice(*np.searchsorted(number, [first, first + 2048]))
            self._add(number[here] - first, side[here], at[here], p[here], a, b)

    def _add(self, term, side, at, p, a, b) -> None:
        n = int(term.max()) + 1
        tables, present = [], []
        for s, absent in enumerate(self.absent):
            here = side == s
            table, has = np.tile(absent, (n, 1)), np.zeros((n, len(absent)), dtype=bool)
            table[term[here], at[here]] = p[here]
            has[term[here], at[here]] = True
            tables.append(table)
            present.append(has)
        gap = np.abs(a[:, None] - b[None, :])
        for source in np.unique(at[side == 0]):
            # The source has the term; the other one has it or lacks it.
            has = present[0][:, source]
            self.total[source] += np.abs(tables[0][has, source, None] - tables[-1][has]).sum(axis=0) - has.sum() * gap[source]
        for source in np.unique(at[side == self.sides - 1]):
            # The other one has the term, this one lacks it.
            has = present[-1][:, source]
            lacks = ~present[0][has]
            more = np.abs(tables[-1][has, source, None] - a[None, :]) - gap[:, source][None, :]
            self.total[:, source] += np.where(lacks, more, 0).sum(axis=0)

    def result(self) -> Iterator[pd.DataFrame]:
        lang, i, j = self.key
        if self.total is None or not self.total.any():
            return
        here, there = np.nonzero(self.total)
        value = self.total[here, there]
        both = [here + i * SOURCES, there + j * SOURCES]
        if i != j:
            both, value = [np.concatenate([x, y]) for x, y in zip(both, both[::-1])], np.concatenate([value, value])
        yield pd.DataFrame({"lang": np.full(len(value), lang, object), "place": both[0], "other": both[1], "value": value})


def source_pairs(found: Frequencies) -> DataFrame:
    """(lang, source, item, value, rank) of every two sources of a language."""
    spark = found.groups.sparkSession
    block = F.floor(F.col("place") / SOURCES).cast("int")
    at = (F.col("place") % SOURCES).cast("int")
    blocks = found.groups.groupBy("lang").agg((F.floor(F.max("place") / SOURCES)).cast("int").alias("last"))

    def dealt(rows: DataFrame) -> DataFrame:
        """Rows to every block of pairs that theirs is a side of."""
        other = F.explode(F.sequence(F.lit(0), "last")).alias("other")
        return rows.join(blocks, "lang").select("*", other).select(
            "lang", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
            "part", "term", (F.col("block") > F.col("other")).cast("int").alias("side"), "at", "p",
        )

    part = F.pmod(F.xxhash64("term"), F.lit(PARTS)).cast("int")
    terms = found.counts.select("lang", block.alias("block"), part.alias("part"), "term", at.alias("at"), "p")
    heads = found.groups.where("v > 0").select(
        "lang", block.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"),
        F.lit(None).cast("string").alias("term"), at.alias("at"), F.col("absent").alias("p"),
    )
    order = ["lang", "i", "j", "part"]
    stream = dealt(terms.union(heads)).repartition(shuffle_partitions(spark), *order).sortWithinPartitions(*order, "term")
    corrected = stream.mapInPandas(corrections, CORRECTION)
    # Blocks of bounded lists, so that no language's pairs come from one row.
    lists = found.groups.groupBy("lang", block.alias("block"), "v").agg(
        F.collect_list(F.struct("place", "source", "absent")).alias("sources")
    )
    crossed = lists.alias("a").join(lists.alias("b"), F.col("a.lang") == F.col("b.lang")).select(
        "a.lang", "a.v", F.col("a.sources").alias("here"), F.col("b.sources").alias("there")
    )
    plain = (
        crossed.select("lang", "v", F.explode("here").alias("here"), "there")
        .select("lang", "v", "here", F.explode("there").alias("there")).where("here.place <> there.place")
        .select(
            "lang", F.col("here.place").alias("place"), F.col("there.place").alias("other"),
            (F.col("v") * F.abs(F.col("here.absent") - F.col("there.absent"))).alias("value"),
            "here.source", F.col("there.source").alias("item"),
        )
    )
    unnamed = corrected.where("place <> other").withColumn("source", F.lit(None).cast("string")).withColumn("item", F.lit(None).cast("string"))
    both = plain.unionByName(unnamed).groupBy("lang", "place", "other").agg(
        F.max("source").alias("source"), F.max("item").alias("item"), F.sum("value").alias("value")
    )
    return _ranked(both.select("lang", "source", "item", "value"))


def divergence(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
               least_documents: int = LEAST_DOCUMENTS, ranks: int = TERM_RANKS) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value and rank."""
    found = frequencies(index(docs, text, lang, source, least_documents), least_documents)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pairs = source_pairs(found).withColumn("part", F.lit("pair"))
    return pairs.select(*columns).union(telling_terms(found, ranks).withColumn("part", F.lit("term")).select(*columns))
