"""Benchmark decontamination: a prefix-filtered join of windows with documents.

Items are cut into windows of ten words (shorter items are one window). A window
occurs in a document only if all its shingles do, so its rarest one is a sufficient
prefix: shingles of the benchmark are counted over all documents, and each window is
joined by its rarest shingle alone. Documents are scanned twice, once to count and
once to report where a prefix shingle stands, with the words around it. The join with
the windows bounds the window's place (it must begin at or after the first word and
end at or before the last one) and compares the words exactly.

Scans keep only shingles that pass a bitmap of fixed size; it lets some strangers
through, whom the join drops, and misses none. Results belong to texts, not rows, so
copies of a text meet the join once.

Defined results: a NULL, empty or wordless text has no words and is clean; items
without words have no windows; an item without an id marks words but is not listed;
repeated rows get equal results; items that repeat an id count once; empty tables
give no rows, or clean ones; other columns never matter.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comarca.llm.frames import bounded_batches, free_names
from comarca.sinks.pinned import pin

WINDOW = 10
SHINGLE = 3
SLICE_BYTES = 1 << 20
# Places of a map for each hash, as a power of two, and the least and most places of a map.
PLACES_PER_HASH = 9
LEAST_BITS, MOST_BITS = 16, 27

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2^64."""
    up, down = np.full(n, _BASE), np.full(n, _BASE_INVERSE)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * _MIX
    values = (values ^ (values >> np.uint64(32))) * _MIX
    return values ^ (values >> np.uint64(32))


def split_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and 64-bit hashes of the words of lower-cased bytes, some megabytes at a time."""
    starts, ends, hashes, at = [], [], [], 0
    while at < len(data):
        upto = min(len(data), at + SLICE_BYTES)
        if upto < len(data):
            # Ends between words; a word longer than a slice makes the slice longer.
            cut = np.flatnonzero(~_IN_WORD[data[at:upto]])
            while not len(cut) and upto < len(data):
                more = data[upto : upto + SLICE_BYTES]
                cut = np.flatnonzero(~_IN_WORD[more]) + (upto - at)
                upto += len(more)
            upto = at + int(cut[-1]) + 1 if len(cut) else len(data)
        part = data[at:upto]
        edge = np.diff(np.concatenate([[False], _IN_WORD[part], [False]]).view(np.int8))
        s, e = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        size = 1 << max(SLICE_BYTES.bit_length() - 1, int(len(part)).bit_length())
        up, down = _powers(size)
        total = np.concatenate([[np.uint64(0)], np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[: len(part)])])
        hashes.append(mixed((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64)))
        starts.append(s + at)
        ends.append(e + at)
        at = upto
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(starts), np.concatenate(ends), np.concatenate(hashes)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of ``size`` consecutive words."""
    n = max(0, len(words) - size + 1)
    total = np.full(n, np.uint64(size))
    for i in range(size):
        total = mixed(total + words[i : i + n])
    return total


class Texts:
    """The words of many texts at once."""

    def __init__(self, texts):
        encoded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        self.data = _LOWER[np.frombuffer(b"\n".join(encoded), dtype=np.uint8)]
        self.starts, self.ends, self.hashes = split_words(self.data)
        begins = np.cumsum([0, *(len(e) + 1 for e in encoded)])[:-1]
        self.first = np.searchsorted(self.starts, begins)
        self.upto = np.append(self.first[1:], len(self.starts))
        self.text_of = np.repeat(np.arange(len(encoded)), self.upto - self.first)

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all shingles that lie in one text, and the word each begins with."""
        found = shingle_hashes(self.hashes, size)
        whole = self.text_of[: len(found)] == self.text_of[size - 1 :][: len(found)]
        at = np.flatnonzero(whole)
        return found[at], at

    def words(self, first: int, upto: int) -> list[str]:
        return [self.data[a:b].tobytes().decode("utf-8", "surrogatepass")
                for a, b in zip(self.starts[first:upto], self.ends[first:upto])]


def batches_of(batches, column: str):
    """Parts of the batches that hold a few megabytes of text each, or one text."""
    for batch in batches:
        sizes = batch[column].str.len().fillna(0).to_numpy()
        group = (np.cumsum(sizes) // SLICE_BYTES).astype(np.int64)
        for _, part in batch.groupby(group, sort=True):
            yield part


def bitmap(hashes: DataFrame) -> np.ndarray:
    """Two marks per hash on a map that has 2^``PLACES_PER_HASH`` places for each.

    So hardly a foreign hash passes, whatever the benchmark's size; a map has 128 MB at most,
    where of eight million hashes on one foreign hash in sixty passes and is joined exactly.
    """
    bits = min(MOST_BITS, max(LEAST_BITS, int(np.ceil(np.log2(max(1, hashes.count())))) + PLACES_PER_HASH))
    places = F.explode(F.array(*[F.shiftrightunsigned("hash", s).bitwiseAND(F.lit((1 << bits) - 1)) for s in (0, 32)])).alias("place")
    # The marks of each run of places, so that a cell holds many of them.
    runs = hashes.select(places).distinct().groupBy(F.shiftright("place", LEAST_BITS).alias("run")).agg(
        F.collect_list(F.col("place").bitwiseAND(F.lit((1 << LEAST_BITS) - 1)).cast("int")).alias("at")
    )
    marked = np.zeros(1 << bits, dtype=bool)
    for row in runs.collect():
        marked[(row["run"] << LEAST_BITS) + np.array(row["at"], dtype=np.int64)] = True
    return marked


def passes(marked: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Indices of the hashes whose two places are marked."""
    mask = np.uint64(len(marked) - 1)
    at = np.flatnonzero(marked[(hashes & mask).astype(np.int64)])
    return at[marked[((hashes[at] >> np.uint64(32)) & mask).astype(np.int64)]]


def item_windows(items: DataFrame, item_id: str, text: str, window: int, shingle: int) -> DataFrame:
    """(words, shingles: [(size, offset, hash)], items) per distinct window."""
    def cut(batches):
        for batch in batches:
            rows = []
            for own, value in zip(batch["item"], batch["text"]):
                texts = Texts([value])
                n = len(texts.hashes)
                words = texts.words(0, n)
                length, size = min(window, n), min(shingle, window, n)
                hashes = shingle_hashes(texts.hashes, size).view(np.int64) if n else []
                for first in range(n - length + 1 if n else 0):
                    rows.append((own, " ".join(words[first : first + length]), length, size,
                                 hashes[first : first + length - size + 1].tolist()))
            yield pd.DataFrame(rows, columns=["item", "window", "length", "size", "hashes"])

    rows = items.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text"))
    found = rows.mapInPandas(cut, "item string, window string, length int, size int, hashes array<long>")
    return found.groupBy("window", "length").agg(
        F.first("size").alias("size"), F.first("hashes").alias("hashes"),
        F.collect_set("item").alias("items"),
    )


def find_windows(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
                 item_text: str = "text", window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """What each distinct contaminated text holds: (text_key, starts, n_hit, items).

    ``text_key`` is ``text_key_of`` the text; ``starts`` holds the [start, end) words of
    every occurrence, ``n_hit`` counts the words inside any, ``items`` are sorted.
    """
    bounded_batches(docs.sparkSession)
    windows = pin(item_windows(items, item_id, item_text, window, shingle), "windows")
    hashes = windows.select("size", F.explode("hashes").alias("hash")).distinct()
    sizes = sorted(r[0] for r in hashes.select("size").distinct().collect())
    context = docs.sparkSession.sparkContext
    every = context.broadcast(bitmap(hashes))

    def count(batches):
        held = []
        for part in batches_of(batches, "text"):
            texts = Texts(part["text"])
            for size in sizes:
                found, _ = texts.shingles(size)
                held.append(np.unique(found[passes(every.value, found)], return_counts=True))
            if sum(len(h) for h, _ in held) > 1 << 20:
                yield summed(held)
                held = []
        yield summed(held)

    def summed(held):
        if not held:
            return pd.DataFrame({"hash": np.zeros(0, np.int64), "n": np.zeros(0, np.int64)})
        found, at = np.unique(np.concatenate([h for h, _ in held]), return_inverse=True)
        counts = np.bincount(at, weights=np.concatenate([c for _, c in held]), minlength=len(found))
        return pd.DataFrame({"hash": found.view(np.int64), "n": counts.astype(np.int64)})

    counts = pin(
        docs.select(F.col(text).alias("text")).where("text IS NOT NULL").mapInPandas(count, "hash long, n long")
        .groupBy("hash").agg(F.sum("n").alias("n")),
        "shingle-counts",
    )
    ordered = windows.select("window", "length", "size", "items", F.posexplode("hashes").alias("offset", "hash")).join(
        counts, "hash", "left"
    )
    # The necessary prefix: the rarest shingle of a window.
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "hash", "offset")).alias("rarest")
    prefixes = pin(
        ordered.groupBy("window", "length").agg(rarest, F.first("size").alias("size"), F.first("items").alias("items"))
        .where("rarest.n > 0")
        .select("rarest.hash", "size", "rarest.offset", "window", "length", "items"),
        "prefixes",
    )
    wanted = context.broadcast(bitmap(prefixes.select("hash").distinct()))

    def locate(batches):
        for part in batches_of(batches, "text"):
            texts = Texts(part["text"])
            keys = part["text_key"].to_numpy()
            rows = []
            for size in sizes:
                found, at = texts.shingles(size)
                for i in passes(wanted.value, found):
                    word = int(at[i])
                    own = int(texts.text_of[word])
                    first, upto = int(texts.first[own]), int(texts.upto[own])
                    low, high = max(first, word - window), min(upto, word + window)
                    rows.append((keys[own], size, int(found[i].view(np.int64)), word - first, low - first,
                                 upto - first, texts.words(low, high)))
            yield pd.DataFrame(rows, columns=["text_key", "size", "hash", "at", "low", "n_words", "around"])

    keyed = docs.select(F.col(text).alias("text"), text_key_of(F.col(text)).alias("text_key")).where("text IS NOT NULL")
    candidates = keyed.mapInPandas(
        locate, "text_key string, size int, hash long, at int, low int, n_words int, around array<string>"
    ).dropDuplicates(["text_key", "size", "hash", "at"])
    joined = candidates.join(
        prefixes.select(F.col("hash").alias("h"), F.col("size").alias("s"), "offset", "window", "length", "items"),
        (F.col("hash") == F.col("h")) & (F.col("size") == F.col("s")),
    ).withColumn("start", F.col("at") - F.col("offset"))
    bounded = joined.where((F.col("start") >= 0) & (F.col("start") + F.col("length") <= F.col("n_words")))
    here = F.array_join(F.slice("around", F.col("start") - F.col("low") + 1, F.col("length")), " ")
    hits = bounded.where(here == F.col("window"))
    words = F.flatten(F.collect_list(F.sequence("start", F.col("start") + F.col("length") - 1)))
    return hits.groupBy("text_key").agg(
        F.size(F.array_distinct(words)).cast("long").alias("n_hit"),
        F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("length")).alias("end")))).alias("starts"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )


def text_key_of(text):
    """Names a text; NULL for NULL."""
    return F.md5(text.cast("binary"))


def word_total(text):
    """Words as the windows count them."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")), F.lit(0)).cast("long")


def contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """(doc_id, n_words, n_hit, items: sorted ids as text, starts) of every row."""
    # Written first, so that the join with the rows can split a text with many copies.
    found = pin(find_windows(docs, items, text, **settings), "hit-texts")
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), word_total(F.col(text)).alias("n_words"), text_key_of(F.col(text)).alias("own_key")
    )
    none = F.array().cast("array<string>")
    return rows.join(found, F.col("own_key") == F.col("text_key"), "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", none).alias("items"), "starts",
    )


def clean_rows(docs: DataFrame, items: DataFrame, text: str = "text", **settings) -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no window of an item."""
    (key,) = free_names(docs, "hit_key")
    found = pin(find_windows(docs, items, text, **settings).select(F.col("text_key").alias(key)), "hit-texts")
    return docs.join(found, text_key_of(docs[f"`{text}`"]) == F.col(key), "left_anti")
