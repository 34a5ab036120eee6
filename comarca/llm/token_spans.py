"""Token counts per section: documents encoded once, token spans joined to section spans.

A document is encoded whole by a byte-level vocabulary, so tokens tile its UTF-8
bytes: their offsets are running sums of token lengths. Token spans are then
interval-joined to the document's sections, which may nest, overlap or leave gaps,
and a token that crosses a section's edge is dealt out by one of these rules:

* ``first``: it counts where its first byte lies (the default);
* ``last``: it counts where its last byte lies;
* ``share``: each section gets the share of the token's bytes that it holds.

Under ``first`` and ``last`` disjoint sections that cover a text add up to the
text's tokens exactly; under ``share`` up to rounding.

A run of white space of any length is one piece of the pattern but for its last
character, which goes with what follows; runs of ``LONG_RUN`` and more are taken out as
such pieces before the pattern is tried, whose search would use up its stack on them.

Defined results: a NULL or empty text has no tokens and one empty section 0; a
text that ends in a line break has an empty last section; repeated rows are
counted each; an empty table gives no rows; other columns never matter.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comarca.llm.frames import bounded_batches

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# How the vocabulary's authors cut text before merging; a fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
RULES = ("first", "last", "share")
LONG_RUN = 4000
# The pattern's white space: what Unicode gives the property White_Space; a fixed value.
SPACE = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def encoder(vocabulary: bytes, pattern: str = PATTERN) -> Callable[[str], list[int]]:
    """A function from a text to its tokens; ``vocabulary`` holds the lines of a file of ranks."""
    import tiktoken

    ranks = ranks_of(vocabulary)
    by_pattern, whole = (
        tiktoken.Encoding("given", pat_str=p, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        for p in (pattern, r"(?s).+")
    )
    long_run = re.compile(f"{SPACE}{{{LONG_RUN},}}")

    def encode(text: str) -> list[int]:
        tokens, at = [], 0
        for run in long_run.finditer(text):
            # At the end of the text the last character is part of the piece too.
            upto = run.end() - (run.end() < len(text))
            tokens += by_pattern(text[at : run.start()])
            tokens += whole(text[run.start() : upto])
            at = upto
        return tokens + by_pattern(text[at:]) if at else by_pattern(text)

    return encode


def ranks_of(vocabulary: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}


def ends_of_tokens(vocabulary: bytes, pattern: str = PATTERN) -> Callable[[str], np.ndarray]:
    """A function from a text to where each of its tokens ends, in UTF-8 bytes."""
    ranks, encode = ranks_of(vocabulary), encoder(vocabulary, pattern)
    lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
    lengths[list(ranks.values())] = list(map(len, ranks))
    return lambda text: np.cumsum(lengths[encode(text)])


def attribute(ends: np.ndarray, sections: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each [start, end) section under the rule, and how many tokens cross its edges."""
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    low, high = sections[:, 0], sections[:, 1]
    begin_in = np.searchsorted(starts, high) - np.searchsorted(starts, low)
    end_in = np.searchsorted(ends, high, side="right") - np.searchsorted(ends, low, side="right")
    # Tokens that begin before an edge and end behind it.
    crosses = [np.searchsorted(starts, edge) - np.searchsorted(ends, edge, side="right") for edge in (low, high)]
    edges = np.where(high > low, np.minimum(1, crosses[0]) + np.minimum(1, crosses[1]), 0)
    both = (high > low) & (crosses[0] > 0) & (crosses[1] > 0)
    same = both & (np.searchsorted(ends, low, side="right") == np.searchsorted(ends, high, side="right"))
    edges = edges - same
    if rule == "first":
        return begin_in.astype(float), edges
    if rule == "last":
        return np.where(high > low, end_in, 0).astype(float), edges

    def upto(position):
        """Tokens before a position, the one that holds it in part."""
        whole = np.searchsorted(ends, position, side="right")
        inside = whole < len(ends)
        at = np.minimum(whole, max(0, len(ends) - 1))
        if not len(ends):
            return np.zeros(len(position))
        return whole + np.where(inside, (position - starts[at]) / (ends[at] - starts[at]), 0.0)

    return upto(high) - upto(low), edges


def line_sections(text: str) -> np.ndarray:
    """[start, end) of every line in UTF-8 bytes, line breaks with the line they end."""
    data = text.encode("utf-8", "surrogatepass")
    cuts = [0, *(m.end() for m in re.finditer(b"\n", data)), len(data)]
    return np.array(list(zip(cuts[:-1], cuts[1:])), dtype=np.int64)


def count_tokens(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rule: str = "first",
                 sections: str | None = None, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """A row per section: doc_id, section, start, end (UTF-8 bytes), tokens, crossing, document_tokens.

    ``sections`` names an array<struct<start, end>> column of byte spans; without it
    every line is a section. Spans that are NULL, reversed or beyond the text are
    clipped to it. Each document is encoded once, in the task that reads it.
    """
    if rule not in RULES:
        raise ValueError(f"rule {rule!r} is none of {RULES}")
    bounded_batches(docs.sparkSession)
    # The file's bytes go to the tasks, which may not reach the file.
    shared = docs.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
        (F.col(sections) if sections else F.lit(None).cast("array<struct<start:long,end:long>>")).alias("spans"),
    )
    schema = T.StructType([
        rows.schema["doc_id"], *[T.StructField(c, T.LongType()) for c in ("section", "start", "end")],
        T.StructField("tokens", T.DoubleType()), *[T.StructField(c, T.LongType()) for c in ("crossing", "document_tokens")],
    ])

    def sections_of(value, spans, length):
        if spans is None:
            return line_sections(value)
        given = [(s["start"] or 0, s["end"] if s["end"] is not None else length) for s in spans if s is not None]
        clipped = np.clip(np.array(given, dtype=np.int64).reshape(-1, 2), 0, length)
        clipped[:, 1] = np.maximum(clipped[:, 0], clipped[:, 1])
        return clipped

    def per_batch(batches):
        token_ends = ends_of_tokens(shared.value, pattern)
        for batch in batches:
            # Some documents at a time, so that what is returned stays small too.
            for first in range(0, len(batch), 256):
                yield counted(batch.slice(first, 256), token_ends)

    def counted(batch: pa.RecordBatch, token_ends) -> pa.RecordBatch:
        at, numbers, parts = [], [], []
        for i, (value, spans) in enumerate(zip(batch["text"].to_pylist(), batch["spans"].to_pylist())):
            value = value or ""
            ends = token_ends(value)
            where = sections_of(value, spans, int(ends[-1]) if len(ends) else 0)
            tokens, crossing = attribute(ends, where, rule)
            at.append(np.full(len(where), i))
            numbers.append(np.arange(len(where)))
            parts.append(np.column_stack([where, tokens, crossing, np.full(len(where), len(ends))]))
        table = np.concatenate(parts)
        # Ids stay in Arrow: a NULL beside them would make doubles of long numbers.
        ids = batch["doc_id"].take(pa.array(np.concatenate(at)))
        start, end, tokens, crossing, every = table.T
        columns = [np.concatenate(numbers), *(x.astype(np.int64) for x in (start, end)), tokens,
                   *(x.astype(np.int64) for x in (crossing, every))]
        return pa.RecordBatch.from_arrays([ids, *map(pa.array, columns)], names=schema.names)

    return rows.mapInArrow(per_batch, schema)
