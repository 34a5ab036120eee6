"""Source divergence against plain counting; blocks, merges and sides of any size."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from comarca.llm import source_divergence as divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, ranks=50):
    """(lang, source, part, item, value, rank) by definition."""
    documents, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        terms = TERM.findall((text or "").translate(LOWER))
        groups[lang or ""].add(source or "")
        documents[lang or ""].update(set(terms))
        counts[lang or "", source or ""].update(terms)
    found = set()
    for lang, sources in groups.items():
        kept = {t for t, n in documents[lang].items() if n >= least}
        whole = Counter()
        for s in sources:
            whole.update({t: n for t, n in counts[lang, s].items() if t in kept})

        def share(of, total):
            return {t: 1 + 10**9 * (of[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p = {s: share(counts[lang, s], sum(counts[lang, s][t] for t in kept)) for s in sources}
        q = share(whole, sum(whole.values()))
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, ranks)):
                for i, (value, item) in enumerate(sorted(items, key=lambda x: (-x[0], x[1].encode()))[:most]):
                    found.add((lang, s, part, item, value, i + 1))
    return found


def rows_of(seed, n=600):
    rng = random.Random(seed)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)] + ["ÉCOLE", "École", "日本", "a_b", "x1y", "ſ", "K"]
    rows = []
    for _ in range(n):
        lang, source = rng.choice(["en", "en", "de", None, ""]), rng.choice(["hot", "hot", "a", "b", "B", "c", "é", None])
        text = " ".join(rng.choices(words[:: rng.randint(1, 5)], k=rng.randint(0, 30)))
        rows.append((rng.choice([text, text, text.upper(), "12 --", "", None]), lang, source))
    return rows + [("one of its own kind", "fr", "x")] * 3 + [("the same text again", "en", "hot")] * 200 + [(None, "la", s) for s in "xyz"]


def result(spark, rows, **options):
    docs = spark.createDataFrame(
        [(i, *r, "t", 1) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string, term string, n long"
    )
    got = divergence.divergence(docs.repartition(5), **options)
    assert got.dtypes == [(c, "string") for c in ("lang", "source", "part", "item")] + [("value", "bigint"), ("rank", "int")]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_equals_counting(spark):
    rows = rows_of(1)
    assert result(spark, rows) == plain(rows, 30)
    assert result(spark, rows, least_documents=2, ranks=3) == plain(rows, 2, 3)


def test_small_blocks_merges_and_sides(spark, monkeypatch):
    """Documents that go over the end of a block, many merges of a shard and many blocks of sources."""
    rows = rows_of(2, 300) + [(" ".join(f"long{chr(97 + i % 26)}" for i in range(4000)), "en", "a")] * 3
    want = plain(rows, 3)
    monkeypatch.setattr(divergence, "BLOCK_WORDS", 150)
    monkeypatch.setattr(divergence, "MERGE_POSTINGS", 60)
    monkeypatch.setattr(divergence, "PIECE", 64)
    monkeypatch.setattr(divergence, "SOURCES", 3)
    monkeypatch.setattr(divergence, "PARTS", 3)
    assert result(spark, rows, least_documents=3) == want


def test_nothing_kept_and_nothing_there(spark):
    assert result(spark, []) == set()
    rows = [("a b", "en", "x"), ("a", "en", "y"), (None, None, None)]
    assert result(spark, rows) == {("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)}


def test_a_block_has_one_row_per_term(spark):
    docs = spark.createDataFrame([("hot hot hot", "en", "s")] * 5000, "text string, lang string, source string").repartition(4)
    rows = docs.withColumn("text", docs["text"].cast("binary")).select("lang", "source", "text")
    runs = rows.mapInArrow(divergence.indexed_blocks(8), divergence.RUN_DDL).where("terms IS NOT NULL").collect()
    assert [(r.lang, r.n, r.sources) for r in runs] == [("en", 1, ["s"])] * 4
    merged = divergence.index(docs).where("term IS NOT NULL").collect()
    assert [(r.term, r.docs, r.sources, r.counts) for r in merged] == [("hot", 5000, ["s"], [15_000])]
    assert divergence.index(docs, least_documents=5001).where("term IS NOT NULL").count() == 0


def test_pieces_of_a_text_are_cut_between_terms(monkeypatch):
    text = ("wörd ÉÉ x" * 500 + "abc" * 300).encode()
    whole = [t for terms in divergence.term_lists(text) for t in terms]
    monkeypatch.setattr(divergence, "PIECE", 7)
    assert [t for terms in divergence.term_lists(text) for t in terms] == whole
    assert [t.decode() for t in whole] == TERM.findall(text.decode().translate(LOWER))


@pytest.mark.parametrize("times", [0, 7, 10**13])
def test_shares_are_exact(spark, times):
    n, v = 3 * 10**13 + 1, 10**7 + 3
    row = spark.range(1).selectExpr(f"{times}L AS t", f"{n}L AS n", f"{v}L AS v")
    got = row.select(divergence.share(row["t"], row["n"], row["v"])).first()[0]
    assert got == 1 + 10**9 * (times + 5) // (n + 5 * v)


def test_batches_may_end_anywhere():
    import pandas as pd

    rows = [("en", 0, 0, part, None, 0, at, 5) for part in range(2) for at in range(3)]
    rows += [("en", 0, 0, part, f"t{part}{k}", 0, at, 5 + k + at) for part in range(2) for k in range(4) for at in range(k % 3 + 1)]
    rows.sort(key=lambda r: (r[3], r[4] or ""))
    frame = pd.DataFrame(rows, columns=["lang", "i", "j", "part", "term", "side", "at", "p"])
    whole = pd.concat(divergence.corrections(iter([frame])))
    for size in (1, 2, 5):
        cut = pd.concat(divergence.corrections(frame.iloc[i : i + size] for i in range(0, len(frame), size)))
        assert np.array_equal(cut.to_numpy(), whole.to_numpy())
    assert len(whole)
