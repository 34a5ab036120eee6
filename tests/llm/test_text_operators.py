"""Language, quality, toxicity, fingerprints, windows, tokens: small cases, ties, nulls, empty tables."""

import math
import random
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F

from comarca.llm import compression, decontamination, langid, quality_zstd, simhash_trie, token_spans, toxicity_zstd
from comarca.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, lang_pred string, bits long"


def docs_of(spark, texts, langs=None):
    rows = [(i, t, langs[i] if langs else None, None, None, 0.5, "x", 7) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def words(rng, letters, n):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(3, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def two_languages():
    rng = random.Random(1)
    texts = [words(rng, "abcde" if i % 2 else "vwxyz", 40) for i in range(60)]
    return texts, ["low" if i % 2 else "high" for i in range(60)]


def test_language_of_known_and_unseen_words(spark, two_languages):
    texts, langs = two_languages
    odd = [None, "", "12 !! 34", "ABCDE edcba", "zzyyxx vvwwzz", "x" * 200_000, "漢字"]
    docs = docs_of(spark, texts + odd, langs + [None] * len(odd))
    model = langid.fit(docs)
    got = [r.p for r in docs.select(langid.predicted(docs, model, docs.text).alias("p")).collect()]
    assert [p.lang_pred for p in got[:60]] == langs
    assert [(p.lang_pred, p.score) for p in got[60:63]] == [("und", 0.0)] * 3
    assert [p.lang_pred for p in got[63:66]] == ["low", "high", "high"]
    assert got[66].lang_pred == "high" and got[66].score == pytest.approx(0.5)
    assert all(0 <= p.score <= 1 for p in got)


def test_language_with_nothing_to_learn(spark):
    docs = docs_of(spark, ["some text", None])
    model = langid.fit(docs)
    assert [r.p.lang_pred for r in docs.select(langid.predicted(docs, model, docs.text).alias("p")).collect()] == ["und"] * 2
    assert langid.fit(docs.where("false")).languages == []


def test_backoff_takes_the_longest_known_grams():
    counts = [(3, "<ab", 0, 5), (3, "<ab", 1, 1), (2, "ab", 0, 2), (2, "ab", 1, 2), (1, "b", 0, 1), (1, "b", 1, 9)]
    counts = pd.DataFrame(counts, columns=["level", "gram", "of", "times"])
    model = langid.model_of(["a", "b"], counts, {(n, k): 10 for n in range(6) for k in range(2)})
    assert [model.backoff(w) for w in ("abq", "qab", "qqb", "qq")] == [(3, [2]), (2, [1]), (1, [0]), (1, [])]
    assert model.predict("abq")[0] == "a" and model.predict("qqb")[0] == "b" and model.predict("qq") == ("a", 0.5)


class PlainLanguages:
    """By definition: dicts of counts, a logarithm per word and language."""

    def __init__(self, texts, langs):
        self.names = sorted(set(langs))
        tables = {(n, name): Counter() for n in range(6) for name in self.names}
        for text, name in zip(texts, langs):
            tables[0, name].update(langid.words_of(text))
        often = sum((tables[0, name] for name in self.names), Counter())
        for name in self.names:
            for word, times in tables[0, name].items():
                for n in range(1, 6) if often[word] >= langid.LEAST_COUNT else ():
                    for gram in langid.grams_of(word, n):
                        tables[n, name][gram] += times
        self.known = [set().union(*(tables[n, name] for name in self.names)) for n in range(6)]
        self.known[0] = {w for w in self.known[0] if often[w] >= langid.LEAST_COUNT}
        self.tables = tables
        self.whole = {k: sum(t for g, t in v.items() if g in self.known[k[0]]) for k, v in tables.items()}

    def log(self, n, gram, name):
        whole = self.whole[n, name] + langid.SMOOTHING * len(self.known[n])
        return math.log((self.tables[n, name][gram] + langid.SMOOTHING) / whole)

    def word(self, word, name):
        if word in self.known[0]:
            return self.log(0, word, name)
        for n in range(5, 0, -1):
            found = [g for g in langid.grams_of(word, n) if g in self.known[n]]
            if found:
                return sum(self.log(n, g, name) for g in found) / len(found)
        return 0.0

    def predict(self, text):
        words = langid.words_of(text)
        if not words:
            return "und", 0.0
        mean = [sum(self.word(w, name) for w in words) / len(words) for name in self.names]
        weights = [math.exp((m - max(mean)) * min(len(words), langid.SURE_WORDS)) for m in mean]
        best = weights.index(max(weights))
        return self.names[best], weights[best] / sum(weights)


def test_predictions_are_those_of_plain_counting(spark):
    rng = random.Random(9)
    letters = {"one": "abcdeü", "two": "cdefgh", "three": "aeiou" + "xyz"}
    langs = [rng.choice(["one", "one", "two", "three"]) for _ in range(90)]
    texts = [words(rng, letters[name], rng.randint(0, 30)) + rng.choice(["", " shared words", " 12 Ab?"]) for name in langs]
    plain = PlainLanguages(texts, langs)
    odd = ["abc def xyz shared", "qqqq", "ü", "Shared WORDS", "", "17"] + [words(rng, "abcdefghxyzq", 9) for _ in range(60)]
    docs = docs_of(spark, texts + odd, langs + [None] * len(odd)).repartition(4)
    model = langid.fit(docs)
    assert model.languages == plain.names
    for row in docs.select("text", langid.predicted(docs, model, docs.text).alias("p")).collect():
        name, score = plain.predict(row.text)
        assert row.p.lang_pred == name and row.p.score == pytest.approx(score, rel=1e-4)


def test_every_language_is_learned(spark):
    rng = random.Random(8)
    names = [f"l{i:03}" for i in range(203)]
    own = {name: ["".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(4)] for name in names}
    texts = [" ".join(own[name] * 2) for name in names for _ in range(2)]
    docs = docs_of(spark, texts, [name for name in names for _ in range(2)])
    model = langid.fit(docs)
    assert model.languages == names
    got = docs.select("lang", langid.predicted(docs, model, docs.text).alias("p")).collect()
    assert all(r.lang == r.p.lang_pred for r in got)
    few = langid.fit(docs, words_per_language=1, grams_per_language=2)
    assert len(few.words) == 203 and few.languages == names


@pytest.mark.parametrize("operator, label", [(quality_zstd, "quality"), (toxicity_zstd, "toxic")])
def test_compression_classifiers_tell_held_out_texts(spark, operator, label):
    rng = random.Random(3)
    plain = ["".join(rng.choice(["or", "an", "ti", "es", "un"]) for _ in range(rng.randint(1, 4))) for _ in range(400)]
    bad = ["grimbolt", "snarkwad", "fuzzlepot"]
    texts, labels = [], []
    for i in range(400):
        text = [rng.choice(plain) for _ in range(60)]
        if i % 2:
            for _ in range(8):
                text.insert(rng.randrange(len(text)), rng.choice(bad))
        texts.append(" ".join(text))
        labels.append((i, i % 2))
    texts += [None, "", "a", "snarkwad " * 20_000]
    docs = docs_of(spark, texts)
    given = spark.createDataFrame(
        [r for r in labels if r[0] % 5] + [(401, None), (2, 1), (2, 1), (None, 1), (900, 1)], f"doc_id long, {label} int"
    )
    model = operator.fit(docs, given)
    got = [r.s for r in docs.select(model.scores(docs, docs.text).alias("s")).collect()]
    held = [(s >= 0.5) == bool(i % 2) for i, s in enumerate(got[:400]) if i % 5 == 0]
    assert sum(held) >= 0.95 * len(held)
    assert all(0 <= s <= 1 for s in got) and got[400] == got[401] and got[403] > 0.5


def test_samples_are_bounded_by_rows(spark):
    """A third of all rows, or all of them, with one labelled id; ids that repeat with several texts."""
    hot = [(7, f"hot text {i}") for i in range(4000)] + [(100 + i, f"text {i}") for i in range(8000)]
    docs = spark.createDataFrame(hot, "doc_id long, text string").repartition(6)
    given = spark.createDataFrame([(7, 1)] + [(100 + i, i % 2) for i in range(8000)], "doc_id long, quality int")
    for rows in (docs, docs.where("doc_id = 7")):
        sample = compression.labelled_sample(rows, given, "quality", "doc_id", "text", 500)
        sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
        assert all(400 <= n <= 600 for n in sizes.values()) and 1 in sizes
        share = sample.where("label = 1").agg(F.avg((F.col("key") == 7).cast("int")), F.sum("weight")).first()
        want = rows.join(given, "doc_id").where("quality = 1").agg(F.avg((F.col("doc_id") == 7).cast("int")), F.count("*")).first()
        assert abs(share[0] - want[0]) < 0.1 and share[1] == pytest.approx(want[1], rel=0.15)
    assert compression.labelled_sample(docs, given.where("false"), "quality", "doc_id", "text", 500).count() == 0


@pytest.mark.parametrize("settings", [quality_zstd.SETTINGS, toxicity_zstd.SETTINGS])
def test_features_are_those_of_plain_windows_and_sizes(settings):
    rng = random.Random(6)
    texts = [words(rng, "abcdeé", rng.randint(1, 120)) for _ in range(40)] + ["x" * 500, " " * 300, "a", "Ab " * 100]
    dictionaries = [" ".join(t for t in texts[:10]).encode()[:2000], " ".join(texts[10:20]).encode()[:2000]]
    measure = compression.Measure(*dictionaries, settings)
    for text in texts:
        data = text.encode().lower() if settings.lower else text.encode()
        pieces, rest = [], data
        while rest:
            cut = len(rest)
            if cut > settings.width:
                spaces = [i for i in range(settings.width // 2, settings.width) if rest[i : i + 1] == b" "]
                cut = spaces[-1] + 1 if spaces else settings.width
            pieces.append(rest[:cut])
            rest = rest[cut:]
        sizes = []
        for dictionary in dictionaries:
            compress = compression.compressor(dictionary, settings)
            packed = [compress(p) for p in pieces]
            kind = zstandard.DICT_TYPE_RAWCONTENT if settings.raw else zstandard.DICT_TYPE_AUTO
            back = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary, dict_type=kind))
            assert [back.decompress(c, max_output_size=10_000) for c in packed] == pieces
            sizes.append([len(c) for c in packed])
        gain = [b - a for a, b in zip(*sizes)]
        low, high = settings.marks
        want = [
            sum(gain) / len(data), sum(gain) / (sum(sizes[0]) + sum(sizes[1])), np.mean(sorted(gain)[-3:]), np.mean(sorted(gain)[:3]),
            np.mean([g >= low for g in gain]), np.mean([g >= high for g in gain]), math.log1p(sum(g >= high for g in gain)),
        ]
        assert np.allclose(measure(text), want)


@pytest.mark.parametrize("operator, label", [(quality_zstd, "quality"), (toxicity_zstd, "toxic")])
def test_compression_classifiers_without_labels(spark, operator, label):
    docs = docs_of(spark, ["some text", None, ""])
    none = spark.createDataFrame([], f"doc_id long, {label} int")
    model = operator.fit(docs, none)
    assert [r.s for r in docs.select(model.scores(docs, docs.text).alias("s")).collect()] == pytest.approx([0.5] * 3)
    assert docs.where("false").select(model.scores(docs, docs.text)).count() == 0


def test_windows_cover_the_whole_text():
    for data in (b"", b"a", b"ab " * 500, b"x" * 1000, "é ".encode() * 333):
        pieces = compression.windows(data, 64)
        assert b"".join(pieces) == data and all(0 < len(p) <= 64 for p in pieces)


def slow_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not found:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(found[i : i + 3]).encode(), 42) for i in range(max(1, len(found) - 2))]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "one TWO", "a b c", "É\x1cx y\x85 z w " * 50, "A b c d e f g"])
def test_fingerprint_is_the_defined_one(text):
    assert simhash_trie.fingerprint(text) % (1 << 64) == slow_fingerprint(text)


def slow_components(values, budget=3):
    root = {v: v for v in values}
    done = False
    while not done:
        done = True
        for a in values:
            for b in values:
                if bin(a ^ b).count("1") <= budget and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    done = False
    return root


@pytest.mark.parametrize("outright, least", [(64, 256), (1, 256), (1, 3), (4, 5)])
def test_tries_find_all_links(spark, monkeypatch, outright, least):
    monkeypatch.setattr(simhash_trie, "OUTRIGHT", outright)
    monkeypatch.setattr(simhash_trie, "LEAST_BLOCK", least)
    rng = random.Random(outright * 100 + least)
    values = {0, (1 << 64) - 1, (1 << 64) - 2}
    for _ in range(12):
        center = rng.getrandbits(64)
        values |= {center ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for _ in range(12)}
    signed = {v - (1 << 64) if v >> 63 else v: v for v in values}
    nodes = spark.createDataFrame([(s,) for s in signed], "bits long")
    links = simhash_trie.linked_fingerprints(nodes)
    found = {r.node: r.component for r in components(links).collect()}
    slow = slow_components(list(values))
    same = lambda a, b: found.get(a, a) == found.get(b, b)
    keys = list(signed)
    assert all(same(a, b) == (slow[signed[a]] == slow[signed[b]]) for a in keys for b in keys)


def test_near_duplicates_and_the_row_that_stays(spark):
    rng = random.Random(5)
    base = words(rng, "abcdefgh", 300)
    texts = [base, base, base.replace(base[:5], base[:5].upper()), "quite another text " + words(rng, "stuvw", 80), None, ""]
    docs = docs_of(spark, texts).union(docs_of(spark, texts[:1]))
    docs = docs.union(spark.createDataFrame([(None, base, None, None, None, 0.1, "y", 1)], SCHEMA))
    found = {(r.doc_id, r.component_id) for r in simhash_trie.near_duplicates(docs).collect()}
    assert found == {(0, 0), (1, 0), (2, 0), (3, 3), (4, 4), (5, 4), (None, 0)}
    kept = simhash_trie.distinct_rows(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [0, 3, 4]
    assert simhash_trie.distinct_rows(docs.where("false")).count() == 0
    assert simhash_trie.near_duplicates(docs.where("false")).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def slow_hits(text, items):
    lower = lambda t: WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    own, hit, found = lower(text), set(), set()
    for item, body in items:
        w = lower(body)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            for j in range(len(own) - n + 1):
                if own[j : j + n] == w[i : i + n]:
                    hit |= set(range(j, j + n))
                    found.add(item)
    return len(own), len(hit), sorted(str(f) for f in found if f is not None)


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(9)
    vocabulary = ["alpha", "Beta", "gamma9", "délta", "EPS", "zeta", "x"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 5, 10, 25])))) for i in range(30)]
    items += [(3, items[3][1]), (None, "only here once upon a time in a far land"), (70, None), (71, " -- ")]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(n)) for n in (0, 1, 9, 10, 11, 80, 200)]
    texts += [items[5][1], f"so, {items[8][1].upper()}!", None, "", "ONLY-here/once upon a time in a far land."]
    texts += [texts[-1]] * 3 + ["w" * 3_000_000 + " " + items[9][1]]
    docs = docs_of(spark, texts)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in decontamination.contamination(docs, bench).collect()}
    assert got == {i: slow_hits(t, items) for i, t in enumerate(texts)}
    clean = decontamination.clean_rows(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.collect()) == [i for i, g in got.items() if not g[1]]
    nothing = bench.where("false")
    assert decontamination.clean_rows(docs, nothing).count() == len(texts)
    assert decontamination.clean_rows(docs.where("false"), bench).count() == 0


def test_words_longer_than_a_slice(monkeypatch):
    monkeypatch.setattr(decontamination, "SLICE_BYTES", 16)
    text = "ab " + "c" * 100 + " de, f " + "g" * 17
    found = decontamination.Texts([text, None, "ab"])
    assert found.words(0, 6) == ["ab", "c" * 100, "de", "f", "g" * 17, "ab"] and found.hashes[0] == found.hashes[5]
    assert found.upto.tolist() == [5, 5, 6]


@pytest.mark.parametrize("rule", token_spans.RULES)
def test_token_attribution_equals_brute_force(rule):
    rng = np.random.default_rng(2)
    for _ in range(50):
        ends = np.cumsum(rng.integers(1, 6, size=rng.integers(0, 12)))
        length = int(ends[-1]) if len(ends) else 0
        spans = np.sort(rng.integers(0, length + 1, size=(6, 2)), axis=1)
        starts = [0, *ends[:-1].tolist()] if len(ends) else []
        got, crossing = token_spans.attribute(ends, spans, rule)
        for (low, high), mine, over in zip(spans.tolist(), got, crossing):
            tokens = list(zip(starts, ends.tolist()))
            want = {
                "first": sum(low <= a < high for a, _ in tokens),
                "last": sum(low <= b - 1 < high for _, b in tokens) if high > low else 0,
                "share": sum(max(0, min(b, high) - max(a, low)) / (b - a) for a, b in tokens),
            }[rule]
            edge = sum(high > low and (a < low < b or a < high < b) for a, b in tokens)
            assert mine == pytest.approx(want) and over == edge


def test_token_counts_of_lines_and_given_sections(spark):
    texts = ["first line\nzweite Zeile é\n\nlast", None, "", "a" * 50_000, "x\n", "end"]
    docs = docs_of(spark, texts)
    rows = token_spans.count_tokens(docs).collect()
    token_ends = token_spans.ends_of_tokens(Path(token_spans.VOCABULARY).read_bytes())
    for i, text in enumerate(texts):
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.section)
        encoded = (text or "").encode()
        assert b"".join(encoded[r.start : r.end] for r in own) == encoded and len(own) == (text or "").count("\n") + 1
        assert sum(r.tokens for r in own) == own[0].document_tokens == len(token_ends(text or ""))
    given = docs.selectExpr("doc_id", "text", "array(named_struct('start', 0L, 'end', 5L), named_struct('start', 3L, 'end', null), null) AS spans")
    got = token_spans.count_tokens(given, sections="spans", rule="share").where("doc_id = 0").orderBy("section").collect()
    assert [(r.start, r.end) for r in got] == [(0, 5), (3, len(texts[0].encode()))]
    assert token_spans.count_tokens(docs.where("false")).count() == 0
    odd = spark.createDataFrame([((1 << 53) + 1, "a b"), (None, "c")], "doc_id long, text string").coalesce(1)
    assert {r.doc_id for r in token_spans.count_tokens(odd).collect()} == {(1 << 53) + 1, None}


def test_long_runs_of_white_space_are_encoded_as_the_pattern_does(spark, monkeypatch):
    """The whole pattern at once is what shorter runs can be compared with."""
    vocabulary = Path(token_spans.VOCABULARY).read_bytes()
    plain = token_spans.encoder(vocabulary)
    rng = random.Random(5)
    parts = ["a", "été", "it's", " ", "  ", "\n", "\t\u3000", " \n ", "\x1c", "\u200b", "7", "?!", "\x85", "\u2028 "]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(3000)]
    want = [plain(t) for t in texts]
    for least in (1, 2, 3):
        monkeypatch.setattr(token_spans, "LONG_RUN", least)
        cut = token_spans.encoder(vocabulary)
        assert [cut(t) for t in texts] == want
    monkeypatch.undo()
    long = ["x" + " " * 1_000_000 + "y", "\n" * 1_000_000, " \n" * 400_000 + "a" * 1_000_000, "?" * 300_000 + " " * 9000 + "\nend"]
    got = {r.doc_id: r for r in token_spans.count_tokens(docs_of(spark, long)).groupBy("doc_id").agg(
        F.max("document_tokens").alias("n"), F.max("end").alias("size"), F.sum("tokens").alias("tokens")).collect()}
    for i, text in enumerate(long):
        assert got[i]["size"] == len(text) and got[i].tokens == got[i].n > 0
