"""Encoding by distinct chunks against the library on whole texts."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from comarca.llm import entries, piece_encoding
from entries.tables import table

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "b", "the", "ing", " ", "  ", "\n", "\t", "▁", "é", "日本", "😀", "\x00", "12", "<0x0A>", "<s>", "<unk>", "　", "‍"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_chunks_are_segmented_as_in_whole_texts(library):
    rng = random.Random(3)
    plain = piece_encoding.surfaces(library)
    for _ in range(5000):
        text = "".join(rng.choices(PARTS, k=rng.randint(0, 14)))
        ids = [i for found in piece_encoding.segment(library, piece_encoding.chunks_of(text)) for i in found]
        assert ids == library.encode(text)
        assert b"".join(plain[i] for i in ids)[1:].decode() == library.decode(ids)


def test_rows_equal_the_library(spark, library, monkeypatch):
    rng = random.Random(4)
    texts = [None, "", " ", "   ", "▁", " " * 50_000, "\n" * 50_000, "x" * 100_000, "same words here", "same words here"]
    texts += ["".join(rng.choices(PARTS, k=rng.randint(0, 200))) for _ in range(200)] + ["hot words " * 30] * 150
    # Not a number that a double holds, beside NULL.
    rows = [((1 << 62) + i if i % 9 else None, t, "x", 1, "y") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, chunk string, block int, ids string").repartition(5)
    for most in (piece_encoding.BLOCK_BYTES, 300):
        # Small blocks: one chunk in many of them, a text longer than a block.
        monkeypatch.setattr(piece_encoding, "BLOCK_BYTES", most)
        got = piece_encoding.encode(docs, MODEL)
        assert got.dtypes == [("doc_id", "bigint"), ("ids", "array<int>"), ("decoded", "string")]
        found = sorted(((r.doc_id is None, r.doc_id or 0), list(r.ids), r.decoded) for r in got.collect())
        ids = [library.encode(t or "") for t in texts]
        assert found == sorted(((r[0] is None, r[0] or 0), i, library.decode(i)) for r, i in zip(rows, ids))
    assert piece_encoding.encode(docs.limit(0), MODEL).count() == 0


def test_each_distinct_chunk_is_segmented_once(spark, library, monkeypatch):
    docs = spark.createDataFrame([(i, f"a b c a b {i % 7}") for i in range(3000)], "doc_id long, text string").repartition(6)
    blocks = piece_encoding.numbered_blocks(docs, "doc_id", "text")
    uses = blocks.where("shard >= 0")
    assert uses.groupBy("block", "shard").count().where("count > 1").count() == 0 and uses.count() <= 6 * 8
    # A table that is begun anew gives the same ids.
    want = {i: library.encode(f"a b c a b {i % 7}") for i in range(3000)}
    monkeypatch.setattr(piece_encoding, "TABLE_ENTRIES", 1)
    monkeypatch.setattr(piece_encoding, "BLOCK_BYTES", 50)
    assert {r.doc_id: list(r.ids) for r in piece_encoding.encode(docs, MODEL).collect()} == want


def test_texts_stay_in_their_buckets(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = piece_encoding.encode(docs, MODEL)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(block" not in plan and plan.count("Exchange hashpartitioning") == 2, plan


def test_models_that_cross_markers_are_refused(monkeypatch):
    class Crossing:
        def __getattr__(self, name):
            return getattr(sentencepiece.SentencePieceProcessor(model_file=MODEL), name)

        def id_to_piece(self, i):
            return "▁of▁the" if i == 300 else "▁of"

    monkeypatch.setattr(piece_encoding, "processor", lambda model: Crossing())
    with pytest.raises(ValueError, match="cross markers"):
        piece_encoding.read_model(MODEL)


def test_query_equals_the_library(spark, library):
    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    got = {tuple(r) for r in entries.QUERIES["op11_piece_chunks"](spark, SF).collect()}
    want = set()
    for r in table(spark, SF, "documents").collect():
        ids = library.encode(r.text or "")
        want.add((r.doc_id, len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids))))
    assert got == want
