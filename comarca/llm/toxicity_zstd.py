"""Toxicity by compression distance: zstandard dictionaries of toxic and of ordinary text.

Toxic texts are mostly ordinary text, so the two dictionaries share a base trained
on ordinary windows; behind it each holds the byte sequences that stand out in its
own texts, by the number of texts that hold them. Small windows are compressed with
both; how many of them get shorter by the calibrated thresholds, and by how much,
becomes a probability. Whole texts are read, and nothing but the text.

Defined results: NULL and empty texts get the score of a text without marked windows;
with no labels at all every score is 0.5, with one label only that label's smoothed
share; repeated rows score alike; other columns never matter.
"""

from __future__ import annotations

from collections import Counter

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comarca.llm import compression
from comarca.llm.compression import encoded

SETTINGS = compression.Settings(
    width=64, min_match=5, strategy=zstandard.STRATEGY_GREEDY, raw=True, lower=True
)
GRAM = 6
BASE_BYTES = 3700
OWN_BYTES = 800
# A sequence has to be in this share of its label's texts, and in three of them.
LEAST_SHARE = 0.008
# How many times likelier a sequence has to be in texts of its label.
LEAST_RATIO = 6.0
# Bounds of what is fitted on: rows of each label, windows of each label.
ROWS_PER_LABEL = 3000
WINDOWS_PER_LABEL = 40_000
THRESHOLD = 0.7


def telling_sequences(sample: DataFrame, settings: compression.Settings, gram: int = GRAM,
                      size: int = OWN_BYTES) -> dict[int, bytes]:
    """For each label the byte sequences of ``gram`` bytes that stand out in its texts, the strongest last.

    As many as fit into ``size`` bytes, which is what the dictionary has room for.
    """
    def count(batches):
        for batch in batches:
            held: tuple[Counter, Counter] = (Counter(), Counter())
            for label, text in zip(batch["label"], batch["text"]):
                data = b" " + encoded(text, settings) + b" "
                held[label].update({data[i : i + gram] for i in range(len(data) - gram + 1)})
            rows = [(g, held[0][g], held[1][g]) for g in held[0].keys() | held[1].keys()]
            yield pd.DataFrame(rows, columns=["gram", "n0", "n1"])

    texts = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    n = [texts.get(k, 0) for k in (0, 1)]
    counts = sample.select("label", "text").mapInPandas(count, "gram binary, n0 long, n1 long").groupBy("gram").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1")
    )
    shares = [(F.col(f"n{k}") + 0.5) / (n[k] + 1) for k in (0, 1)]
    found = {}
    least = [max(3, round(LEAST_SHARE * x)) for x in n]
    for own in (0, 1):
        ratio = shares[own] / shares[1 - own]
        strength = F.col(f"n{own}") * F.log(ratio)
        best = (
            counts.where((F.col(f"n{own}") >= least[own]) & (ratio >= LEAST_RATIO))
            .orderBy(strength.desc(), "gram").limit(size // (gram + 1)).select("gram").collect()
        )
        taken = [bytes(r["gram"]) for r in best]
        found[own] = b"\n".join(reversed(taken))
    return found


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text",
        settings: compression.Settings = SETTINGS, rows_per_label: int = ROWS_PER_LABEL,
        windows_per_label: int = WINDOWS_PER_LABEL, base_bytes: int = BASE_BYTES,
        own_bytes: int = OWN_BYTES, gram: int = GRAM) -> compression.Classifier:
    """From about ``rows_per_label`` labelled rows and ``windows_per_label`` windows of each label.

    The dictionaries hold ``base_bytes`` of ordinary text and ``own_bytes`` of sequences of
    ``gram`` bytes each.
    """
    sample = compression.labelled_sample(docs, labels, label, key, text, rows_per_label)
    half = sample.where("part = 0")
    ordinary = compression.sampled_windows(half.where("label = 0"), settings, windows_per_label)[0]
    base = compression.trained_dictionary(ordinary, base_bytes + 400)[-base_bytes:]
    own = telling_sequences(half, settings, gram, own_bytes)
    return compression.calibrated(base + own[1], base + own[0], settings, sample.where("part = 1"))
