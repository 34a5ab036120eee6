"""Quality scores from two zstandard dictionaries, of good and of bad texts.

Dictionaries are trained on windows of one half of a bounded sample of labelled rows;
the other half calibrates the normalised difference of compressed sizes to a
probability. Scores look at whole texts and at nothing but the text.

Defined results: NULL and empty texts have no windows and get the score of a zero
difference; with no labels at all every score is 0.5, with one label only it is that
label's smoothed share; repeated rows score alike; other columns never matter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from comarca.llm import compression

SETTINGS = compression.Settings(width=128)
DICTIONARY_BYTES = 16 << 10
# Bounds of what is fitted on: rows of each label, windows of each label.
ROWS_PER_LABEL = 4000
WINDOWS_PER_LABEL = 30_000
THRESHOLD = 0.3


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text",
        settings: compression.Settings = SETTINGS, rows_per_label: int = ROWS_PER_LABEL,
        windows_per_label: int = WINDOWS_PER_LABEL, dictionary_bytes: int = DICTIONARY_BYTES) -> compression.Classifier:
    """From about ``rows_per_label`` labelled rows and ``windows_per_label`` windows of each label."""
    sample = compression.labelled_sample(docs, labels, label, key, text, rows_per_label)
    pieces = compression.sampled_windows(sample.where("part = 0"), settings, windows_per_label)
    good, bad = (compression.trained_dictionary(pieces[k], dictionary_bytes) for k in (1, 0))
    return compression.calibrated(good, bad, settings, sample.where("part = 1"))
