"""Language identification by words first, then by ever shorter character n-grams.

A known word adds its log frequency in each language. A word the model has not
seen adds the mean log frequency of its known 5-grams, else its known 4-grams,
and so on down to single letters. Frequencies are learned from rows that carry a
language: about ``rows_per_language`` whole texts of every language there is, drawn by a
hash of the id. Of what they hold the model knows each language's ``words_per_language``
most frequent words and ``grams_per_language`` most frequent n-grams of every length;
a word beyond that backs off like any unseen one. So what the driver and each task hold
grows with the number of languages only.

Defined results: NULL, empty and letterless texts are ``und`` with score 0; a
text none of whose words and letters the model knows scores 1 / languages; ties go
to the language that sorts first; with
nothing to learn from every text is ``und``; repeated rows are predicted alike;
rows of an empty table stay none; other columns never matter.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from comarca.llm.frames import bounded_batches, shipped, uniform
from comarca.sinks.pinned import pin

UNDETERMINED = "und"
ROWS_PER_LANGUAGE = 2000
WORDS_PER_LANGUAGE = 20_000
GRAMS_PER_LANGUAGE = 6_000
LONGEST = 5
LEAST_COUNT = 2
SMOOTHING = 0.5
# Words whose evidence makes a score as sure as it gets.
SURE_WORDS = 12
SEED = 41

_WORDS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """Lower-cased runs of letters."""
    found = _WORDS.findall(text.lower())
    return found if "".join(found).isalpha() else [w for w in map(_letters, found) if w]


def _letters(word: str) -> str:
    return "".join(filter(str.isalpha, word))


def grams_of(word: str, n: int) -> list[str]:
    """n-grams of the word between marks for its ends; single letters without the marks."""
    marked = f"<{word}>" if n > 1 else word
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


@dataclass
class LanguageModel:
    """Log frequencies per language, in long form.

    What a language has ``times`` of is log(SMOOTHING / whole) + log(times / SMOOTHING + 1).
    ``base`` has the first part for each level (0: words, n: n-grams) and language; the
    entries ``first[i]`` to ``first[i + 1]`` of ``langs`` and ``logs`` have the second part
    of row i in the languages that know it. ``words`` and ``grams`` name the rows.
    """

    languages: list[str]
    words: dict[str, int]
    grams: dict[str, int]
    base: np.ndarray
    first: np.ndarray
    langs: np.ndarray
    logs: np.ndarray

    def backoff(self, word: str) -> tuple[int, list[int]]:
        """The greatest length of which the word has known n-grams, and their rows."""
        get = self.grams.get
        marked = f"<{word}>"
        for n in range(min(LONGEST, len(marked)), 1, -1):
            known = [i for j in range(len(marked) - n + 1) if (i := get(marked[j : j + n])) is not None]
            if known:
                return n, known
        return 1, [i for letter in word if (i := get(letter)) is not None]

    def evidence(self, words: list[str]) -> np.ndarray:
        """Mean log frequency of the words in each language."""
        at = list(map(self.words.get, words))
        rows = [i for i in at if i is not None]
        weights, levels = [np.ones(len(rows))], np.zeros(LONGEST + 1)
        levels[0] = len(rows)
        if len(rows) < len(words):
            lengths = []
            for word, i in zip(words, at):
                if i is None:
                    n, found = self.backoff(word)
                    if found:
                        rows += found
                        lengths.append(len(found))
                        levels[n] += 1
            weights.append(np.repeat(1.0 / np.array(lengths), lengths) if lengths else np.zeros(0))
        total = levels @ self.base
        if rows:
            begin, end = self.first[rows], self.first[np.array(rows) + 1]
            each = end - begin
            entries = np.repeat(begin - (np.cumsum(each) - each), each) + np.arange(each.sum())
            more = self.logs[entries] * np.repeat(np.concatenate(weights), each)
            total = total + np.bincount(self.langs[entries], weights=more, minlength=len(self.languages))
        return total / len(words)

    def predict(self, text: str | None) -> tuple[str, float]:
        words = words_of(text) if text else []
        if not words or not self.languages:
            return UNDETERMINED, 0.0
        mean = self.evidence(words)
        weights = np.exp((mean - mean.max()) * min(len(words), SURE_WORDS))
        best = int(np.argmax(weights))
        return self.languages[best], float(weights[best] / weights.sum())


def model_of(languages: list[str], counts: pd.DataFrame, totals: dict[tuple[int, int], int]) -> LanguageModel:
    """From rows (level, gram, of, times) and the sums of times per level and language."""
    counts = counts.sort_values(["level", "gram", "of"], kind="stable").reset_index(drop=True)
    level, gram, of = (counts[c].to_numpy() for c in ("level", "gram", "of"))
    new = np.ones(len(counts), dtype=bool)
    new[1:] = (level[1:] != level[:-1]) | (gram[1:] != gram[:-1])
    starts = np.flatnonzero(new)
    base = np.zeros((LONGEST + 1, len(languages)))
    for n in range(LONGEST + 1):
        known = int((level[starts] == n).sum())
        whole = np.array([totals.get((n, k), 0) for k in range(len(languages))], dtype=float)
        base[n] = np.log(SMOOTHING / (whole + SMOOTHING * max(1, known)))
    tables: tuple[dict, dict] = ({}, {})
    for i, at in enumerate(starts.tolist()):
        tables[int(level[at] > 0)][gram[at]] = i
    return LanguageModel(
        languages, *tables, base, np.append(starts, len(counts)).astype(np.int64), of.astype(np.int64),
        np.log(counts["times"].to_numpy(float) / SMOOTHING + 1).astype(np.float32),
    )


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
        rows_per_language: int = ROWS_PER_LANGUAGE, words_per_language: int = WORDS_PER_LANGUAGE,
        grams_per_language: int = GRAMS_PER_LANGUAGE) -> LanguageModel:
    """Learns from about ``rows_per_language`` rows of each language, whole texts each.

    The driver gets at most ``words_per_language`` words and ``grams_per_language`` n-grams
    of each length for every language, each with its count in all languages.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(
        docs[f"`{key}`"].alias("key"), docs[f"`{text}`"].alias("text"), docs[f"`{lang}`"].alias("lang")
    ).where("text IS NOT NULL AND lang IS NOT NULL")
    sizes = pin(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("size")), "languages")
    languages = sorted(r["lang"] for r in sizes.collect())
    if not languages:
        return model_of([], pd.DataFrame({"level": [], "gram": [], "of": [], "times": []}), {})
    numbered = docs.sparkSession.createDataFrame(list(enumerate(languages)), "of int, name string")
    # A row per language on this side, so a hot language's rows can be split; written, so that
    # Spark knows how small it is and needn't move the texts.
    named = pin(sizes.join(numbered, F.col("lang") == F.col("name")).select("lang", "of", "size"), "languages")
    drawn = rows.join(named, "lang").where(uniform("key", "text", seed=SEED) < F.lit(rows_per_language) / F.col("size"))

    def count_words(batches):
        held = Counter()
        for batch in batches:
            for value, of in zip(batch["text"], batch["of"]):
                held.update(zip(repeat(of), words_of(value)))
                if len(held) > 50_000:
                    yield pd.DataFrame([(of, w, c) for (of, w), c in held.items()], columns=["of", "gram", "times"])
                    held = Counter()
        yield pd.DataFrame([(of, w, c) for (of, w), c in held.items()], columns=["of", "gram", "times"])

    words = pin(
        drawn.select("text", "of").mapInPandas(count_words, "of int, gram string, times long")
        .groupBy("of", "gram").agg(F.sum("times").alias("times")),
        "language-words",
    )

    def count_grams(batches):
        # Each word of a language once, with its count; summed per batch, then by Spark.
        for batch in batches:
            held = Counter()
            for of, word, times in zip(batch["of"], batch["gram"], batch["times"]):
                for n in range(1, LONGEST + 1):
                    for gram in grams_of(word, n):
                        held[n, gram, of] += times
            yield pd.DataFrame([(*k, t) for k, t in held.items()], columns=["level", "gram", "of", "times"])

    often = F.sum("times").over(Window.partitionBy("level", "gram")) >= LEAST_COUNT
    known = words.withColumn("level", F.lit(0)).select("level", "gram", "of", "times")
    known = known.withColumn("often", often).where("often").drop("often")
    grams = (
        known.select("of", "gram", "times").mapInPandas(count_grams, "level int, gram string, of int, times long")
        .groupBy("level", "gram", "of").agg(F.sum("times").alias("times"))
    )
    counts = pin(known.union(grams), "language-counts")
    place = F.row_number().over(Window.partitionBy("level", "of").orderBy(F.desc("times"), "gram"))
    most = F.when(F.col("level") == 0, words_per_language).otherwise(grams_per_language)
    kept = counts.withColumn("place", place).where(F.col("place") <= most).select("level", "gram").distinct()
    totals = {(r["level"], r["of"]): r["times"] for r in
              counts.groupBy("level", "of").agg(F.sum("times").alias("times")).collect()}
    return model_of(languages, counts.join(kept, ["level", "gram"]).toPandas(), totals)


def predictor(docs: DataFrame, model: LanguageModel):
    """A function from a text column to struct<lang_pred, score>."""
    bounded_batches(docs.sparkSession)
    shared = shipped(docs.sparkSession, model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        model = shared()
        return pd.DataFrame([model.predict(t) for t in texts], columns=["lang_pred", "score"])

    return predict


def predicted(docs: DataFrame, model: LanguageModel, text: Column) -> Column:
    return predictor(docs, model)(text)
