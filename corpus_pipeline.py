"""A corpus from documents to shards, in five stages.

Each stage takes the rows its predecessor kept, is written as Parquet and read again.

* ``language`` drops documents whose language can't be told (no letters, or a score
  below ``LEAST_SCORE``); the model learns from the rows that carry a language. With
  none to learn from it drops every row.
* ``near_duplicates`` keeps one document of each group of near copies, the one with
  the smallest id: a document goes if it shares four fifths of its five-word shingles with
  one that stays. Candidates come from fingerprints, so some pairs near the limit stay both.
* ``decontamination`` drops documents that hold a window of a benchmark item.
* ``mixing`` repeats or drops documents so that sources come near their targets: a
  document appears as often as the mix takes its words, rounded to whole times by a
  seeded draw, so that documents of every length keep their share.
* ``sharding`` adds the shard and the slot in it.

Nulls, empty and very long texts, ties, repeated rows, empty tables and further
columns are dealt with as each operator's docstring says; further columns are kept,
and the added ones get a free name where theirs is taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comarca.llm import decontamination, langid, mixing, simhash_trie, splitters
from comarca.llm.frames import free_names
from comarca.sinks.pinned import pin

LEAST_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    (found,) = free_names(docs, "found")
    model = langid.fit(docs)
    told = docs.withColumn(found, langid.predicted(docs, model, F.col("text")))
    keep = (F.col(f"{found}.lang_pred") != langid.UNDETERMINED) & (F.col(f"{found}.score") >= LEAST_SCORE)
    return told.where(keep).drop(found)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_trie.distinct_similar_rows(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean_rows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = mixing.mix(docs, keep=tuple(docs.columns))
    times = F.when(F.col("copies") > 0, F.sequence(F.lit(1), "copies"))
    return found.select("kept", F.explode(times).alias("time")).select("kept.*")


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    shard, slot = free_names(docs, "shard", "slot")
    found = splitters.shard(docs, keep=tuple(docs.columns))
    return found.select("kept.*", F.col("shard").alias(shard), F.col("slot").alias(slot))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", clean),
    ("mixing", mixed),
    ("sharding", sharded),
]

# Fingerprints, language scores and sampled boundaries can't be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = pin(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
