"""What the two compression classifiers share: windows, dictionaries, features and calibration.

Two zstandard dictionaries, one made from texts with the label and one from texts
without it, compress every window of a text; the differences of the compressed
lengths, over the whole text, become the features of a logistic calibration.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comarca.llm.frames import bounded_batches, shipped, uniform
from comarca.sinks.pinned import pin

SEED = 53
FEATURES = 7


@dataclass(frozen=True)
class Settings:
    """``width`` bytes a window; ``level`` and, where given, match length and strategy of the compressor."""

    width: int
    level: int = 3
    min_match: int | None = None
    strategy: int | None = None
    raw: bool = False
    lower: bool = False
    # Bytes by which a window has to be shorter with one dictionary to count as marked.
    marks: tuple[int, int] = (2, 3)


def windows(data: bytes, width: int) -> list[bytes]:
    """The whole text in pieces of at most ``width`` bytes, cut behind a space where there is one."""
    found, at, n = [], 0, len(data)
    while at < n:
        upto = at + width
        if upto < n:
            space = data.rfind(b" ", at + width // 2, upto)
            upto = space + 1 if space > 0 else upto
        found.append(data[at:upto])
        at = upto
    return found


def encoded(text: str | None, settings: Settings) -> bytes:
    data = (text or "").encode("utf-8", "surrogatepass")
    return data.lower() if settings.lower else data


def trained_dictionary(samples: list[bytes], size: int) -> bytes:
    """A dictionary of common segments; plain samples where there are too few to train on."""
    samples = sorted(s for s in samples if len(s) >= 8)
    try:
        return zstandard.train_dictionary(size, samples, k=32, d=6, level=3).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b" ".join(samples)[-size:]


def compressor(dictionary: bytes, settings: Settings):
    plain = dict(write_content_size=False, write_checksum=False, write_dict_id=False)
    extra = {k: v for k, v in (("min_match", settings.min_match), ("strategy", settings.strategy)) if v is not None}
    parameters = zstandard.ZstdCompressionParameters.from_level(
        settings.level, source_size=2 * settings.width, dict_size=len(dictionary), **extra, **plain
    )
    kind = zstandard.DICT_TYPE_RAWCONTENT if settings.raw else zstandard.DICT_TYPE_AUTO
    content = zstandard.ZstdCompressionDict(dictionary or b" " * 8, dict_type=kind)
    content.precompute_compress(compression_params=parameters)
    return zstandard.ZstdCompressor(compression_params=parameters, dict_data=content).compress


class Measure:
    """The features of a text: how much shorter its windows get with the dictionary of the label."""

    def __init__(self, with_label: bytes, without: bytes, settings: Settings):
        self.settings = settings
        self.with_label, self.without = compressor(with_label, settings), compressor(without, settings)

    def __call__(self, text: str | None) -> np.ndarray:
        pieces = windows(encoded(text, self.settings), self.settings.width)
        if not pieces:
            return np.zeros(FEATURES)
        with_label, without = self.with_label, self.without
        a = np.array([len(with_label(p)) for p in pieces], dtype=float)
        b = np.array([len(without(p)) for p in pieces], dtype=float)
        gain = b - a
        ordered = np.sort(gain)
        low, high = self.settings.marks
        return np.array([
            # The normalised difference of the compressed sizes, over bytes and over compressed bytes.
            gain.sum() / sum(map(len, pieces)),
            gain.sum() / (a.sum() + b.sum()),
            ordered[-3:].mean(),
            ordered[:3].mean(),
            (gain >= low).mean(),
            (gain >= high).mean(),
            np.log1p((gain >= high).sum()),
        ])


@dataclass(frozen=True)
class Calibration:
    """Logistic regression on standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def __call__(self, features: np.ndarray) -> np.ndarray:
        x = np.clip((features - self.mean) / self.scale, -8, 8)
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[1:] + self.weights[0], -30, 30)))


def calibrate(features: np.ndarray, labels: np.ndarray, given: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> Calibration:
    """Fits weighted rows by Newton's method with a ridge; with one label only, every score is its smoothed share.

    A row weighs as many labelled rows as it stands for, over the mean of all.
    """
    weights = given / given.mean()
    mean, scale = features.mean(axis=0), features.std(axis=0)
    scale = np.where(scale > 1e-12, scale, 1.0)
    x = np.column_stack([np.ones(len(features)), np.clip((features - mean) / scale, -8, 8)])
    share = ((weights * labels).sum() + 0.5) / (len(labels) + 1)
    w = np.zeros(x.shape[1])
    w[0] = np.log(share / (1 - share))
    if 0 < labels.sum() < len(labels):
        penalty = np.diag([0.0, *[ridge] * (x.shape[1] - 1)])
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            slope = x.T @ (weights * (labels - p)) - penalty @ w
            curve = (x * (weights * p * (1 - p))[:, None]).T @ x + penalty + 1e-9 * np.eye(len(w))
            w = w + np.clip(np.linalg.solve(curve, slope), -5, 5)
    return Calibration(mean, scale, w)


@dataclass(frozen=True)
class Classifier:
    with_label: bytes
    without: bytes
    settings: Settings
    calibration: Calibration

    def scores(self, docs: DataFrame, text: Column) -> Column:
        """P(label) of whole texts, between 0 and 1."""
        bounded_batches(docs.sparkSession)
        shared = shipped(docs.sparkSession, self)

        @F.pandas_udf("double")
        def score(texts: pd.Series) -> pd.Series:
            model = shared()
            measure = model.measure()
            features = np.array([measure(t) for t in texts]).reshape(-1, FEATURES)
            return pd.Series(model.calibration(features))

        return score(text)

    def measure(self) -> Measure:
        return Measure(self.with_label, self.without, self.settings)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, key: str, text: str, per_label: int) -> DataFrame:
    """(key, text, label: 0 or 1, weight, part: 0 or 1) of about ``per_label`` rows of each label.

    A key is drawn by a hash of it, the likelier the more rows it has, and of a key's rows as
    many as keep every row's chance the same; so a key which many documents share does
    not make the sample larger. Labels that are NULL, neither 0 nor 1 or that contradict
    each other are not used.
    """
    bounded_batches(docs.sparkSession)
    given = (
        labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).where("key IS NOT NULL AND label IN (0, 1)")
        .groupBy("key").agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most").drop("most")
    )
    rows = docs.select(docs[f"`{key}`"].alias("key"), F.coalesce(docs[f"`{text}`"], F.lit("")).alias("text"))
    # No text is moved for this.
    keys = pin(rows.select("key").join(given, "key").groupBy("key", "label").agg(F.count(F.lit(1)).alias("rows")), "labels")
    counts = {r["label"]: r["rows"] for r in keys.groupBy("label").agg(F.sum("rows").alias("rows")).collect()}
    chances = [min(1.0, per_label / max(1, counts.get(k, 0))) for k in (0, 1)]
    chance = F.when(F.col("label") == 1, chances[1]).otherwise(chances[0])
    own = F.least(F.lit(1.0), F.col("rows") * chance)
    # About ``per_label`` keys of each label at most, whatever the input.
    drawn = F.broadcast(
        keys.where(uniform("key", seed=SEED) < own).select("key", "label", (1 / chance).alias("weight"), (chance / own).alias("share"))
    )
    kept = rows.join(drawn, "key").withColumn("draw", F.when(F.col("share") < 1, uniform("key", F.monotonically_increasing_id(), seed=SEED + 2)).otherwise(0.0))
    # Rows of one key may go to both halves where the key has too many.
    half = F.when(F.col("share") < 1, uniform("key", "draw", seed=SEED + 1)).otherwise(uniform("key", seed=SEED + 1))
    part = (half < 0.5).cast("int")
    return pin(kept.where("draw < share").select("key", "text", "label", "weight", part.alias("part")), "labelled")


def sampled_windows(sample: DataFrame, settings: Settings, most: int) -> dict[int, list[bytes]]:
    """About ``most`` windows of each label, from all places of the sample's texts."""
    bytes_of = {r["label"]: r["bytes"] for r in
                sample.groupBy("label").agg(F.sum(F.octet_length("text")).alias("bytes")).collect()}
    chance = {k: min(1.0, most * settings.width / max(1, v or 1)) for k, v in bytes_of.items()}

    def cut(batches):
        for batch in batches:
            rows = []
            for label, key, text in zip(batch["label"], batch["key"], batch["text"]):
                pieces = windows(encoded(text, settings), settings.width)
                keep = np.random.default_rng([SEED, zlib.crc32(str(key).encode())]).random(len(pieces)) < chance[label]
                rows += [(label, p) for p, k in zip(pieces, keep) if k]
            yield pd.DataFrame(rows, columns=["label", "piece"])

    found: dict[int, list[bytes]] = {0: [], 1: []}
    for label, piece in sample.mapInPandas(cut, "label int, piece binary").collect():
        found[label].append(bytes(piece))
    return found


def calibrated(with_label: bytes, without: bytes, settings: Settings, sample: DataFrame) -> Classifier:
    """A classifier whose calibration is fitted on ``sample``; an empty sample scores everything 0.5."""
    def features(batches):
        measure = Measure(with_label, without, settings)
        for batch in batches:
            found = np.array([measure(t) for t in batch["text"]]).reshape(-1, FEATURES)
            yield pd.concat([pd.DataFrame(found, columns=names), batch[["label", "weight"]].reset_index(drop=True)], axis=1)

    names = [f"f{i}" for i in range(FEATURES)]
    rows = sample.mapInPandas(features, ", ".join(f"{n} double" for n in names) + ", label int, weight double").toPandas()
    # In one order, so that sums of floating-point numbers agree between runs.
    rows = rows.sort_values([*names, "label"])
    table = rows[names].to_numpy(float).reshape(-1, FEATURES)
    if not len(table):
        table, labels, weights = np.zeros((2, FEATURES)), np.array([0.0, 1.0]), np.ones(2)
    else:
        labels, weights = rows["label"].to_numpy(float), rows["weight"].to_numpy(float)
    return Classifier(with_label, without, settings, calibrate(table, labels, weights))
