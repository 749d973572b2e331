"""Toxicity by FTRL-proximal logistic regression (operator 2).

Features are hashes of words, of pairs of neighbours and of pairs with one word between
(skip-grams), each counted once per text.  FTRL-proximal gives every feature its own
learning rate and its L1 penalty sets most weights to exactly 0, so the weights that are
left are few and can be sent to all tasks.

Learning takes a sample of at most ``SAMPLE`` labelled texts (those whose id has the
smallest hash), in ``SHARDS`` shards that Spark trains in parallel; the weights of the
shards are averaged (one shard is enough for this sample).  A feature must occur in ``LEAST_TEXTS`` texts of its shard, so the
number of weights is bounded by the sample.  Scoring covers whole texts of all rows.

Special cases: a null text is empty, and has the score of the constant alone; rows
without a label or id are not learned from; without labelled rows every score is 0.5;
rows are scored each by their own text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from offerquarry.llm.common import WordHashes, joined, mixed, read_table, utf8
from offerquarry.sources.shared import ship_code, write_and_read

SAMPLE = 10_000
SHARDS = 1
LEAST_TEXTS = 5
EPOCHS = 10
ALPHA, BETA, L1, L2 = 2.0, 1.0, 8.0, 0.0
TOXIC = 0.7
_MARKS = bytes.maketrans(b".,;:!?\"'()[]{}", b" " * 14)
_FILTER_BITS = 22


def features(text: bytes | None, hashes: WordHashes) -> np.ndarray:
    """Distinct feature hashes of a text; the kinds do not mix."""
    words = hashes.of_text((text or b"").translate(_MARKS).lower())
    pairs = joined(words[:-1], words[1:], 1) if len(words) > 1 else words[:0]
    skips = joined(words[:-2], words[2:], 2) if len(words) > 2 else words[:0]
    return np.unique(np.concatenate([mixed(words), pairs, skips]))


class Ftrl:
    """FTRL-proximal over features 0 .. n-1 that are present or absent.

    The last coordinate is the constant; it has no L1 penalty.
    """

    def __init__(self, n: int):
        self.z, self.n = np.zeros(n + 1), np.zeros(n + 1)
        self.l1 = np.full(n + 1, L1)
        self.l1[-1] = 0.0

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, l1 = self.z[at], self.l1[at]
        rate = (BETA + np.sqrt(self.n[at])) / ALPHA + L2
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / rate)

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        gradient = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - label
        grown = self.n[at] + gradient * gradient
        step = (np.sqrt(grown) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += gradient - step * w
        self.n[at] = grown


def train(texts: list[bytes | None], labels: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and weights of the features that count; the constant has hash 0."""
    hashes = WordHashes()
    rows = [features(t, hashes) for t in texts]
    every, counts = np.unique(np.concatenate(rows), return_counts=True)
    every = every[counts >= LEAST_TEXTS]
    model = Ftrl(len(every))
    placed = []
    for row in rows:
        at = np.searchsorted(every, row[np.isin(row, every, assume_unique=True)])
        placed.append(np.append(at, len(every)))
    order = np.random.default_rng(1)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            model.learn(placed[i], labels[i])
    weights = model.weights()
    used = np.flatnonzero(weights[:-1])
    return np.append(every[used], np.uint64(0)), np.append(weights[used], weights[-1])


def _train_shard(table: pa.Table) -> pa.Table:
    # In the order of the ids, so that reruns agree.
    table = table.sort_by("doc_id")
    keys, weights = train(table.column("text").to_pylist(), table.column("label").to_pylist())
    return pa.table({"feature": keys.view(np.int64), "weight": weights})


@dataclass(frozen=True)
class Model:
    keys: np.ndarray  # sorted feature hashes
    weights: np.ndarray
    constant: float

    def filter(self) -> np.ndarray:
        """Which low bits of a hash lead to any feature with a weight?"""
        low = np.zeros(1 << _FILTER_BITS, bool)
        low[self.keys & np.uint64((1 << _FILTER_BITS) - 1)] = True
        return low

    def score(self, found: np.ndarray, low: np.ndarray) -> float:
        found = found[low[found & np.uint64((1 << _FILTER_BITS) - 1)]]
        total = self.constant
        if len(found) and len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, found), len(self.keys) - 1)
            total += float(self.weights[at][self.keys[at] == found].sum())
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """From texts with labels: ``docs`` holds ``doc_id, text``, ``labels`` ``doc_id, label``."""
    ship_code(docs.sparkSession)
    known = labels.where("doc_id IS NOT NULL AND label IS NOT NULL").dropDuplicates(["doc_id"])
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    chosen = write_and_read(chosen.select("doc_id", F.col("label").cast("int").alias("label")), "sample")
    shard = F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(SHARDS)).alias("shard")
    rows = docs.join(chosen, "doc_id").select(shard, "doc_id", utf8("text").alias("text"), "label")
    weights = rows.groupBy("shard").applyInArrow(_train_shard, "feature long, weight double")
    weights = write_and_read(weights, "weights")
    shards = max(1, weights.where("feature = 0").count())
    total = weights.groupBy("feature").agg((F.sum("weight") / shards).alias("weight"))
    found = {r.feature: r.weight for r in total.collect()}
    constant = found.pop(0, 0.0)
    keys = np.array(list(found), np.int64).view(np.uint64)
    order = np.argsort(keys)
    return Model(keys[order], np.array(list(found.values()), float)[order], constant)


def score_column(model: Model, text: str = "text") -> Column:
    @F.arrow_udf(DoubleType())
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashes, low = WordHashes(), model.filter()
        for texts in batches:
            scores = [model.score(features(t.as_py(), hashes), low) for t in texts]
            yield pa.array(scores, pa.float64())

    return score(utf8(text))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    known = labels.where(~held_out).select("doc_id", F.col("toxic").alias("label"))
    model = learn(docs.select("doc_id", "text"), known)
    scored = docs.select("doc_id", held_out.alias("held_out"), score_column(model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= TOXIC).cast("int"))
