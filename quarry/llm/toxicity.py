"""Toxicity scores: FTRL-proximal logistic regression on hashed word n-grams
and skip-grams.

Words are runs of letters, digits and non-ASCII bytes, lower-cased in ASCII. A
document's features are the set of hashes of its words, the stems (first six
bytes) of its longer words, its pairs of neighbours, and its pairs with one
word between. Training runs over a bounded
sample of labelled rows (``rows_per_class`` of each class, the ones first by a
hash of id and text), one document at a time with per-coordinate learning
rates; the L1 term leaves few weights, so what is broadcast is one vector of
``2**BITS`` single-precision numbers (1 MB) whatever the size of the corpus.
Where both classes have that many rows, scores are those of even odds: a rare
class is not scored down for being rare. Scoring reads every whole text.

Defined cases: a null or empty text has no features and gets the intercept's
score; rows without a label (or a null one) are not learnt from; of several
labels of one document the highest counts; a null ``doc_id`` is scored and
never held out or learnt from; with no labelled rows all scores are below 0.5.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Rolling, content, mixed, pieces, text_bytes

BITS = 18
ROWS_PER_CLASS = 3000
EPOCHS = 6
#: Bytes of a longer word that stand for its inflections.
STEM = 6
SCORE_SCHEMA = "doc_id long, margin double"

#: Bytes of a word: ASCII letters and digits, and all bytes of other characters.
_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def features(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of every word, stem, neighbour pair and skip pair; a row may name a feature twice."""
    inside = _INSIDE[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[starts] = True
    first = inside & (edge[:-1] | ~np.concatenate([[False], inside[:-1]]))
    last = inside & (edge[1:] | ~np.concatenate([inside[1:], [False]]))
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    rolling = Rolling(_LOWER[raw])
    word = rolling.of(s, e)
    row = np.searchsorted(starts, s, "right") - 1
    long = np.flatnonzero(e - s > STEM)
    stem = mixed(rolling.of(s[long], s[long] + STEM) ^ np.uint64(0x165667B1))
    rows, hashes = [row, row[long]], [word, stem]
    for gap, salt in ((1, 0x51ED270B), (2, 0x2545F491)):
        same = row[:-gap] == row[gap:]
        pair = word[:-gap] * np.uint64(0x9E3779B97F4A7C15) + word[gap:] + np.uint64(salt)
        rows.append(row[:-gap][same])
        hashes.append(mixed(pair[same]))
    return np.concatenate(rows), (np.concatenate(hashes) >> np.uint64(64 - BITS)).astype(np.int64)


class Ftrl:
    """Weights by FTRL-proximal with per-coordinate rates, L1 and L2; the intercept is not regularised by L1."""

    def __init__(self, alpha: float = 1.0, beta: float = 1.0, l1: float = 6.0, l2: float = 0.1):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(np.arange(len(self.z))[at] == 1 << BITS, 0.0, self.l1)
        return np.where(np.abs(z) <= l1, 0.0,
                        -(z - np.sign(z) * l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, at: np.ndarray, label: int) -> None:
        at = np.append(at, 1 << BITS)
        w = self.weights(at)
        g = 1 / (1 + math.exp(-max(-35.0, min(35.0, float(w.sum()))))) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def fit(sample: DataFrame) -> tuple[np.ndarray, float]:
    """Weights and intercept from ``sample`` (bucket, text, label): one task reads
    its rows, whose number the caller bounds, in the order of ``bucket``."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for b in batches:
            for part in pieces([b], "text"):
                raw, starts = text_bytes(part.column("text"))
                row, feature = features(raw, starts)
                key = np.unique(row << BITS | feature)
                row, feature = key >> BITS, (key & ((1 << BITS) - 1)).astype(np.int32)
                cuts = np.searchsorted(row, np.arange(part.num_rows + 1))
                rows += [(feature[a:z], y) for a, z, y in
                         zip(cuts, cuts[1:], part.column("label").to_pylist(), strict=False)]
        model = Ftrl()
        for _ in range(EPOCHS):
            for at, label in rows:
                model.learn(at, label)
        w = model.weights(slice(None))
        keep = np.flatnonzero(w)
        yield pa.record_batch([pa.array(keep, pa.int32()), pa.array(w[keep], pa.float64())], ["at", "weight"])

    found = (sample.repartition(1).sortWithinPartitions("bucket", "text", "label")
             .mapInArrow(train, "at int, weight double").collect())  # 2**BITS rows at most
    w = np.zeros(1 << BITS, np.float32)
    intercept = 0.0
    for at, weight in found:
        if at == 1 << BITS:
            intercept = weight
        else:
            w[at] = weight
    return w, intercept


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, label) that may be learnt from."""
    return (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
            .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label")))


def train_model(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> tuple[np.ndarray, float]:
    known = labelled(docs, labels)
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}  # two rows
    picked = None
    for label in (0, 1):
        some = (known.where(F.col("label") == label).withColumn("bucket", F.xxhash64("doc_id"))
                .orderBy("bucket", "doc_id").limit(rows_per_class))
        picked = some if picked is None else picked.unionByName(some)
    # 2 * rows_per_class ids, whatever the input
    sample = (docs.select("doc_id", content().alias("text"))
              .join(F.broadcast(picked), "doc_id").select("bucket", "text", "label"))
    # a document id that is repeated brings its rows along; the first of them are enough
    sample = sample.orderBy("bucket", "text").limit(4 * rows_per_class)
    return fit(sample) if counts else (np.zeros(1 << BITS, np.float32), -1.0)


def score(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``."""
    weights = docs.sparkSession.sparkContext.broadcast(model[0])
    intercept = model[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value
        for part in pieces(batches, "text"):
            raw, starts = text_bytes(part.column("text"))
            row, feature = features(raw, starts)
            bears = w[feature] != 0
            key = np.unique(row[bears] << BITS | feature[bears])
            margin = np.bincount(key >> BITS, w[key & ((1 << BITS) - 1)], part.num_rows) + intercept
            yield pa.record_batch([part.column("doc_id"), pa.array(margin, pa.float64())], ["doc_id", "margin"])

    out = docs.select("doc_id", content().alias("text")).mapInArrow(run, SCORE_SCHEMA)
    value = 1 / (1 + F.exp(-F.col("margin")))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), value.alias("score"),
                      (value >= 0.5).cast("int").alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> DataFrame:
    return score(docs, train_model(docs, labels, rows_per_class))
