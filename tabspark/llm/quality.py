"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader updates.

A text's features are its words and punctuation runs and the pairs of neighbours, hashed into 2^BITS slots, with values
log(1 + count) scaled to length 1, and a constant. Labelled rows are dealt to SHARDS models, which see them in the order of a
hash; the mean of their weights is the classifier. A score is a sparse dot product through the logistic function.

Defined results: null and empty texts have the constant feature only; without any label every score is 0.5; labels of a
document that disagree are averaged and rounded up, null labels are ignored; repeated rows are scored one by one; labels of absent
documents have no effect; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tabspark.llm.common import remainder, share, ship, slices

BITS, SHARDS = 18, 4
TOKEN = re.compile(r"\w+|[^\w\s]+")
#: Hashes of words that a worker keeps at hand.
REMEMBERED = 150_000
PAIR = np.uint32(0x85EBCA6B)


class Features:
    """Slots and values of a text."""

    def __init__(self, bits: int = BITS):
        self.bits, self.known = bits, {}

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        words = TOKEN.findall(text) if text else []
        if len(self.known) > REMEMBERED:
            self.known = {}
        known = self.known
        for w in set(words).difference(known):
            known[w] = zlib.crc32(w.encode("utf-8", "surrogatepass"))
        h = np.fromiter(map(known.__getitem__, words), "u4", len(words))
        both = np.concatenate([h, (h[:-1] * PAIR ^ h[1:]) * PAIR if len(h) > 1 else h[:0]]) >> np.uint32(32 - self.bits)
        slots, counts = np.unique(both, return_counts=True)
        values = np.log1p(counts)
        values /= np.sqrt((values * values).sum()) or 1.0
        return np.append(slots, 1 << self.bits).astype("i8"), np.append(values, 1.0)


class FollowTheRegularisedLeader:
    """Per-coordinate updates with l1 and l2 penalties."""

    def __init__(self, size: int, rate: float = 4.0, beta: float = 1.0, l1: float = 0.01, l2: float = 0.01):
        self.z, self.n = np.zeros(size), np.zeros(size)
        self.rate, self.beta, self.l1, self.l2 = rate, beta, l1, l2

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) > self.l1, (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.rate + self.l2), 0.0)

    def see(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = (logistic(float(w @ x)) - label) * x
        grown = self.n[at] + g * g
        self.z[at] += g - (np.sqrt(grown) - np.sqrt(self.n[at])) / self.rate * w
        self.n[at] = grown


def logistic(v: float) -> float:
    return 1 / (1 + np.exp(-max(-35.0, min(35.0, v))))


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
          rows: int = 20_000, epochs: int = 5, bits: int = BITS) -> np.ndarray:
    """Weights (2^bits and the constant) from about `rows` labelled documents at most, drawn by a hash of the key."""
    ship(docs.sparkSession)
    marked = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg((F.avg(label) >= 0.5).cast("int").alias("label"))
    n = marked.count()
    drawn = marked.filter(share("key", 17) < rows / max(n, 1)).withColumn("order", F.xxhash64("key", F.lit(5)))
    frame = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(drawn), "key")
    frame = frame.withColumn("shard", F.pmod("order", F.lit(SHARDS)).cast("int")).select("shard", "order", "text", "label")
    size = (1 << bits) + 1

    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["order", "text"], kind="stable")
        features, model = Features(bits), FollowTheRegularisedLeader(size)
        seen = [(*features.of(t), y) for t, y in zip(pdf["text"], pdf["label"])]
        for _ in range(epochs):
            for at, x, y in seen:
                model.see(at, x, y)
        return pd.DataFrame({"rows": [len(pdf)], "w": [model.weights().astype("f4").tobytes()]})

    parts = frame.groupBy("shard").applyInPandas(train, "rows bigint, w binary").collect()
    total = sum(r["rows"] for r in parts)
    return sum((np.frombuffer(r["w"], "f4").astype("f8") * (r["rows"] / total) for r in sorted(parts, key=lambda r: bytes(r["w"]))), np.zeros(size))


def score(docs: DataFrame, weights: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, score (0 to 1) and predicted of every row; one pass, no shuffle."""
    ship(docs.sparkSession)
    shared, bits = docs.sparkSession.sparkContext.broadcast(weights), int(np.log2(len(weights) - 1))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, w = Features(bits), shared.value
        for rows in batches:
            for part in slices(rows, "text"):
                got = [logistic(float(w[at] @ x)) for at, x in map(features.of, part.column("text").to_pylist())]
                columns = [part.column("key"), pa.array(got, pa.float64()), pa.array([int(s >= 0.5) for s in got], pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, ["key", "score", "predicted"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(work, f"key {kind}, score double, predicted int").withColumnRenamed("key", key)


def held_out(key: str = "doc_id"):
    """Documents whose labels are never learned from: crc32 of the id as text leaves 1 mod 3 (or the id is null)."""
    return F.coalesce(remainder(key, 3) == 1, F.lit(True))


def op10_quality(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    weights = learn(docs, labels.filter(~held_out()))
    return score(docs, weights).select("doc_id", held_out().alias("held_out"), "score", "predicted")
