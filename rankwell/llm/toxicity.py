"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Labelled texts are dealt into shards; each shard is one online pass after another with
per-coordinate rates and L1 sparsity, and the shards' weights are averaged. What is left is a
short list of buckets and weights, small enough for every worker whatever the data's size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankwell.llm.common import as_bytes, hashed_words, slices, stored, text_batches, with_struct

# Words, pairs of neighbours and pairs around one or two words share 2 ** BUCKET_BITS buckets.
BUCKET_BITS, SKIPS = 22, (1, 2, 3)
# At most TRAIN_ROWS labelled rows train the model, chosen by a hash of their id and dealt into
# shards of about SHARD_ROWS.
TRAIN_ROWS, SHARD_ROWS, EPOCHS = 48_000, 6_000, 10
ALPHA, BETA, L1, L2 = 1.0, 1.0, 8.0, 0.0
SLICE_BYTES = 1_000_000
BIAS = -1
_LEFT, _RIGHT = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x9FB21C651E98DF25)


def features(texts: list[bytes], bits: int = BUCKET_BITS) -> tuple[np.ndarray, np.ndarray]:
    """(text number, bucket) of every word, pair and skip-pair, repeats included."""
    words, owner, *_ = hashed_words(texts)
    owners, found = [owner], [words]
    with np.errstate(over="ignore"):
        for skip in SKIPS:
            whole = owner[skip:] == owner[:-skip]
            pair = (words[:-skip] * _LEFT + words[skip:] + np.uint64(skip)) * _RIGHT
            owners.append(owner[skip:][whole])
            found.append((pair ^ (pair >> np.uint64(29)))[whole] * _LEFT)
    return np.concatenate(owners), (np.concatenate(found) >> np.uint64(64 - bits)).astype(np.int64)


def sets(texts: list[bytes], bits: int = BUCKET_BITS) -> list[np.ndarray]:
    """The distinct buckets of each text, sorted."""
    owner, buckets = features(texts, bits)
    both = np.unique((owner << bits) | buckets)
    cuts = np.searchsorted(both >> bits, np.arange(len(texts) + 1))
    both &= (1 << bits) - 1
    return [both[a:b] for a, b in zip(cuts, cuts[1:])]


class Ftrl:
    """Online logistic regression on binary features; the bias is not regularised."""

    def __init__(self, size: int):
        self.z, self.n = np.zeros(size), np.zeros(size)
        self.bias_z = self.bias_n = 0.0

    def bias(self) -> float:
        return -self.bias_z / ((BETA + np.sqrt(self.bias_n)) / ALPHA)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z = self.z[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2)

    def learn(self, at: np.ndarray, label: int) -> None:
        w, b = self.weights(at), self.bias()
        g = sigmoid(w.sum() + b) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g
        self.bias_z += g - (np.sqrt(self.bias_n + g * g) - np.sqrt(self.bias_n)) / ALPHA * b
        self.bias_n += g * g


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _fit(rows: pa.Table) -> pa.Table:
    """Weights of one shard: (bucket, weight) without zeros, the bias as bucket -1."""
    rows = rows.sort_by([("order", "ascending")])
    labels = rows.column("label").to_pylist()
    examples: list[np.ndarray] = []
    for chunk in rows.column("text").chunks:
        for _, part in slices(as_bytes(chunk), SLICE_BYTES):
            examples += [s.astype(np.int32) for s in sets(part.to_pylist())]
    model = Ftrl(1 << BUCKET_BITS)
    for _ in range(EPOCHS):
        for at, label in zip(examples, labels):
            model.learn(at, label)
    seen = np.flatnonzero(model.n)
    w = model.weights(seen)
    at, w = seen[w != 0], w[w != 0]
    return pa.table({"bucket": pa.array(np.append(at, BIAS), pa.int64()), "weight": pa.array(np.append(w, model.bias()))})


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic") -> dict[int, float]:
    """Weights by bucket, learned from labelled rows; the driver gets at most 2 ** BUCKET_BITS + 1.

    ``TRAIN_ROWS`` labelled rows at most are used, a fixed choice by hashes of id and text; equal rows
    count as one. Ids and text hashes of them are sent to all workers, the texts stay in their shards.
    Rows without id, text or label teach nothing. Without rows the weights are empty.
    """
    text_batches(docs.sparkSession)
    told = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label}`").cast("int").alias("label"))
    told = told.filter("id is not null and label is not null").groupBy("id").agg(F.max("label").alias("label"))
    order = F.xxhash64("id")
    first = F.broadcast(told.withColumn("order", order).orderBy("order", "id").limit(TRAIN_ROWS))
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text")).filter("text is not null")
    texts = texts.withColumn("mark", F.xxhash64("text"))
    # An id may have many texts, so the rows are chosen among (id, text hash) pairs.
    pairs = texts.join(first, "id").select("order", "id", "mark", "label").distinct()
    chosen = stored(pairs.orderBy("order", "id", "mark").limit(TRAIN_ROWS))
    shards = -(-chosen.count() // SHARD_ROWS)
    if not shards:
        return {}
    rows = texts.join(F.broadcast(chosen), ["id", "mark"])
    # Copies of a row are folded in the map tasks.
    rows = rows.groupBy("order", "id", "mark", "label").agg(F.first("text").alias("text"))
    rows = rows.select("text", "label", F.xxhash64("order", "mark").alias("order"))
    dealt = rows.withColumn("shard", F.pmod("order", F.lit(shards)))
    found = dealt.groupBy("shard").applyInArrow(_fit, "bucket long, weight double")
    means = found.groupBy("bucket").agg(F.sum("weight").alias("weight"))
    return {r.bucket: r.weight / shards for r in means.collect()}


def score(docs: DataFrame, weights: dict[int, float], text: str = "text") -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 from 0.5 up).

    Each distinct word, pair or skip-pair of a text counts once. Null and empty texts have the
    score of the bias alone. Input columns of these names are replaced.
    """
    text_batches(docs.sparkSession)
    at = np.array(sorted(b for b in weights if b != BIAS), np.int64)
    shared = docs.sparkSession.sparkContext.broadcast((at, np.array([weights[b] for b in at.tolist()])))
    bias = weights.get(BIAS, 0.0)

    @F.arrow_udf("score double, predicted int")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        at, values = shared.value
        known = np.zeros(1 << BUCKET_BITS, bool)
        known[at] = True
        for texts in batches:
            sums = [np.zeros(0)]
            for _, part in slices(as_bytes(texts), SLICE_BYTES):
                owner, buckets = features(part.to_pylist())
                hit = known[buckets]
                both = np.unique((owner[hit] << BUCKET_BITS) | buckets[hit])
                w = values[np.searchsorted(at, both & ((1 << BUCKET_BITS) - 1))] if len(both) else np.zeros(0)
                sums.append(np.bincount(both >> BUCKET_BITS, w, len(part)))
            p = sigmoid(np.concatenate(sums) + bias)
            yield pa.StructArray.from_arrays([pa.array(p), pa.array((p >= 0.5).astype(np.int32))], ["score", "predicted"])

    return with_struct(docs, scored(docs[f"`{text}`"]))


def held_out(docs: DataFrame, id_col: str = "doc_id", folds: int = 5) -> Column:
    """Whether crc32 of the id as text is divisible by ``folds``; false for null ids."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(False))
