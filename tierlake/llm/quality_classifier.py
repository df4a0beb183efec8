"""Quality scores: logistic regression on hashed word n-grams, trained with FTRL-proximal updates.

Features of a text are the unigrams and bigrams of its words, of the words' shapes (letters as a or A, digits
as 0, runs shortened, signs kept), and marks for words equal to the one before; they are hashed into 2**BITS
slots and scaled to unit length. Training reads a bounded sample of the labelled rows, those with the lowest
hash of their id, at most `sample` (a parameter), and goes over them `epochs` times in hash order in one task:
its input is bounded by the sample, whatever the corpus. The weights have a fixed size (1 MB). Scoring is one
pass over all texts, a sparse dot product per text, without a shuffle.

Defined cases: a null or empty text has no features and gets the score of the bias; labels that are null, not 0
or 1, or contradict each other for one id are left out; without labelled rows every score is 0.5; repeated rows
get equal scores; an empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import LOWER, U64, Words, byte_sums, chunks, map_texts, mix

BITS = 18
SHAPE = np.arange(256, dtype=np.uint8)
SHAPE[[*range(97, 123), *range(128, 256)]] = ord("a")
SHAPE[65:91] = ord("A")
SHAPE[48:58] = ord("0")
RUNS = np.zeros(256, bool)
RUNS[[ord("a"), ord("A"), ord("0")]] = True


@dataclass(frozen=True)
class Training:
    """sample: most labelled rows to train on. alpha, beta, l1, l2: of the updates."""

    sample: int = 12_000
    epochs: int = 3
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.05


def _features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, slot, value) of each feature of each text, ordered by row and slot."""
    words = Words(LOWER[data], offsets)
    word, row = words.hashes(), words.row
    plain = SHAPE[data]
    keep = np.ones(len(data), bool)
    keep[1:] = (plain[1:] != plain[:-1]) | ~RUNS[plain[1:]]
    keep[offsets[:-1][offsets[:-1] < len(data)]] = True
    kept = np.zeros(len(data) + 1, np.int64)
    np.cumsum(keep, out=kept[1:])
    shape = Words(plain[keep], kept[offsets]).hashes()
    two = row[1:] == row[:-1] if len(row) else np.zeros(0, bool)
    parts = [(row, mix(word + U64(1))), (row, mix(shape + U64(2)))]
    if len(row):
        parts.append((row[1:][two], mix(word[1:] * U64(3) + word[:-1])[two]))
        parts.append((row[1:][two], mix(shape[1:] * U64(5) + shape[:-1])[two]))
        parts.append((row[1:][two], np.where(word[1:] == word[:-1], U64(11), U64(13))[two]))
    rows = np.concatenate([p[0] for p in parts]).astype(np.int64)
    slots = (np.concatenate([p[1] for p in parts]) & U64(2**BITS - 1)).astype(np.int64)
    key, count = np.unique(rows << BITS | slots, return_counts=True)
    rows = key >> BITS
    value = np.sqrt(count)
    length = np.sqrt(np.bincount(rows, value**2, len(offsets) - 1))
    return rows, key & (2**BITS - 1), value / length[rows]


def _labelled_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, to, data, offsets in chunks(batch.column(0)):
            rows, slots, values = _features(data, offsets)
            cut = np.searchsorted(rows, np.arange(to - at + 1))
            pieces = [(slots[a:b].astype(np.int32).tobytes(), values[a:b].astype(np.float32).tobytes()) for a, b in zip(cut, cut[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).slice(at, to - at), batch.column(2).slice(at, to - at)]
                + [pa.array([p[i] for p in pieces], pa.binary()) for i in (0, 1)],
                names=["place", "label", "slots", "values"],
            )


def _trainer(training: Training):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [
            (np.frombuffer(s, np.int32), np.frombuffer(v, np.float32).astype(np.float64), y)
            for b in batches for s, v, y in zip(*(b.column(i).to_pylist() for i in (2, 3, 1)))
        ]
        z, n = np.zeros(2**BITS + 1), np.zeros(2**BITS + 1)
        t = training

        def weights(at) -> np.ndarray:
            over = np.abs(z[at]) - t.l1
            return np.where(over > 0, -np.sign(z[at]) * over / ((t.beta + np.sqrt(n[at])) / t.alpha + t.l2), 0.0)

        for _ in range(t.epochs):
            for slots, values, y in rows:
                at = np.append(slots, 2**BITS)  # the last slot is the bias
                x = np.append(values, 1.0)
                w = weights(at)
                p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
                g = (p - y) * x
                z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / t.alpha * w
                n[at] += g * g
        made = weights(slice(None)).astype(np.float32).tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], names=["weights"])

    return run


def train(docs: DataFrame, labels: DataFrame, usable: Column, label: str, training: Training = Training()) -> np.ndarray:
    """Weights from the labelled documents for which usable, an expression on doc_id, holds."""
    known = (
        labels.where(usable & F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.min(label).alias("label"), F.max(label).alias("_other"))
        .where("label = _other")
        .select(F.col("doc_id").alias("_id"), F.col("label").cast("int"), F.xxhash64("doc_id").alias("place"))
        .orderBy("place", "_id").limit(training.sample)
    )
    # At most training.sample rows of 20 bytes: the texts stay where they are.
    sample = docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("_id"))
    rows = sample.select("text", "place", "label").mapInArrow(
        _labelled_features, "place bigint, label int, slots binary, values binary"
    )
    made = (
        rows.repartition(1).sortWithinPartitions("place", "slots")
        .mapInArrow(_trainer(training), "weights binary").first()
    )
    return np.frombuffer(made[0], np.float32) if made else np.zeros(2**BITS + 1, np.float32)


def score(docs: DataFrame, weights: np.ndarray, threshold: float = 0.7) -> DataFrame:
    """One row per document: doc_id, held out or not is the caller's; score and predicted class."""

    def work(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
        rows, slots, values = _features(data, offsets)
        total = np.bincount(rows, values * weights[slots], len(offsets) - 1) + weights[2**BITS]
        p = 1 / (1 + np.exp(-np.clip(total, -35, 35)))
        return {"score": p, "predicted": (p >= threshold).astype(np.int32)}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_texts(docs, "text", ["doc_id"], f"doc_id {kind}, score double, predicted int", work)
