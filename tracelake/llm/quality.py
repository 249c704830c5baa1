"""Quality classifier: learned vectors of hashed words and character n-grams, averaged per text, under a softmax.

Trained by stochastic gradient descent in numpy on a bounded sample of labelled texts. The softmax of an average is linear
in the vectors, so for scoring each bucket's vector is folded with the output layer into one number.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.functions.ship import map_arrow
from tracelake.llm.common import SPACES, Rolling, cut, held_out, joined, lookup, mixed, pieces, spans, training_rows

#: Buckets of the hashed vectors (log2), their length, the sizes of the n-grams in bytes, and how far apart paired words are.
LOG_BUCKETS, DIM, GRAMS, APART = 17, 8, (3, 4), (1, 2, 3)
#: Bound of the training sample: labelled texts, learnt from in whole, as shares by bucket.
TRAIN_TEXTS = 5000
THRESHOLD = 0.3


def features(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """For words, word pairs and each n-gram size: the buckets, and where each row's begin (the end last).

    N-grams may touch white space with their first or last byte, but not within, so that they are parts of words. None goes
    on into the next row. A pair is
    known by the difference of its words' hashes, so that all pairs of equal words share a bucket.
    """
    data, offsets = joined(column)
    space = lookup(SPACES)[data]
    rolling = Rolling(Rolling.BYTES[data])
    starts, ends = spans(data, lookup(SPACES))
    words, first = rolling.spans(starts, ends), np.searchsorted(starts, offsets)
    found = [(_bucket(words, 0), first)]
    row = np.repeat(np.arange(len(column)), np.diff(first))
    for n in APART:
        at = np.flatnonzero(row[:-n] == row[n:]) if len(row) > n else np.zeros(0, np.int64)
        found.append((_bucket(words[at + n] - words[at], -n), np.searchsorted(at, first)))
    before = np.concatenate(([0], np.cumsum(space)))
    for n in GRAMS:
        count = max(0, len(data) - n + 1)
        inside = before[n - 1 : n - 1 + count] == before[1 : 1 + count]
        for k in range(1, n):
            crossing = offsets[1:-1] - k
            inside[crossing[(crossing >= 0) & (crossing < count)]] = False
        at = np.flatnonzero(inside)
        found.append((_bucket(rolling.grams(n)[at], n), np.searchsorted(at, offsets)))
    return found


def _bucket(hashes: np.ndarray, kind: int) -> np.ndarray:
    return (mixed(hashes + np.uint64(kind % (1 << 64))) >> np.uint64(64 - LOG_BUCKETS)).astype(np.int32)


def _training_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's buckets and their shares of its features, as the bytes of 32-bit numbers."""
    for piece in pieces(batches):
        found, ids, shares = features(piece.column("text")), [], []
        for i in range(piece.num_rows):
            own, counts = np.unique(np.concatenate([ids_[at[i] : at[i + 1]] for ids_, at in found]), return_counts=True)
            ids.append(own.astype(np.int32).tobytes())
            shares.append((counts / max(1, counts.sum())).astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays([piece.column("y"), piece.column("hash"), pa.array(ids, pa.binary()), pa.array(shares, pa.binary())], ["y", "hash", "ids", "shares"])


@dataclass
class Model:
    """The log odds of label 1 by bucket (to be averaged), their constant, and the share of 1 for texts without features."""

    weights: np.ndarray
    bias: float
    empty: float

    def scores(self, column: pa.Array) -> np.ndarray:
        total, count = np.zeros(len(column)), np.zeros(len(column))
        for ids, at in features(column):
            sums = np.concatenate(([0.0], np.cumsum(self.weights[ids], dtype=np.float64)))
            total += sums[at[1:]] - sums[at[:-1]]
            count += np.diff(at)
        odds = total / np.maximum(count, 1) + self.bias
        return np.where(count > 0, 1 / (1 + np.exp(-odds)), self.empty)


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = 6, rate: float = 1.0, seed: int = 7) -> Model:
    """Stochastic gradient descent over (label, buckets, shares) rows, with a rate that falls to zero. No rows, or one label: a constant."""
    labels = np.array([y for y, *_ in rows], np.int64)
    empty = (labels.sum() + 1) / (len(labels) + 2)
    if len(np.unique(labels)) < 2:
        return Model(np.zeros(1 << LOG_BUCKETS, np.float32), float(np.log(empty / (1 - empty))), float(empty))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (1 << LOG_BUCKETS, DIM)).astype(np.float32)
    output, bias = np.zeros((DIM, 2)), np.log([1 - empty, empty])
    steps, done = epochs * len(rows), 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            _, ids, share = rows[i]
            done += 1
            if not len(ids):
                continue
            lr = rate * (1 - done / steps)
            old = vectors[ids]
            mean = share @ old
            out = mean @ output + bias
            out = np.exp(out - out.max())
            out /= out.sum()
            out[labels[i]] -= 1
            back = output @ out
            output -= lr * np.outer(mean, out)
            bias -= 0.1 * lr * out
            vectors[ids] = old - np.outer(share, (lr * 20 * back).astype(np.float32))
    return Model((vectors @ (output[:, 1] - output[:, 0])).astype(np.float32), float(bias[1] - bias[0]), float(empty))


def _trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The model of all rows of the batches, as one row."""
    rows = []
    for batch in batches:
        y, text_hash, ids, shares = (batch.column(c) for c in ("y", "hash", "ids", "shares"))
        for i in range(batch.num_rows):
            rows.append((y[i].as_py(), text_hash[i].as_py(), np.frombuffer(ids[i].as_py(), np.int32), np.frombuffer(shares[i].as_py(), np.float32)))
    model = train([(y, ids, shares) for y, _, ids, shares in sorted(rows, key=lambda r: r[:2])])
    yield pa.RecordBatch.from_arrays([pa.array([model.weights.tobytes()], pa.binary()), pa.array([model.bias]), pa.array([model.empty])], ["weights", "bias", "empty"])


def fit(docs: DataFrame, labels: DataFrame, most: int = TRAIN_TEXTS) -> Model:
    """A model from at most `most` labelled rows outside the held-out fold; see training_rows.

    One task learns from the bounded sample, so that a lost executor costs a retry and the driver gets the weights alone.
    """
    sample = cut(map_arrow(training_rows(docs, labels, "quality", most), _training_features, "y int, hash long, ids binary, shares binary"))
    made = map_arrow(sample.coalesce(1), _trained, "weights binary, bias double, empty double").first()
    return Model(np.frombuffer(made.weights, np.float32), made.bias, made.empty) if made else train([])


def _scored(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            rest = [c for c in piece.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in rest), pa.array(model.value.scores(piece.column("text")))], [*rest, "score"])

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of docs, by its text alone.

    Null and empty texts get the share of label 1 in the sample. Repeated rows and null ids come out as they come in.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    scored = map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), _scored(shared), "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def _passing(model, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            yield piece.filter(pa.array(model.value.scores(piece.column("text")) >= THRESHOLD)).select(columns)

    return run


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs whose score reaches THRESHOLD, with all columns; made in one pass over docs."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return map_arrow(docs, _passing(shared, docs.columns), docs.schema)
