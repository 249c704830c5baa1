"""Toxicity by multiple-instance learning: a text is a bag of sentences, and toxic if any of them is.

A sentence's probability is logistic in the sum of its hashed words' weights; a text's is the noisy-or of its sentences'.
The weights are learnt from document labels alone, by gradient steps in numpy, and then say which sentences offend.
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

LOG_BUCKETS = 18
#: A word counts by itself and by its beginnings of so many bytes (a shorter word by itself in their place).
PREFIXES = (4, 5, 6)
#: Bound of the training sample: labelled texts, learnt from in whole.
TRAIN_TEXTS = 8000
#: A bucket has to occur in so many texts of the sample to get a weight, and to be so many times (log) as frequent in toxic ones.
LEAST_TEXTS, LEAST_RATIO = 6, 1.0
THRESHOLD = 0.5
STOPS = b".!?\n"
_APART = lookup(SPACES + b".!?,;:\"'()[]{}|#*$%&<>~=+/\\-_")


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each word's buckets (one column each) and sentence; each sentence's row; and where in its row's bytes it begins.

    Words are lower-cased runs without white space or punctuation; sentences end with . ! ? or a newline, and only those
    with a word count.
    """
    data, offsets = joined(column)
    upper = (data >= 65) & (data <= 90)
    data = data + (upper.astype(np.uint8) << 5)
    starts, ends = spans(data, _APART)
    rolling = Rolling(Rolling.BYTES[data])
    hashes = np.stack([rolling.spans(starts, ends), *(rolling.spans(starts, np.minimum(ends, starts + n)) + np.uint64(n) for n in PREFIXES)], axis=1)
    number = np.cumsum(lookup(STOPS)[data])[starts] if len(starts) else np.zeros(0, np.int64)
    first = np.flatnonzero(np.diff(number, prepend=-1))
    sentence = np.cumsum(np.diff(number, prepend=-1) != 0) - 1
    row = np.searchsorted(offsets, starts[first], side="right") - 1
    return (mixed(hashes) >> np.uint64(64 - LOG_BUCKETS)).astype(np.int32), sentence, row, starts[first] - offsets[row]


def _texts_with(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts of each label a bucket occurs, summed by piece."""
    for piece in pieces(batches):
        words, sentence, row, _ = features(piece.column("text"))
        pairs = np.unique(row[sentence][:, None] << LOG_BUCKETS | words) if len(words) else np.zeros(0, np.int64)
        toxic = piece.column("y").to_numpy(zero_copy_only=False)[pairs >> LOG_BUCKETS] == 1
        buckets, inverse = np.unique(pairs & ((1 << LOG_BUCKETS) - 1), return_inverse=True)
        counts = [np.bincount(inverse, weights=x, minlength=len(buckets)).astype(np.int64) for x in (~toxic, toxic)]
        yield pa.RecordBatch.from_arrays([pa.array(buckets.astype(np.int32)), *map(pa.array, counts)], ["bucket", "clean", "toxic"])


def _telling(known: np.ndarray):
    """Of each text: its label, the number of its sentences, and its known buckets with the sentence that each is in (from 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            words, sentence, row, _ = features(piece.column("text"))
            sizes = np.bincount(row, minlength=piece.num_rows)
            word, kind = np.nonzero(known[words])
            of = sentence[word]
            at = np.searchsorted(row[of], np.arange(piece.num_rows + 1)).astype(np.int32)
            local = of - (np.cumsum(sizes) - sizes)[row[of]]
            lists = [pa.ListArray.from_arrays(pa.array(at), pa.array(x.astype(np.int32))) for x in (words[word, kind], local)]
            yield pa.RecordBatch.from_arrays([piece.column("y"), piece.column("hash"), pa.array(sizes.astype(np.int32)), *lists], ["y", "hash", "n", "ids", "of"])

    return run


@dataclass
class Sample:
    """What is learnt from: (label, buckets, their sentences, number of sentences) of each text, and the buckets' log ratios, 0 for unknown ones."""

    texts: list[tuple[int, np.ndarray, np.ndarray, int]]
    ratios: np.ndarray
    n_clean: int
    n_toxic: int


def sample_of(rows: DataFrame) -> Sample:
    """From rows (text, y, hash) of training texts: two passes over their whole texts.

    The first counts the texts of each label that have a bucket, which finds the buckets that tell; the second brings only
    those to the driver, with their sentences.
    """
    rows = cut(rows)
    totals = rows.agg(F.count_if(F.col("y") != 1), F.count_if(F.col("y") == 1)).first()
    share = lambda c, n: F.log((F.col(c) + 1) / F.lit(n + 2.0))
    counts = map_arrow(rows, _texts_with, "bucket int, clean long, toxic long").groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    told = counts.withColumn("ratio", share("toxic", totals[1]) - share("clean", totals[0]))
    found = told.where((F.col("clean") + F.col("toxic") >= LEAST_TEXTS) & (F.col("ratio") > LEAST_RATIO)).select("bucket", "ratio").toArrow()
    ratios = np.zeros(1 << LOG_BUCKETS)
    ratios[found.column("bucket").to_numpy()] = found.column("ratio").to_numpy()
    gathered = map_arrow(rows, _telling(ratios > 0), "y int, hash long, n int, ids array<int>, of array<int>").toArrow()
    texts = []
    for batch in gathered.to_batches():
        y, hashes, n = (batch.column(c).to_pylist() for c in ("y", "hash", "n"))
        texts += [(h, y[i], ids.values.to_numpy(), of.values.to_numpy(), n[i]) for i, (h, ids, of) in enumerate(zip(hashes, batch.column("ids"), batch.column("of")))]
    return Sample([t[1:] for t in sorted(texts, key=lambda t: (t[1], t[0]))], ratios, *totals)


@dataclass
class Model:
    """Weights by bucket, the constant of a sentence, and the probability of a text without sentences (of any text, if constant)."""

    weights: np.ndarray
    bias: float
    empty: float
    constant: bool = False

    def sentences(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probability, row and byte offset of each sentence."""
        words, sentence, row, begins = features(column)
        odds = np.bincount(sentence, weights=self.weights[words].sum(axis=1), minlength=len(row)) + self.bias
        return 1 / (1 + np.exp(-np.clip(odds, -40, 40))), row, begins

    def scores(self, column: pa.Array) -> np.ndarray:
        if self.constant:
            return np.full(len(column), self.empty)
        p, row, _ = self.sentences(column)
        none = np.bincount(row, weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=len(column))
        return np.where(np.bincount(row, minlength=len(column)) > 0, -np.expm1(none), self.empty)


def train(sample: Sample, epochs: int = 15, rate: float = 0.2, batch: int = 64, seed: int = 7) -> Model:
    """Adaptive gradient steps on the noisy-or's log likelihood.

    Only buckets that are e times as frequent in toxic texts as in others take part; each starts at, and its steps are
    scaled by, that log ratio (of smoothed shares of texts), so that words of a few texts are not learnt by heart. Without
    texts of both labels every text, however long, gets the same score, and no sentence offends.
    """
    size = 1 << LOG_BUCKETS
    share = (sample.n_toxic + 1) / (sample.n_clean + sample.n_toxic + 2)
    if not sample.n_clean or not sample.n_toxic:
        return Model(np.zeros(size, np.float32), -40.0, float(share), True)
    scale = sample.ratios
    texts = [t for t in sample.texts if t[3]]
    weights, squares, bias, bias_square = scale.copy(), np.full(size, 1e-2), -8.0, 1e-2
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), batch):
            some = [texts[i] for i in order[at : at + batch]]
            sizes = np.array([n for *_, n in some])
            base = np.cumsum(sizes) - sizes
            of = np.concatenate([own + b for (_, _, own, _), b in zip(some, base)])
            ids = np.concatenate([own for _, own, _, _ in some])
            text = np.repeat(np.arange(len(some)), sizes)
            p = 1 / (1 + np.exp(-np.clip(np.bincount(of, weights=weights[ids], minlength=len(text)) + bias, -30, 30)))
            none = np.exp(np.bincount(text, weights=np.log1p(-p)))
            toxic = np.array([y for y, *_ in some]) == 1
            grad = p * np.where(toxic, -none / np.maximum(1 - none, 1e-9), 1.0)[text]
            used, inverse = np.unique(ids, return_inverse=True)
            step = np.bincount(inverse, weights=grad[of], minlength=len(used))
            squares[used] += step * step
            weights[used] -= rate * scale[used] * step / np.sqrt(squares[used])
            total = float(grad.sum())
            bias_square += total * total
            bias -= rate * total / np.sqrt(bias_square)
    return Model(weights.astype(np.float32), float(bias), float(share))


def fit(docs: DataFrame, labels: DataFrame, most: int = TRAIN_TEXTS) -> Model:
    """A model from at most `most` labelled rows outside the held-out fold; see training_rows."""
    return train(sample_of(training_rows(docs, labels, "toxic", most)))


def _scored(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            column = piece.column("text")
            p, row, begins = model.value.sentences(column)
            hot = p >= THRESHOLD
            at = np.searchsorted(row[hot], np.arange(piece.num_rows + 1))
            spots = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(begins[hot]))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(model.value.scores(column)), spots], ["doc_id", "score", "offending"])

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted, offending) of every row of docs, by its text alone.

    offending: where the sentences begin (bytes of UTF-8) whose own probability reaches THRESHOLD. Null and empty texts get
    the share of label 1 in the sample and offend nowhere. Repeated rows and null ids come out as they come in.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    scored = map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), _scored(shared), "doc_id long, score double, offending array<long>")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "offending")
