"""Null distributions of a correlation: seeded permutations and surrogates of series that are rows of arrays.

A permutation follows from its kind, the seed, its number and the length alone, so tasks make those that they need, and a lost
one makes the same again. Series are spread over tasks together with batches of permutations.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tracelake.functions.ship import map_arrow

#: Draws until a permutation meets its constraints; beyond them there is taken to be none.
TRIES = 10_000
#: Series that are worked on at a time, and numbers of orders that are kept for the next ones: they bound a task's memory.
AT_ONCE, HELD = 256, 1 << 21
#: Equal series, whose surrogates are the same, are dealt to so many places at most: one is as many tasks' work as that.
PLACES = 4


def _rng(seed: int, number: int) -> np.random.Generator:
    return np.random.Generator(np.random.Philox(key=[seed, number]))


def _fine(order: np.ndarray, stimulus: np.ndarray | None) -> bool:
    return not np.array_equal(order, np.arange(len(order))) and (stimulus is None or not np.array_equal(stimulus[order], stimulus))


def chunked(n: int, splits: int, least: int, seed: int, number: int, stimulus: np.ndarray | None = None) -> np.ndarray:
    """An order of n samples in splits + 1 chunks of at least `least` each, no two neighbours of which were neighbours in that order before.

    Lengths are drawn evenly among all that fit. The order differs from the old one, and where a stimulus is given so does the
    stimulus in it. Raises ValueError where there is no such order (fewer than two chunks, or too few samples).
    """
    spare = n - (splits + 1) * least
    if splits < 1 or spare < 0 or least < 1:
        raise ValueError(f"{n} samples have no {splits + 1} chunks of {least} or more")
    rng = _rng(seed, number)
    for _ in range(TRIES):
        inner = np.sort(rng.choice(spare + splits, splits, replace=False)) - np.arange(splits)
        edges = np.concatenate(([0], inner + least * np.arange(1, splits + 1), [n]))
        place = rng.permutation(splits + 1)
        if (np.diff(place) == 1).any():
            continue
        order = np.concatenate([np.arange(edges[i], edges[i + 1]) for i in place])
        if _fine(order, stimulus):
            return order
    raise ValueError("no chunked order meets the constraints")


def shuffled(n: int, seed: int, number: int, stimulus: np.ndarray | None = None) -> np.ndarray:
    """Any order of n samples but the old one, nor one that leaves the stimulus as it is."""
    rng = _rng(seed, number)
    for _ in range(TRIES):
        order = rng.permutation(n)
        if _fine(order, stimulus):
            return order
    raise ValueError("no other order meets the constraints")


def rotations(n: int, least: int, stimulus: np.ndarray | None = None, avoid: tuple[int, int] = (0, 0), mirrored: bool = True) -> list[tuple[int, bool]]:
    """All (shift, mirrored) with shifts from `least` on, both ways round, but those that move the stimulus to where one of the lags of `avoid` (first and last) has it."""
    near = {np.roll(stimulus, k).tobytes() for k in range(avoid[0], avoid[1] + 1)} if stimulus is not None else set()
    fine = [k for k in range(max(least, 1), n - max(least, 1) + 1) if stimulus is None or np.roll(stimulus, k).tobytes() not in near]
    return [(k, m) for m in ((False, True) if mirrored else (False,)) for k in fine]


def rotated(n: int, turn: tuple[int, bool]) -> np.ndarray:
    order = np.roll(np.arange(n), turn[0])
    return order[::-1] if turn[1] else order


@lru_cache(maxsize=1)
def _draws(seed: int, numbers: range, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted normal values and random turns of phases for each number, the same for all series of a length."""
    rngs = [_rng(seed, i) for i in numbers]
    gauss = np.stack([np.sort(r.normal(size=n)) for r in rngs])
    return gauss, np.exp(2j * np.pi * np.stack([r.random(n // 2 + 1) for r in rngs]))


def _flat(values: np.ndarray) -> tuple[int, int]:
    """Where the longest run of equal values begins and ends, in sorted values."""
    edges = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1], [True])))
    i = int(np.argmax(np.diff(edges)))
    return int(edges[i]), int(edges[i + 1])


def surrogates(x: np.ndarray, seed: int, numbers: range, rounds: int = 10) -> np.ndarray:
    """For each number, the values of x in an order that has its amplitude spectrum: random phases, then spectrum and ranks are restored in turn."""
    n, values, target = len(x), np.sort(x), np.abs(np.fft.rfft(x))
    gauss, turns = _draws(seed, numbers, n)
    # Among equal values no order is needed: only those below and above the longest run of such are sorted.
    low, high = _flat(values)
    row = np.arange(len(gauss))[:, None]

    def ranked(rows: np.ndarray) -> np.ndarray:
        if high - low < n // 2:
            order = np.argsort(rows, axis=1)
            out = np.empty_like(rows)
            out[row, order] = values
            return out
        out = np.full_like(rows, values[low])
        for part, own in ((slice(0, low), -rows), (slice(high, n), rows)):
            k = part.stop - part.start
            if k:
                top = np.argpartition(own, n - k, axis=1)[:, n - k :]
                order = np.take_along_axis(top, np.argsort(own[row, top], axis=1), axis=1)
                out[row, order] = values[part] if part.start else values[part][::-1]
        return out

    now = ranked(np.fft.irfft(np.fft.rfft(gauss[:, np.argsort(np.argsort(x))], axis=1) * turns, n, axis=1))
    for _ in range(rounds):
        spectrum = np.fft.rfft(now, axis=1)
        size = np.abs(spectrum)
        spectrum[size == 0], size[size == 0] = 1, 1
        now = ranked(np.fft.irfft(spectrum * (target / size), n, axis=1))
    return now


def _order(kind: str, n: int, seed: int, number: int, splits: int, least: int, stimulus) -> np.ndarray:
    if kind == "chunk":
        return chunked(n, splits, least, seed, number, stimulus)
    if kind == "shuffle":
        return shuffled(n, seed, number, stimulus)
    found = rotations(n, least, stimulus)
    return rotated(n, found[number % len(found)])


def _z(x: np.ndarray) -> np.ndarray | None:
    s = x.std(axis=-1, keepdims=True)
    return (x - x.mean(axis=-1, keepdims=True)) / s if len(x) and (s > 1e-12 * (1 + np.abs(x).max())).all() else None


def _arrays(series: DataFrame, key: str, *columns: str) -> DataFrame:
    """The key and columns as arrays of doubles."""
    return series.select(key, *[F.col(c).cast("array<double>").alias(f"_{i}") for i, c in enumerate(columns)])


def _by_value(arrays: DataFrame, key: str) -> DataFrame:
    """The rows of _arrays() dealt so that those of equal first arrays follow each other, in PLACES places or fewer."""
    return arrays.withColumn("_of", F.xxhash64("_0")).repartition("_of", F.pmod(F.xxhash64(key), F.lit(PLACES))).sortWithinPartitions("_of").drop("_of")


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[tuple]]]:
    """Keys, and each row's other columns as numpy arrays (None for null), AT_ONCE rows at a time, whatever a batch holds."""
    for batch in batches:
        for at in range(0, batch.num_rows, AT_ONCE):
            some = batch.slice(at, AT_ONCE)
            yield some.column(0), list(zip(*[some.column(i).to_pandas() for i in range(1, some.num_columns)]))


def _pair(a: np.ndarray | None, b: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """The series, and both standardised, where they can be correlated."""
    a, b = (np.zeros(0) if v is None else np.asarray(v, float) for v in (a, b))
    if len(a) != len(b) or not len(a) or not (np.isfinite(a).all() and np.isfinite(b).all()):
        return None
    za, zb = _z(a), _z(b)
    return None if za is None or zb is None else (a, za, zb)


def correlating(key: str, kind_of_key: str, kind: str = "chunk", count: int = 200, seed: int = 1, splits: int = 10, least: int = 3, batch: int = 50, stimulus: list[float] | None = None, first: int = 0) -> tuple[Callable, str]:
    """What null_correlations() does with batches of key, series and prediction, and the schema of what it makes; see ridge.with_arrays."""
    stim = None if stimulus is None else np.asarray(stimulus, float)
    chunks = [range(i, min(count, i + batch)) for i in range(first, count, batch)]

    def orders(n: int, numbers: range, known: dict) -> np.ndarray | None:
        if (n, numbers) not in known:
            if sum(v.size for v in known.values() if v is not None) > HELD:
                known.clear()
            try:
                known[n, numbers] = np.stack([_order(kind, n, seed, i, splits, least, stim) for i in numbers])
            except (ValueError, ZeroDivisionError):
                known[n, numbers] = None
        return known[n, numbers]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for keys, pairs in _slices(batches):
            out = np.full((len(keys), max(0, count - first)), np.nan)
            whole = [(i, _pair(*p)) for i, p in enumerate(pairs)]
            whole = [(i, p) for i, p in whole if p is not None]
            # A batch of numbers for all series of the slice, so that an order serves them all.
            for numbers in chunks:
                last = made = None
                for i, (a, za, zb) in whole:
                    own = out[i, numbers.start - first : numbers.stop - first]
                    if kind == "surrogate":
                        if last is None or not np.array_equal(a, last):
                            last, made = a, _z(surrogates(a, seed, numbers))
                        own[:] = made @ zb / len(a)
                    elif (order := orders(len(a), numbers, known)) is not None:
                        own[:] = za[order] @ zb / len(a)
            number = np.tile(np.arange(first, first + out.shape[1], dtype=np.int32), len(keys))
            r = pa.array(out.ravel(), from_pandas=True)
            yield pa.RecordBatch.from_arrays([keys.take(pa.array(np.repeat(np.arange(len(keys)), out.shape[1]))), pa.array(number), r], [key, "number", "r"])

    return run, f"{key} {kind_of_key}, number int, r double"


def null_correlations(series: DataFrame, key: str, y: str, predicted: str, kind: str = "chunk", **options) -> DataFrame:
    """(key, number, r): correlation of each series, permuted, with its prediction (an array of the same length), for the numbers from `first` up to `count`.

    kind: chunk, shuffle, circular (rotations and their mirror images, in turn) or surrogate, which is each series' own; other
    options are those of correlating(). A pair of arrays that differ in length, are too short for the kind, hold null or NaN, or
    where one is constant, has r null. Series are dealt out once, and a task makes `batch` numbers at a time of its AT_ONCE
    series. Surrogates follow from a series' values, so of equal series that meet they are made once.
    """
    arrays = _arrays(series, key, y, predicted)
    return map_arrow(_by_value(arrays, key) if kind == "surrogate" else arrays.repartition(key), *correlating(key, series.schema[key].dataType.simpleString(), kind, **options))


def observed(series: DataFrame, key: str, y: str, predicted: str) -> DataFrame:
    """(key, r): correlation of each series, as it is, with its prediction; null where null_correlations() gives null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, pairs in _slices(batches):
            found = [_pair(*p) for p in pairs]
            r = [None if p is None else float(p[1] @ p[2] / len(p[0])) for p in found]
            yield pa.RecordBatch.from_arrays([keys, pa.array(r, pa.float64())], [key, "r"])

    return map_arrow(_arrays(series, key, y, predicted).repartition(key), run, f"{key} {series.schema[key].dataType.simpleString()}, r double")


def filtering(spark: SparkSession, design: np.ndarray, key: str, kind_of_key: str, penalty: float, kind: str = "shuffle", count: int = 200, seed: int = 1, splits: int = 10, least: int = 3) -> tuple[Callable, str]:
    """What null_filters() does with batches of key and series (and more), and the schema of what it makes; see ridge.with_arrays."""
    solver = np.linalg.solve(design.T @ design + penalty * np.eye(design.shape[1]), design.T)
    shared = spark.sparkContext.broadcast(solver)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders, width = None, len(shared.value)
        for keys, values in _slices(batches):
            found = [(i, _pair(a, a)) for i, (a, *_) in enumerate(values) if a is not None and len(a) == shared.value.shape[1]]
            of, stats = [], np.zeros((0, 3))
            for i, pair in found:
                if pair is None:
                    continue
                if kind == "surrogate":
                    made = _z(surrogates(pair[0], seed, range(count)))
                else:
                    if orders is None:
                        orders = np.stack([_order(kind, len(pair[0]), seed, j, splits, least, None) for j in range(count)])
                    made = pair[1][orders]
                w = made @ shared.value.T
                of.append(i)
                stats = np.concatenate([stats, np.stack([w.mean(axis=0), np.median(w, axis=0), w.std(axis=0, ddof=1)], axis=1)])
            columns = [keys.take(pa.array(np.repeat(np.array(of, np.int64), width))), pa.array(np.tile(np.arange(width, dtype=np.int32), len(of))), *map(pa.array, stats.T.copy())]
            yield pa.RecordBatch.from_arrays(columns, [key, "i", "mean", "median", "sd"])

    return run, f"{key} {kind_of_key}, i int, mean double, median double, sd double"


def null_filters(series: DataFrame, design: np.ndarray, key: str, y: str, penalty: float, **options) -> DataFrame:
    """(key, i, mean, median, sd) of each weight of the ridge filter over refits on `count` permutations of each standardised series.

    design: standardised, a row for each sample (see ridge.standardised); options are those of filtering(). A refit is a product
    with one matrix for all series. A series that null_correlations() gives no r for has no rows.
    """
    return map_arrow(_arrays(series, key, y), *filtering(series.sparkSession, design, key, series.schema[key].dataType.simpleString(), penalty, **options))


def resumed(series: DataFrame, folder: str, key: str, y: str, predicted: str, count: int, step: int = 100, **options) -> DataFrame:
    """null_correlations() kept in `folder`, `step` numbers in a table of their own; what is there in whole is not made again.

    Numbers already there have to come from the same series and options. A table counts once its marker of success is written.
    """
    spark, done = series.sparkSession, []
    for first in range(0, count, step):
        path = f"{folder.rstrip('/')}/numbers-{first}-{min(count, first + step)}"
        try:
            done.append(spark.read.parquet(path))
            continue
        except AnalysisException:
            pass
        made = null_correlations(series, key, y, predicted, count=min(count, first + step), first=first, **options)
        made.write.mode("overwrite").parquet(path)
        done.append(spark.read.parquet(path))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out
