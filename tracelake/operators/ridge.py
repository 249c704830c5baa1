"""Ridge regression of many series on one design of lagged regressors, from sums of products alone.

The samples are read once: Gram matrices of the design and its products with each series are summed by fold, in Spark. All
that follows (standardising, penalties, held-out correlations, what each group of regressors adds) is algebra on matrices
as large as the number of regressors, series by series, so neither long recordings nor many series meet in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.functions.shared import cut
from tracelake.functions.ship import map_arrow, ship

#: Penalties looked at, in powers of ten, before the best is refined; and how alike regressors are dependent ones.
POWERS, REFINED, DEPENDENT = np.arange(-4.0, 8.5, 0.5), 30, 1e-9
#: A design of so many numbers is broadcast; a longer recording has to be cut into parts.
MOST_NUMBERS = 1 << 23
#: Series that are worked on at a time.
AT_ONCE = 256


def lagged(design: DataFrame, t: str, names: list[str], lags: range) -> DataFrame:
    """(t, x): x holds each regressor at each lag (name by name, lags in order), 0 beyond the ends and for missing values.

    Each row is sent to the times that look back at it, so this is one aggregation by time. One row for each time of design.
    """
    moves = F.explode(F.array(*[F.lit(k) for k in lags])).alias("_lag")
    sent = design.select(F.col(t).alias("_from"), *[F.col(c).cast("double").alias(c) for c in names], moves)
    sent = sent.withColumn(t, F.col("_from") + F.col("_lag"))
    own = [F.max(F.when(F.col("_lag") == k, F.nanvl(F.col(c), F.lit(0.0)))) for c in names for k in lags]
    rows = sent.groupBy(t).agg(F.array(*[F.coalesce(x, F.lit(0.0)) for x in own]).alias("x"))
    return rows.join(design.select(t).distinct(), t, "left_semi")


def _products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for fold, rows in batch.groupby("fold"):
            x = np.hstack([np.ones((len(rows), 1)), np.stack(rows["x"].to_numpy())])
            yield pd.DataFrame({"fold": [fold], "m": [(x.T @ x).ravel()]})


def grams(design: DataFrame) -> dict[int, np.ndarray]:
    """By fold, the Gram matrix of (1, x) over the rows of design (fold, x). Summed in Spark; only as many numbers as folds times regressors squared come back."""
    ship(design.sparkSession)
    parts = design.select("fold", "x").mapInPandas(_products, "fold int, m array<double>")
    sums = parts.select("fold", F.posexplode("m").alias("i", "v")).groupBy("fold", "i").agg(F.sum("v").alias("v"))
    out: dict[int, dict[int, float]] = {}
    for r in sums.toLocalIterator():
        out.setdefault(r.fold, {})[r.i] = r.v
    return {f: np.array([m[i] for i in range(len(m))]).reshape(int(len(m) ** 0.5), -1) for f, m in out.items()}


def with_products(samples: DataFrame, design: DataFrame, key: str, t: str, y: str, width: int) -> DataFrame:
    """(key, parts): by fold the sums of y, y * y and y * x of each series. samples: key, t, y; a time without a row counts as 0."""
    both = samples.where(F.col(y).isNotNull() & ~F.isnan(F.col(y).cast("double"))).select(key, t, F.col(y).cast("double").alias("_y")).join(design, t)
    sums = [F.sum("_y"), F.sum(F.col("_y") * F.col("_y")), *[F.sum(F.col("_y") * F.get("x", F.lit(i))) for i in range(width)]]
    return both.groupBy(key, "fold").agg(F.array(*sums).alias("s")).groupBy(key).agg(F.collect_list(F.struct("fold", "s")).alias("parts"))


class Sums:
    """Centred sums of squares and products of some samples: of x with x and with the y of many series (a row each), of y; and their scales."""

    def __init__(self, gram: np.ndarray, s: np.ndarray) -> None:
        n = gram[0, 0]
        mean = gram[0, 1:] / n
        self.n, self.xx = n, gram[1:, 1:] - n * np.outer(mean, mean)
        self.xy, self.yy = s[:, 2:] - s[:, :1] * mean, s[:, 1] - s[:, 0] * s[:, 0] / n
        # What rounding leaves of a constant counts as nothing.
        self.sx = np.sqrt(np.where(np.diag(self.xx) > DEPENDENT * np.maximum(1, np.diag(gram)[1:]), np.diag(self.xx), 0) / n)
        self.sy = np.sqrt(np.where(self.yy > DEPENDENT * np.maximum(1.0, s[:, 1]), self.yy, 0) / n)

    def standard(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Products of standardised x with each other and each y, and of each y; constant ones are 0 throughout."""
        scale = np.divide(1.0, self.sx, out=np.zeros_like(self.sx), where=self.sx > 0)
        return self.xx * np.outer(scale, scale), self.xy * scale / np.where(self.sy > 0, self.sy, 1.0)[:, None], np.where(self.sy > 0, self.n, 0.0)


def independent(xx: np.ndarray) -> np.ndarray:
    """Which columns are kept if each that depends on those before it is left out, from their (standardised) Gram matrix."""
    left, keep = xx.copy(), np.zeros(len(xx), bool)
    scale = max(float(np.diag(xx).max(initial=0)), 1e-300)
    for i in range(len(xx)):
        if left[i, i] > 1e-8 * scale:
            keep[i] = True
            left = left - np.outer(left[:, i], left[i]) / left[i, i]
    return keep


def best_penalty(d: np.ndarray, a: np.ndarray, yy: np.ndarray, n: float) -> np.ndarray:
    """For each y the penalty of the greatest marginal likelihood: y normal around x w, w normal around 0, the noise's scale integrated out.

    d: eigenvalues of x's products; a: squared products of each y with the eigenvectors.
    """

    def cost(power: np.ndarray) -> np.ndarray:
        p = 10.0 ** power[:, None]
        return n * np.log(np.maximum(yy - (a / (d + p)).sum(axis=1), 1e-12 * yy)) + np.log1p(d / p).sum(axis=1)

    at = POWERS[np.argmin([cost(np.full(len(yy), p)) for p in POWERS], axis=0)]
    low, high, golden = at - 0.5, at + 0.5, (5**0.5 - 1) / 2
    for _ in range(REFINED):
        x, z = high - golden * (high - low), low + golden * (high - low)
        left = cost(x) <= cost(z)
        low, high = np.where(left, low, x), np.where(left, z, high)
    return 10 ** ((low + high) / 2)


def solved(train: Sums, columns: np.ndarray, penalty: float | None) -> tuple[np.ndarray, np.ndarray, int]:
    """For each y the weights of standardised regressors (0 for those left out) and the penalty, and how many regressors are independent."""
    xx, xy, yy = train.standard()
    w, p, own = np.zeros(xy.shape), np.full(len(xy), np.nan), np.flatnonzero(columns)
    own = own[independent(xx[np.ix_(own, own)])] if len(own) else own
    some = np.flatnonzero(yy > 0)
    if len(own) and len(some):
        d, v = np.linalg.eigh(xx[np.ix_(own, own)])
        d, turned = np.maximum(d, 0), xy[np.ix_(some, own)] @ v
        p[some] = best_penalty(d, turned**2, yy[some], train.n) if penalty is None else penalty
        w[np.ix_(some, own)] = turned / (d + p[some, None]) @ v.T
    return w, p, len(own)


def correlation(test: Sums, w: np.ndarray) -> np.ndarray:
    """Correlation of each y with its weighted sum of x, both standardised on the test samples; 0 where one is constant."""
    xx, xy, yy = test.standard()
    power = ((w @ xx) * w).sum(axis=1) * yy
    return np.divide((xy * w).sum(axis=1), np.sqrt(np.maximum(power, 0)), out=np.zeros(len(w)), where=power > 0)


def fitted(samples: DataFrame, design: DataFrame, key: str, t: str, y: str, groups: dict[str, int], penalty: float | None = None) -> DataFrame:
    """(key, r, r2, penalty, rank, filter, unique) of each series: means over folds that are held out in turn.

    design: t, fold, x (all of one length), a row for each time; samples: key, t, y, a time without a row being 0. groups: how
    many columns of x each group of regressors has, in order. r: correlation with the held-out samples, r2 its square; unique:
    for each group how much r2 falls without it. The penalty is that of the greatest marginal likelihood if none is given.
    Regressors that are constant or depend on those before them have weight 0; rank is the number of others. A series without
    samples is not in the result; one that is constant has r 0.
    """
    width = sum(groups.values())
    design = cut(design.select(t, F.col("fold").cast("int").alias("fold"), "x"))
    gram = design.sparkSession.sparkContext.broadcast(grams(design))
    ends = np.cumsum([0, *groups.values()])
    parts = with_products(samples, design, key, t, y, width)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole = sum(gram.value.values())
        for batch in batches:
            s = {f: np.zeros((len(batch), width + 2)) for f in gram.value}
            for i, own in enumerate(batch["parts"]):
                for p in own:
                    s[p["fold"]][i] = p["s"]
            total, m = sum(s.values()), 0.0
            for f, g in gram.value.items():
                train, test = Sums(whole - g, total - s[f]), Sums(g, s[f])
                w, p, rank = solved(train, np.ones(width, bool), penalty)
                r, less = correlation(test, w), []
                for a, b in zip(ends[:-1], ends[1:]):
                    others = np.ones(width, bool)
                    others[a:b] = False
                    less.append(r**2 - correlation(test, solved(train, others, penalty)[0]) ** 2)
                m = m + np.column_stack([r, r * r, p, np.full(len(r), rank), *less, w]) / len(gram.value)
            k = 4 + len(groups)
            yield pd.DataFrame({key: batch[key], "r": m[:, 0], "r2": m[:, 1], "penalty": m[:, 2], "rank": m[:, 3], "filter": list(m[:, k:]), "unique": list(m[:, 4:k])})

    ship(samples.sparkSession)
    kind = samples.schema[key].dataType.simpleString()
    rows = parts.mapInPandas(run, f"{key} {kind}, r double, r2 double, penalty double, rank double, filter array<double>, unique array<double>")
    unique = F.map_from_arrays(F.array(*[F.lit(g) for g in groups]), "unique")
    return rows.withColumn("unique", unique)


def standardised(design: DataFrame, t: str) -> np.ndarray:
    """The design of one recording as a matrix: a row for each time, in order, each column standardised (a constant one is 0).

    Raises ValueError beyond MOST_NUMBERS, as it is broadcast.
    """
    rows, width = design.count(), len(design.select("x").first()["x"])
    if rows * width > MOST_NUMBERS:
        raise ValueError(f"a design of {rows} times and {width} regressors is too large to broadcast")
    x = np.stack(design.orderBy(t).select("x").toPandas()["x"].to_numpy())
    scale = x.std(axis=0)
    return np.divide(x - x.mean(axis=0), scale, out=np.zeros_like(x), where=scale > 1e-12)


def with_arrays(samples: DataFrame, filters: DataFrame, design: DataFrame, key: str, t: str, y: str, then: tuple[Callable, str] | None = None) -> DataFrame:
    """(key, y, predicted) of each series with a filter, as arrays over the design's times, in order: a time without a sample is 0.

    then: a function of batches of these, AT_ONCE series each, and the schema of its rows, which are returned instead. Arrays
    then never become rows, batches of which would hold thousands of them.

    samples: one row for each key and time; those at other times than the design's count for nothing.
    """
    spark = design.sparkSession
    z = spark.sparkContext.broadcast(standardised(design, t))
    places = spark.sparkContext.broadcast({v: i for i, v in enumerate(r[0] for r in design.select(t).orderBy(t).collect())})
    own = samples.where(F.col(y).isNotNull()).groupBy(key).agg(F.collect_list(F.struct(F.col(t).alias("t"), F.col(y).cast("double").alias("y"))).alias("own"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(z.value)
        for batch in batches:
            for at in range(0, batch.num_rows, AT_ONCE):
                some = batch.slice(at, AT_ONCE)
                series = np.zeros((some.num_rows, n))
                row = np.repeat(np.arange(some.num_rows), pc.fill_null(pc.list_value_length(some.column("ts")), 0).to_numpy(zero_copy_only=False))
                place = np.array([places.value.get(v, -1) for v in some.column("ts").flatten().to_pylist()], np.int64)
                known = place >= 0
                series[row[known], place[known]] = some.column("ys").flatten().to_numpy(zero_copy_only=False)[known]
                made = np.array(some.column("filter").to_pylist(), float).reshape(some.num_rows, -1) @ z.value.T
                ends = pa.array(np.arange(some.num_rows + 1, dtype=np.int32) * n)
                yield pa.RecordBatch.from_arrays([some.column(key), *(pa.ListArray.from_arrays(ends, pa.array(m.ravel())) for m in (series, made))], [key, "y", "predicted"])

    kind = samples.schema[key].dataType.simpleString()
    rows = filters.select(key, "filter").join(own, key, "left").select(key, "filter", F.col("own.t").alias("ts"), F.col("own.y").alias("ys"))
    if then is None:
        return map_arrow(rows, run, f"{key} {kind}, y array<double>, predicted array<double>")
    made, schema = then
    # Compact rows would be put together by size, whatever work they are.
    return map_arrow(rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), key), lambda batches: made(run(batches)), schema)
