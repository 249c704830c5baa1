"""Models on series and vectors: cross-validated ridge, clusters, mixtures."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.clustering import GaussianMixture, KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.functions.shared import cut
from tracelake.functions.ship import ship


def held_out_r(x: np.ndarray, lags: int, penalty: float, folds: int) -> float | None:
    """Correlation of a series with its prediction from its last `lags` samples, each contiguous fold by ridge on the others."""
    if len(x) < lags + 2 * folds or not np.isfinite(x).all():
        return None
    past = np.stack([x[lags - k : len(x) - k] for k in range(1, lags + 1)], axis=1)
    now, fold, made = x[lags:], np.arange(len(x) - lags) * folds // (len(x) - lags), np.zeros(len(x) - lags)
    for f in range(folds):
        a, b = past[fold != f], now[fold != f]
        middle, level = a.mean(axis=0), b.mean()
        w = np.linalg.solve((a - middle).T @ (a - middle) + penalty * np.eye(lags), (a - middle).T @ (b - level))
        made[fold == f] = (past[fold == f] - middle) @ w + level
    spread = made.std() * now.std()
    return float(((made - made.mean()) * (now - now.mean())).mean() / spread) if spread > 0 else None


def ridge_cv(series: DataFrame, key: str, values: str, lags: int = 3, penalty: float = 1.0, folds: int = 4) -> DataFrame:
    """(key, r) for each row of array series; null where a series is too short, constant or not finite. No shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            r = [None if v is None else held_out_r(np.asarray(v, float), lags, penalty, folds) for v in batch["x"]]
            yield pd.DataFrame({key: batch[key], "r": pd.Series(r, dtype="float64", index=batch.index)})

    ship(series.sparkSession)
    return series.select(key, F.col(values).cast("array<double>").alias("x")).mapInPandas(run, f"{key} {series.schema[key].dataType.simpleString()}, r double")


def clusters(df: DataFrame, key: str, values: str, k: int, seed: int = 1) -> DataFrame:
    """(key, cluster) by k-means on array columns of one length."""
    rows = df.select(key, array_to_vector(F.col(values).cast("array<double>")).alias("features"))
    model = KMeans(k=k, seed=seed, predictionCol="cluster").fit(rows)
    return model.transform(rows).select(key, "cluster")


def mixture(df: DataFrame, value: Column, k: int = 2, seed: int = 1) -> DataFrame:
    """(component, weight, mean, sd) of a mixture of k normal distributions, components by mean. Equal values are counted first."""
    counted = df.where(value.isNotNull()).groupBy(value.cast("double").alias("v")).agg(F.count("*").cast("double").alias("n"))
    rows = cut(counted.select(array_to_vector(F.array("v")).alias("features"), "n"))
    model = GaussianMixture(k=k, seed=seed, tol=1e-5, maxIter=100, weightCol="n").fit(rows)
    found = sorted((float(g.mean[0]), float(g.cov.toArray()[0, 0]) ** 0.5, float(w)) for g, w in zip(model.gaussiansDF.collect(), model.weights))
    rows = [(i, w, m, s) for i, (m, s, w) in enumerate(found)]
    return df.sparkSession.createDataFrame(rows, "component int, weight double, mean double, sd double")
