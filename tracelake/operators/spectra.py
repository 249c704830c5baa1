"""Power spectra of series that are rows of arrays, and classes of series by them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.functions.shared import cut
from tracelake.functions.ship import ship


def periodogram(x: np.ndarray, segment: int) -> np.ndarray:
    """Mean power at 0 to segment // 2 cycles a segment over half-overlapping segments, each centred and weighted by a raised cosine."""
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(segment) / segment)
    parts = np.stack([x[i : i + segment] for i in range(0, len(x) - segment + 1, max(1, segment // 2))])
    parts = (parts - parts.mean(axis=1, keepdims=True)) * window
    return (np.abs(np.fft.rfft(parts, axis=1)) ** 2).mean(axis=0) / (window**2).sum()


def spectra(series: DataFrame, key: str, values: str, segment: int) -> DataFrame:
    """(key, power) of each series; null for one that is shorter than a segment or holds null or NaN. No shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [np.zeros(0) if v is None else np.asarray(v, float) for v in batch["x"]]
            yield pd.DataFrame({key: batch[key], "power": [periodogram(x, segment) if len(x) >= segment and np.isfinite(x).all() else None for x in rows]})

    ship(series.sparkSession)
    return series.select(key, F.col(values).cast("array<double>").alias("x")).mapInPandas(run, f"{key} {series.schema[key].dataType.simpleString()}, power array<double>")


def above_as_floor(power: str, cut_off: int):
    """The spectrum up to cut_off, and from there on its geometric mean: the level of noise. A zero makes the level 0."""
    high = F.slice(power, cut_off + 1, F.greatest(F.size(power) - cut_off, F.lit(0)))
    level = F.exp(F.aggregate(high, F.lit(0.0), lambda a, v: a + F.when(v > 0, F.ln(v)).otherwise(F.lit(float("-inf")))) / F.size(high))
    return F.transform(power, lambda v, i: F.when(i < cut_off, v).otherwise(level))


def classes(found: DataFrame, key: str, high: int, seed: int = 1) -> DataFrame:
    """(key, active): two-means on spectra of sum 1; active are those of the class with less power from `high` on. A series without power is in neither (null)."""
    total = F.aggregate("power", F.lit(0.0), lambda a, v: a + v)
    rows = cut(found.withColumn("_t", total).where("_t > 0").select(key, F.transform("power", lambda v: v / F.col("_t")).alias("p")))
    if rows.isEmpty():
        return found.select(key, F.lit(None).cast("boolean").alias("active"))
    points = rows.select(key, "p", array_to_vector("p").alias("features"))
    labelled = KMeans(k=2, seed=seed, predictionCol="class").fit(points).transform(points).select(key, "class", F.aggregate(F.slice("p", high + 1, 1 << 30), F.lit(0.0), lambda a, v: a + v).alias("above"))
    labelled = cut(labelled)
    quiet = labelled.groupBy("class").agg(F.avg("above").alias("above")).orderBy("above", "class").first()["class"]
    return found.select(key).join(labelled.select(key, (F.col("class") == int(quiet)).alias("active")), key, "left")
