"""Peaks of regularly sampled traces that keep a least distance from higher ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.functions.shared import cut


def with_neighbours(samples: DataFrame, key: str, t: str, value: str, *others: str) -> DataFrame:
    """(key, t, value, before, after, others): each sample with the values at t - 1 and t + 1 (null where there is none), without a window over the trace."""
    steps = F.explode(F.array(*[F.lit(k) for k in (-1, 0, 1)])).alias("_step")
    sent = samples.select(key, F.col(t).alias("_t"), F.col(value).cast("double").alias("_v"), *others, steps).withColumn(t, F.col("_t") + F.col("_step"))
    of = lambda k: F.max(F.when(F.col("_step") == k, F.col("_v")))
    return sent.groupBy(key, t).agg(of(0).alias(value), of(1).alias("before"), of(-1).alias("after"), *[F.max(F.when(F.col("_step") == 0, F.col(c))).alias(c) for c in others]).where(F.col(value).isNotNull())


def peaks(samples: DataFrame, key: str, t: str, value: str, least: Column, distance: int) -> DataFrame:
    """(key, t, value) of the peaks of at least `least` that no higher peak taken lies within `distance` of.

    samples: one row for each key and whole number t. A peak is above the sample before it and not below the one after it;
    ends and gaps are no peaks. Peaks are taken from the highest down (of equals the first), and each rules out all others
    within `distance`. That order is kept though whole traces are never sorted: in every round those go in that no higher one
    left lies near, and those near them go out. Candidates meet at blocks of `distance` samples, and the result is free of these.
    """
    near = with_neighbours(samples.withColumn("_least", least), key, t, value, "_least")
    found = near.where((F.col(value) > F.col("before")) & (F.col(value) >= F.col("after")) & (F.col(value) >= F.col("_least"))).select(key, t, value)
    found = cut(found)
    block = F.floor(F.col(t) / (distance + 1))
    here = found.select(key, F.col(t).alias("a"), F.struct(F.col(value), -F.col(t)).alias("ra"), F.explode(F.array(block - 1, block, block + 1)).alias("_b"))
    there = found.select(key, F.col(t).alias("b"), F.struct(F.col(value), -F.col(t)).alias("rb"), block.alias("_b"))
    # (a, b): b is higher and near.
    edges = cut(here.join(there, [key, "_b"]).where((F.col("rb") > F.col("ra")) & (F.abs(F.col("a") - F.col("b")) <= distance)).select(key, "a", "b"))
    left, taken = found, None
    while True:
        ruled = edges.select(key, F.col("a").alias(t)).distinct()
        now = cut(left.join(ruled, [key, t], "left_anti"))
        taken = now if taken is None else taken.unionByName(now)
        out = edges.join(now.select(key, F.col(t).alias("b")), [key, "b"], "left_semi").select(key, F.col("a").alias(t)).distinct()
        left = cut(left.join(now.select(key, t), [key, t], "left_anti").join(out, [key, t], "left_anti"))
        if left.isEmpty():
            return taken
        alive = left.select(key, t)
        edges = cut(edges.join(alive.withColumnRenamed(t, "a"), [key, "a"], "left_semi").join(alive.withColumnRenamed(t, "b"), [key, "b"], "left_semi"))


def frames(starts: DataFrame, ends: DataFrame, key: str, t: str, tolerance: float = 1.1) -> DataFrame:
    """(key, start, end, long): each start with the first end after it and before the next start; long: over `tolerance` times the median length."""
    both = starts.select(key, F.col(t).alias("t"), F.lit(0).alias("kind")).unionByName(ends.select(key, F.col(t).alias("t"), F.lit(1).alias("kind")))
    after = Window.partitionBy(key).orderBy("t", "kind")
    rows = both.withColumns({"end": F.lead("t").over(after), "_next": F.lead("kind").over(after)}).where("kind = 0 and _next = 1").select(key, F.col("t").alias("start"), "end")
    middle = rows.groupBy(key).agg(F.percentile(F.col("end") - F.col("start"), F.lit(0.5)).alias("_m"))
    return rows.join(middle, key).select(key, "start", "end", ((F.col("end") - F.col("start")) > tolerance * F.col("_m")).alias("long"))
