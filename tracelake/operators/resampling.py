"""Volumes on another grid: linear in space along every axis, and in time from each plane's own clock to a common one.

Both are sums of samples times weights, added up before they are shuffled; no task has to hold an image or a recording.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Weights that sum to less are not whole.
WHOLE = 1 - 1e-9


def _added(rows: DataFrame, key: list[str], value: str) -> DataFrame:
    """Weighted sums (rows: key, value, _w); null where a sample with a weight is, no row where one that has a weight is absent."""
    v = F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))
    sums = rows.where("_w > 0").groupBy(*key).agg(F.sum("_w").alias("_there"), F.sum(F.when(v.isNotNull(), F.col("_w"))).alias("_known"), F.sum(v * F.col("_w")).alias("_v"))
    return sums.where(F.col("_there") >= WHOLE).select(*key, F.when(F.col("_known") >= WHOLE, F.col("_v")).alias(value))


def missing_throughout(samples: DataFrame, pixel: list[str], value: str) -> DataFrame:
    """samples with `value` null in every row of a pixel that is null or NaN in any. Columns of pixel are not null."""
    bad = samples.where(F.col(value).isNull() | F.isnan(F.col(value).cast("double"))).select(*pixel, F.lit(True).alias("_bad")).distinct()
    return samples.join(bad, pixel, "left").withColumn(value, F.when(F.col("_bad").isNull(), F.col(value))).drop("_bad")


def in_space(samples: DataFrame, key: list[str], axes: dict[str, tuple[float, float]], value: str) -> DataFrame:
    """(key, axes, value) on the new grid; axes: the index column (from 0) of each axis, with the old and the new distance of samples.

    Every sample goes to the new points less than one old distance away in all axes, with its linear weight there. A point
    that needs a null or NaN sample is null; one that needs a sample beyond the image, or one without a row, has no row. Of
    repeated samples of a place the mean counts.
    """
    rows = samples.groupBy(*key, *axes).agg(F.avg(value).alias(value), F.max(F.col(value).isNull()).alias("_gap"))
    rows = rows.withColumns({value: F.when(~F.col("_gap"), F.col(value)), "_w": F.lit(1.0)}).drop("_gap")
    for axis, (old, new) in axes.items():
        if old != new:
            first = F.greatest(F.lit(0), F.floor((F.col(axis) - 1) * old / new) + 1).cast("long")
            last = (F.ceil((F.col(axis) + 1) * old / new) - 1).cast("long")
            rows = rows.where(first <= last).withColumn("_to", F.explode(F.sequence(first, last)))
            rows = rows.withColumn("_w", F.col("_w") * (1 - F.abs(F.col("_to") * new - F.col(axis) * old) / old)).drop(axis).withColumnRenamed("_to", axis)
    return _added(rows, [*key, *axes], value)


def aligned(clocks: DataFrame, stimuli: DataFrame, recording: str) -> DataFrame:
    """clocks with t from the recording's first stimulus (stimuli: recording, onset) on; a recording without one keeps its clock."""
    first = stimuli.groupBy(recording).agg(F.min("onset").alias("_zero"))
    return clocks.join(first, recording, "left").withColumn("t", F.col("t") - F.coalesce("_zero", F.lit(0))).drop("_zero")


def clock_weights(clocks: DataFrame, plane: list[str], frame: str, step: int) -> DataFrame:
    """(plane, frame, g, _w): how much each frame counts at the multiples g of `step`, linear between the plane's frames.

    clocks: plane, frame and t, a whole number. Of frames at one time the least counts; frames without a time don't.
    """
    one = clocks.where("t is not null").groupBy(*plane, "t").agg(F.min(frame).alias(frame))
    w = Window.partitionBy(*plane).orderBy("t")
    pairs = one.withColumns({"_t2": F.lead("t").over(w), "_f2": F.lead(frame).over(w)})
    first = F.ceil(F.col("t") / step).cast("long")
    last = F.when(F.col("_t2").isNull(), F.floor(F.col("t") / step)).otherwise(F.ceil(F.col("_t2") / step) - 1).cast("long")
    grid = pairs.where(first <= last).withColumn("g", F.explode(F.sequence(first, last))).withColumn("g", F.col("g") * step)
    later = F.when(F.col("_t2").isNull(), 0.0).otherwise((F.col("g") - F.col("t")) / (F.col("_t2") - F.col("t")))
    both = F.array(F.struct(F.col(frame).alias("f"), (1 - later).alias("w")), F.struct(F.col("_f2").alias("f"), later.alias("w")))
    spread = grid.select(*plane, "g", F.explode(both).alias("s"))
    return spread.where("s.w > 0").select(*plane, F.col("s.f").alias(frame), "g", F.col("s.w").alias("_w"))


def in_time(samples: DataFrame, weights: DataFrame, plane: list[str], frame: str, pixel: list[str], value: str) -> DataFrame:
    """(plane, pixel, t, value) on the common clock of `weights` (see clock_weights); nulls and absent samples as in in_space.

    Order and neighbours are found among a plane's frames, not among the samples of each of its pixels.
    """
    rows = samples.join(weights, [*plane, frame]).withColumnRenamed("g", "t")
    return _added(rows.select(*plane, *pixel, "t", value, "_w"), [*plane, *pixel, "t"], value)
