"""Traces of components: what a movie holds of each, from sparse weights of pixels and a background.

Tables are long: movie (keys, pixel, t, v), spatial weights (keys, comp, pixel, w), temporal series (keys, comp, t, v), and the
same two for the background. Rows that repeat add up, a weight or a sample that isn't there is zero, and so is a null one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.functions.shared import stored
from tracelake.operators.columns import ratio

_SUMS = ["seen", "raw_seen", "own", "back", "raw_back", "c"]
_ENDS = ["c", "yf", "yr", "raw", "raw_back"]


def support(spatial: DataFrame, keys: list[str], share: float) -> DataFrame:
    """Add `u`: of the fewest pixels, greatest weight first (ties: smallest pixel first), that reach `share` of a component's
    energy, each the same, with unit energy together; zero for the others."""
    by = Window.partitionBy(*keys, "comp")
    ranked = by.orderBy(F.abs("w").desc(), "pixel")
    energy = F.col("w") * F.col("w")
    before = F.coalesce(F.sum(energy).over(ranked.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    inside = spatial.withColumn("_in", ((before < share * F.sum(energy).over(by)) & (F.col("w") != 0)).cast("double"))
    return inside.withColumn("u", F.coalesce(ratio(F.col("_in"), F.sqrt(F.sum("_in").over(by))), F.lit(0.0))).drop("_in")


def _unit(spatial: DataFrame, keys: list[str]) -> DataFrame:
    """Weights of unit energy, with the norm they had; components without energy are left out."""
    one = spatial.groupBy(*keys, "comp", "pixel").agg(F.sum(F.coalesce(F.nanvl("w", F.lit(None)), F.lit(0.0))).alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(*keys, "comp")))
    return one.withColumn("norm", norm).where("norm > 0").withColumn("w", F.col("w") / F.col("norm"))


def _scaled(temporal: DataFrame, unit: DataFrame, keys: list[str]) -> DataFrame:
    norms = unit.groupBy(*keys, "comp").agg(F.max("norm").alias("norm"))
    return temporal.join(norms, [*keys, "comp"]).select(*keys, "comp", "t", (F.coalesce(F.nanvl("v", F.lit(None)), F.lit(0.0)) * F.col("norm")).alias("v"))


def _sums(df: DataFrame, keys: list[str], **sums: Column) -> DataFrame:
    return df.select(*keys, "comp", "t", *[sums.get(s, F.lit(None).cast("double")).alias(s) for s in _SUMS])


def unmixed(movie: DataFrame, spatial: DataFrame, temporal: DataFrame, back_spatial: DataFrame, back_temporal: DataFrame, keys: list[str], share: float = 0.99) -> DataFrame:
    """For each component and frame: c (its own series, for weights of unit energy), yf (what the movie holds under its weights
    less what all components account for), yr (c and what is left of yf without the background), raw (the movie under its
    `support`, less the background) and raw_back (the background under its support).

    Frames are those of the movie under the component and those of its series; where the movie has none of its pixels, yf, yr
    and raw are null. The movie is joined with the weights once; all products then meet in one aggregation. Components meet by
    shared pixels only, and as sums: pairs without a common pixel never appear. The weights, which are used several times, are
    written first.
    """
    a = stored(support(_unit(spatial, keys), keys, share))
    b = stored(_unit(back_spatial, keys))
    c, f = _scaled(temporal, a, keys), _scaled(back_temporal, b, keys)
    v = F.coalesce(F.nanvl("v", F.lit(None)), F.lit(0.0))
    seen = _sums(movie.select(*keys, "pixel", "t", v.alias("v")).join(a, [*keys, "pixel"]), keys, seen=F.col("w") * F.col("v"), raw_seen=F.col("u") * F.col("v"))
    other = a.select(*keys, "pixel", F.col("comp").alias("other"), F.col("w").alias("w2"))
    own = a.join(other, [*keys, "pixel"]).groupBy(*keys, "comp", "other").agg(F.sum(F.col("w") * F.col("w2")).alias("g"))
    behind = a.join(b.select(*keys, "pixel", F.col("comp").alias("other"), F.col("w").alias("w2")), [*keys, "pixel"])
    behind = behind.groupBy(*keys, "comp", "other").agg(F.sum(F.col("w") * F.col("w2")).alias("g"), F.sum(F.col("u") * F.col("w2")).alias("h"))
    owned = _sums(own.join(c.withColumnRenamed("comp", "other"), [*keys, "other"]), keys, own=F.col("g") * F.col("v"))
    backed = _sums(behind.join(f.withColumnRenamed("comp", "other"), [*keys, "other"]), keys, back=F.col("g") * F.col("v"), raw_back=F.col("h") * F.col("v"))
    both = seen.unionByName(owned).unionByName(backed).unionByName(_sums(c, keys, c=F.col("v")))
    summed = both.groupBy(*keys, "comp", "t").agg(*[F.sum(s).alias(s) for s in _SUMS]).where("seen IS NOT NULL OR c IS NOT NULL")
    own_, back, raw_back, c_ = (F.coalesce(s, F.lit(0.0)) for s in ("own", "back", "raw_back", "c"))
    yf = F.col("seen") - own_
    return summed.select(*keys, "comp", "t", c_.alias("c"), yf.alias("yf"), (yf - back + c_).alias("yr"), (F.col("raw_seen") - raw_back).alias("raw"), raw_back.alias("raw_back"))


def extracted(parts: DataFrame, keys: list[str], p: float = 0.2, half: int = 50, base: float | None = None) -> DataFrame:
    """Inferred, filtered and raw traces of `unmixed` rows: for each its trend (percentile p of `half` frames to either side),
    df (what is above it), f (trend and background) and dfof (df over f; null where f is zero).

    The background is taken as it is in each frame, or as its percentile `base` over all frames of the component. Null values
    don't count in percentiles and stay null. A component's frames are one window.
    """
    by = Window.partitionBy(*keys, "comp")
    near = by.orderBy("t").rowsBetween(-half, half)
    trend = {"inferred": ("c", F.col("yf")), "filtered": ("yr", F.col("yf") - F.col("yr") + F.col("c")), "raw": ("raw", F.col("raw_back"))}
    out = parts
    out = out.withColumns({f"{name}_trend": F.when(F.col(signal).isNotNull(), F.percentile(F.col(signal), F.lit(p)).over(near)) for name, (signal, _) in trend.items()})
    out = out.withColumns({f"{name}_f": (level if base is None else F.percentile(level, F.lit(base)).over(by)) + F.col(f"{name}_trend") for name, (_, level) in trend.items()})
    out = out.withColumns({f"{name}_df": F.col(signal) - F.col(f"{name}_trend") for name, (signal, _) in trend.items()})
    return out.withColumns({f"{name}_dfof": ratio(F.col(f"{name}_df"), F.col(f"{name}_f")) for name in trend}).drop(*_ENDS)
