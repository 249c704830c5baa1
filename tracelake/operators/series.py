"""Operators on ordered series: one array of values per row, or one row per sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.operators.columns import let, ratio


def doubles(values: str) -> Column:
    """An array column as doubles, NaN as null."""
    return F.transform(F.col(values), lambda v: F.when(~F.isnan(v), v.cast("double")))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + F.coalesce(v, F.lit(0.0)))


def _count(values: Column) -> Column:
    return F.size(F.filter(values, lambda v: v.isNotNull()))


def mean(values: Column) -> Column:
    return ratio(_sum(values), _count(values))


def centred(values: Column) -> Column:
    return let(values, lambda x: let(mean(x), lambda m: F.transform(x, lambda v: v - m)))


def sd_pop(values: Column) -> Column:
    return let(centred(values), lambda x: F.sqrt(ratio(_sum(F.transform(x, lambda v: v * v)), _count(x))))


def zscored(values: Column) -> Column:
    """(v - mean) / population deviation; null for a constant series."""
    return let(centred(values), lambda x: let(sd_pop(x), lambda s: F.transform(x, lambda v: ratio(v, s))))


def p_normed(values: Column, p: float = 2.0) -> Column:
    norm = F.pow(_sum(F.transform(values, lambda v: F.pow(F.abs(v), F.lit(p)))), F.lit(1 / p))
    return let(norm, lambda n: F.transform(values, lambda v: ratio(v, n)))


def rms_normed(values: Column) -> Column:
    rms = F.sqrt(ratio(_sum(F.transform(values, lambda v: v * v)), _count(values)))
    return let(rms, lambda r: F.transform(values, lambda v: ratio(v, r)))


def blurred(values: Column, sigma: float, size: int) -> Column:
    """Gaussian filter of `size` taps (made odd), normalised, with zeros beyond the ends."""
    half = size // 2
    taps = F.array(*[F.exp(F.lit(-(k * k) / (2 * sigma * sigma))) for k in range(-half, half + 1)])
    total = F.aggregate(taps, F.lit(0.0), lambda a, t: a + t)
    return F.transform(
        values,
        lambda _, i: F.aggregate(F.sequence(F.lit(-half), F.lit(half)), F.lit(0.0), lambda a, k: a + F.get(taps, k + half) / total * F.coalesce(F.get(values, i + k), F.lit(0.0))),
    )


def moving_average(values: Column, span: int) -> Column:
    """Mean over a frame of `span` (made odd) that shrinks evenly at the ends."""
    half = (span - 1) // 2
    n = F.size(values)

    def at(_, i):
        k = F.least(F.lit(half), i, n - 1 - i)
        return mean(F.slice(values, i - k + 1, 2 * k + 1))

    return F.transform(values, at)


def smoothed_energy(values: Column, span: int) -> Column:
    """Squares over their sum, averaged as by moving_average."""
    shares = let(F.transform(values, lambda v: v * v), lambda x: let(_sum(x), lambda s: F.transform(x, lambda v: ratio(v, s))))
    return let(shares, lambda x: moving_average(x, span))


def lagged_products(values: Column, lags: int) -> Column:
    """Sum of v(i) v(i + lag) over sum of squares, for lags 0 to `lags`; the series is not centred."""
    square = _sum(F.transform(values, lambda v: v * v))
    return let(square, lambda q: F.transform(F.sequence(F.lit(0), F.lit(lags)), lambda k: ratio(_sum(F.transform(values, lambda v, i: v * F.get(values, i + k))), q)))


def third_moment(values: Column, d: int, k: int) -> Column:
    """Mean over the series of x(i) x(i + d) x(i + k), centred, with nothing beyond the end."""
    return let(centred(values), lambda x: ratio(_sum(F.transform(x, lambda v, i: v * F.get(x, i + d) * F.get(x, i + k))), F.size(x)))


def gap_filled(df: DataFrame, key: str, order: str, value: str, side: str = "both") -> DataFrame:
    """Add `filled`: missing values by the mean of the nearest ones before and after, or by the one that there is; or by one side only."""
    w = Window.partitionBy(key).orderBy(order)
    prev = F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first(value, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
    by = {"both": F.coalesce((prev + after) / 2, prev, after), "prev": prev, "next": after}[side]
    return df.withColumn("filled", F.coalesce(F.col(value), by))


def running_percentile(df: DataFrame, key: str, order: str, value: str, p: float, half: int) -> DataFrame:
    w = Window.partitionBy(key).orderBy(order).rowsBetween(-half, half)
    return df.withColumn("running", F.percentile(F.col(value), F.lit(p)).over(w))


def lag_columns(df: DataFrame, key: str, order: str, value: str, lags: range, pad: float = 0.0) -> DataFrame:
    """A column for each lag (negative looks ahead), with `pad` beyond the ends and for missing values."""
    w = Window.partitionBy(key).orderBy(order)
    name = lambda k: f"lag_{'m' if k < 0 else 'p'}{abs(k)}"
    return df.select("*", *[F.coalesce(F.lag(value, k).over(w), F.lit(pad)).alias(name(k)) for k in lags])


def interpolated(samples: DataFrame, key: str | list[str], t: str, value: str, step: int) -> DataFrame:
    """Linear interpolation of each key's samples on multiples of `step` (key, t, v), null outside the samples' range.

    Each pair of neighbouring samples yields the grid points from the first up to, not including, the second: no join. Of
    samples at one time the first by value counts.
    """
    key = [key] if isinstance(key, str) else key
    one = samples.groupBy(*key, t).agg(F.min(value).alias("_v"))
    w = Window.partitionBy(*key).orderBy(t)
    pairs = one.withColumns({"_t2": F.lead(t).over(w), "_v2": F.lead("_v").over(w)})
    first = F.ceil(F.col(t) / step).cast("long")
    last = F.when(F.col("_t2").isNull(), F.floor(F.col(t) / step)).otherwise(F.ceil(F.col("_t2") / step) - 1).cast("long")
    grid = pairs.where(first <= last).withColumn("_g", F.explode(F.sequence(first, last))).withColumn("_g", F.col("_g") * step)
    v = F.when(F.col("_g") == F.col(t), F.col("_v")).otherwise(F.col("_v") + (F.col("_v2") - F.col("_v")) * ratio(F.col("_g") - F.col(t), F.col("_t2") - F.col(t)))
    return grid.select(*key, F.col("_g").alias("t"), v.alias("v"))
