"""Two channels of an image against each other: a line fitted again and again to what is not above it, scores, and masks of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.functions.shared import stored
from tracelake.operators.images import components

#: Normalised intensities up to this count as none.
NONE = 0.005


def _deviation(v: Column) -> Column:
    """Sample deviation, 0 for one value."""
    return F.when(F.count(v) == 1, 0.0).otherwise(F.stddev_samp(v))


def cutoffs(window: float, step: float) -> list[float]:
    """The levels of y from which the rounds fit: 1 - window, then less by one step each, down to 0."""
    out: list[float] = []
    while 1 - window - len(out) * step >= 0:
        out.append(1 - window - len(out) * step)
    return out


def normalised(df: DataFrame, family: str, x: str, y: str, floor: float, outliers: float) -> DataFrame:
    """The rows that count, with u and v: x and y less their family's least, over its greatest.

    x has to exceed `floor`, and both u and v NONE; of these, rows whose u is over the mean by `outliers` deviations go.
    """
    number = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    rows = df.withColumns({"u": number(x), "v": number(y)}).where((F.col("u") > floor) & F.col("v").isNotNull() & F.col(family).isNotNull())
    ends = rows.groupBy(family).agg(*[f(c).alias(f"_{f.__name__}_{c}") for c in "uv" for f in (F.min, F.max)])
    scaled = lambda c: (F.col(c) - F.col(f"_min_{c}")) / F.nullif(F.col(f"_max_{c}"), F.lit(0.0))
    rows = rows.join(ends, family).withColumns({c: scaled(c) for c in "uv"}).drop(*ends.columns[1:]).where((F.col("u") > NONE) & (F.col("v") > NONE))
    far = rows.groupBy(family).agg((F.avg("u") + outliers * F.coalesce(_deviation(F.col("u")), F.lit(0.0))).alias("_far"))
    return rows.join(far, family).where("u <= _far").drop("_far")


def line(rows: DataFrame, family: str, window: float = 0.7, step: float = 0.02, deviations: float = 3.0) -> DataFrame:
    """(family, slope, level, below) of each family's line v = slope * u + level; below is the deviation of the negative residuals.

    A residual is the line less v. Each round fits the rows from its cutoff of v on, without those whose residual from the
    round before exceeds `deviations` times that round's deviation of negative residuals over all rows; the last fit takes all
    rows without them. Only sums by family pass from round to round, as a written table, so a lost executor costs one round.
    """
    residual = F.col("slope") * F.col("u") + F.col("level") - F.col("v")
    negative = _deviation(F.when(residual < 0, residual))
    fits = lambda wanted: [f(F.when(wanted, F.col("v")), F.when(wanted, F.col("u"))).alias(n) for f, n in ((F.regr_slope, "slope"), (F.regr_intercept, "level"))]
    # Where a round has no line or no negative residual, nothing is left out in the next.
    inside = F.coalesce(residual <= F.col("most"), F.lit(True))
    lines = rows.select(family).distinct().select(family, *[F.lit(None).cast("double").alias(c) for c in ("slope", "level", "most")])
    for least in cutoffs(window, step):
        fit = rows.join(lines, family).groupBy(family).agg(*fits(inside & (F.col("v") >= least)))
        fit = stored(fit)
        spread = rows.join(fit, family).groupBy(family).agg((deviations * negative).alias("most"))
        lines = stored(fit.join(spread, family))
    kept = rows.join(lines, family).where(inside).drop("slope", "level", "most")
    last = stored(kept.groupBy(family).agg(*fits(F.lit(True))))
    return last.join(kept.join(last, family).groupBy(family).agg(negative.alias("below")), family)


def scores(df: DataFrame, family: str, x: str, y: str, floor: float = 25.0, outliers: float = 1e3, window: float = 0.7, step: float = 0.02, deviations: float = 3.0) -> DataFrame:
    """The rows that count (see normalised), with `score`: how far v lies below the family's line, in deviations of what lies above it.

    Null, NaN and dim values have no row; a family without a line (fewer than two values of u) or without rows above it has
    null scores.
    """
    rows = stored(normalised(df, family, x, y, floor, outliers))
    fitted = rows.join(line(rows, family, window, step, deviations), family)
    return fitted.withColumn("score", (F.col("slope") * F.col("u") + F.col("level") - F.col("v")) / F.nullif(F.col("below"), F.lit(0.0))).drop("slope", "level", "below", "u", "v")


def majority(pixels: DataFrame, domain: DataFrame, key: str, size: int) -> DataFrame:
    """The median filter of a mask: pixels (key, y, x) of domain with more than half of the size by size around them in `pixels`; beyond the image is nothing."""
    reach = size // 2
    steps = F.array(*[F.struct(F.lit(a).alias("dy"), F.lit(b).alias("dx")) for a in range(-reach, reach + 1) for b in range(-reach, reach + 1)])
    spread = pixels.select(key, "y", "x").distinct().select(key, "y", "x", F.explode(steps).alias("d")).select(key, (F.col("y") + F.col("d.dy")).alias("y"), (F.col("x") + F.col("d.dx")).alias("x"))
    dense = spread.groupBy(key, "y", "x").count().where(F.col("count") > size * size // 2).drop("count")
    return dense.join(domain.select(key, "y", "x").distinct(), [key, "y", "x"], "left_semi")


def mask(scored: DataFrame, domain: DataFrame, key: str, threshold: float = 1.0, size: int = 3, least: int = 100, last: int = 100) -> DataFrame:
    """(key, y, x) of the mask: of components of `least` pixels with a positive score the pixels above `threshold`, median filtered, in components of `last`.

    scored: key, y, x, score; domain: all pixels of the images. Stored scores can be masked again with other limits.
    """
    positive = scored.where((F.col("score") > 0) & ~F.isnan("score")).select(key, "y", "x", "score")
    whole = components(positive, key, least).select(key, "y", "x")
    above = positive.where(F.col("score") > threshold).join(whole, [key, "y", "x"], "left_semi")
    return components(stored(majority(above, domain, key, size)), key, last).select(key, "y", "x")
