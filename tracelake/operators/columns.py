"""Column helpers that settle the semantics of missing values, division and rounding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nan_to_null(v: Column) -> Column:
    return F.when(~F.isnan(v), v)


def ratio(a: Column, b: Column) -> Column:
    """a / b as a double, null where b is zero."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def steady_mean(v: Column) -> Column:
    """Mean of doubles that the order of summing doesn't change: sums are exact where all have at most 12 decimals and 16 digits before them."""
    exact = v.try_cast("decimal(28,12)")
    whole = F.bool_and(v.isNull() | F.coalesce(exact.cast("double") == v, F.lit(False)))
    return F.when(whole, F.try_divide(F.sum(exact).cast("double"), F.count(v))).otherwise(F.avg(v))


def safe_corr(a: Column, b: Column) -> Column:
    """Pearson correlation of pairs, null where either side is constant."""
    both = F.when(a.isNotNull() & b.isNotNull(), F.lit(1))
    x, y = a * both, b * both
    return F.when((F.stddev_pop(x) > 0) & (F.stddev_pop(y) > 0), ratio(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)))


def let(value: Column, body) -> Column:
    """body(value) with value computed once for each row, however often body uses it, also inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def midpoint_percentile(values: Column, p: float) -> Column:
    """Percentile p (0 to 100) of an array by the midpoint rule: the i-th of n sorted values stands at 100 (i - 0.5) / n; clamped."""
    s = F.sort_array(F.filter(values, lambda v: v.isNotNull()))
    n = F.size(s)
    at = F.greatest(F.lit(1.0), F.least(n.cast("double"), n * (p / 100) + 0.5))
    low = F.floor(at).cast("int")
    a, b = F.get(s, low - 1), F.get(s, F.least(low, n - 1))
    return F.when(n > 0, a + (b - a) * (at - low))


def ticks(ts: str = "ts") -> Column:
    """Microseconds since 2024-01-01 of a timestamp without time zone, whatever the session's zone."""
    return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'"), F.col(ts))


def long_form(df: DataFrame, key: str, values: str) -> DataFrame:
    """One row for each element of an array column: key, i (1 first), v as a double (NaN becomes null)."""
    return df.select(key, F.posexplode(values).alias("p", "e")).select(key, (F.col("p") + 1).alias("i"), nan_to_null(F.col("e").cast("double")).alias("v"))
