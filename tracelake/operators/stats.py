"""Tests, multiple-comparison correction and small fits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.functions.shared import cut
from tracelake.operators.columns import ratio, safe_corr


def _back(rows: DataFrame, found: DataFrame, on: list[str]) -> DataFrame:
    """Rows with the columns that `found` has beside those of `on`, nulls of `on` matching nulls."""
    own = found.select(*[F.col(c).alias(f"_on_{i}") if c in on else F.col(c) for i, c in enumerate(found.columns)])
    names = {c: f"_on_{i}" for i, c in enumerate(found.columns) if c in on}
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(names[c])) for c in on], F.lit(True))
    return rows.join(own, same).drop(*names.values())


def in_ranges(df: DataFrame, family: list[str], order: list[str], ranges: int | None = None) -> DataFrame:
    """Add _block: the rows in the order of family and `order`, cut into `ranges` (as many as their size asks for, if None).

    Rows equal in both share a range. Checkpointed, as the ranges' limits are drawn from a sample.
    """
    by = [*family, *order]
    return cut((df.repartitionByRange(ranges, *by) if ranges else df.repartitionByRange(*by)).withColumn("_block", F.spark_partition_id()))


def running(rows: DataFrame, family: list[str], order: list[str], name: str, value: Column, kind: str = "sum", down: bool = False) -> DataFrame:
    """Add `name`: sum, max or min of `value` over the family's rows up to this one (from the end, if down), equal ones included.

    rows: as from in_ranges. A range's own rows meet in one task; what comes before it is one number for each range, so a
    family of any size is spread over tasks.
    """
    total, join = {"sum": (F.sum, lambda x, y: F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0))), "max": (F.max, F.greatest), "min": (F.min, F.least)}[kind]
    turned = F.desc if down else F.asc
    before = Window.partitionBy(*family).orderBy(turned("_block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy(*family, "_block").agg(total(value).alias("_t")).select(*family, "_block", total("_t").over(before).alias("_before"))
    inside = Window.partitionBy(*family, "_block").orderBy(*[turned(c) for c in order]).rangeBetween(Window.unboundedPreceding, 0)
    return _back(rows.withColumn(name, total(value).over(inside)), blocks, [*family, "_block"]).withColumn(name, join(F.col("_before"), F.col(name))).drop("_before")


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Add `name`: each row's number from 1 in the order of columns that tell all rows apart, by ranges, so no task sees all rows."""
    return running(in_ranges(df, [], order), [], order, name, F.lit(1).cast("long")).drop("_block")


def harmonic(n: Column) -> Column:
    """1 + 1/2 + ... + 1/n; beyond 1,000 by the asymptotic series, whose error there is below 1e-14."""
    short = F.aggregate(F.sequence(F.lit(1).cast("long"), F.least(n, F.lit(1000).cast("long"))), F.lit(0.0), lambda a, i: a + 1 / i)
    return F.when(n < 1, 0.0).when(n <= 1000, short).otherwise(F.log(n) + 0.5772156649015329 + 1 / (2 * n) - 1 / (12.0 * n * n))


def false_discovery(df: DataFrame, family: list[str], p: str, q: float = 0.05, dependent: bool = False) -> DataFrame:
    """Add adjusted (Benjamini-Hochberg, or Benjamini-Yekutieli if dependent; may exceed 1), critical_p and reject in each family.

    Equal p values are counted first. A null p counts for nothing and gets null for adjusted and reject.
    """
    rows = in_ranges(df.groupBy(*family, p).agg(F.count(p).alias("_n")), family, [p])
    rows = running(_back(rows, rows.groupBy(*family).agg(F.sum("_n").alias("_m")), family), family, [p], "_k", F.col("_n"))
    rows = rows.withColumn("_c", harmonic(F.col("_m")) if dependent else F.lit(1.0))
    rows = rows.withColumn("_a", ratio(F.col(p) * F.col("_m") * F.col("_c"), F.col("_k")))
    passes = F.col(p) <= ratio(F.col("_k"), F.col("_m")) * q / F.col("_c")
    critical = rows.groupBy(*family).agg(F.coalesce(F.max(F.when(passes, F.col(p))), F.lit(0.0)).alias("critical_p"))
    rows = running(rows, family, [p], "_least", F.col("_a"), "min", down=True)
    found = _back(rows, critical, family).select(*family, p, F.when(F.col(p).isNotNull(), F.col("_least")).alias("adjusted"), "critical_p")
    return _back(df, found, [*family, p]).withColumn("reject", F.col(p) <= F.col("critical_p"))


def holm(df: DataFrame, family: list[str], p: str, tie: str, alpha: float = 0.05) -> DataFrame:
    """Add adjusted (running maximum of p (m - i + 1), at most 1) and reject in each family; rows are told apart by `tie`."""
    rows = in_ranges(df, family, [p, tie])
    rows = _back(rows, rows.groupBy(*family).agg(F.count("*").alias("_m")), family)
    rows = running(rows, family, [p, tie], "_i", F.lit(1))
    rows = running(rows.withColumn("_a", F.col(p) * (F.col("_m") - F.col("_i") + 1)), family, [p, tie], "_most", F.col("_a"), "max")
    rows = rows.withColumn("adjusted", F.least(F.lit(1.0), "_most"))
    return rows.withColumn("reject", F.col("adjusted") < alpha).drop("_block", "_m", "_i", "_a", "_most")


def permutation_p(observed: DataFrame, null: DataFrame, key: list[str]) -> DataFrame:
    """p: the share of null values at or above the observed one if that is not negative, else 1; missing values count as 0."""
    both = observed.join(null, key, "left").withColumns({"_o": F.coalesce("obs", F.lit(0.0)), "_n": F.coalesce("null_value", F.lit(0.0))})
    share = F.avg((F.col("_n") >= F.col("_o")).cast("double"))
    return both.groupBy(*key).agg(F.max("_o").alias("obs"), share.alias("_p")).select(*key, "obs", F.when(F.col("obs") >= 0, F.col("_p")).otherwise(1.0).alias("p"))


def ks_statistic(df: DataFrame, family: list[str], side: Column, value: str) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov distance between rows with and without `side`, by family, on counts per distinct value."""
    counts = in_ranges(df.groupBy(*family, value).agg(F.sum(side.cast("long")).alias("_a"), F.sum((~side).cast("long")).alias("_b")), family, [value])
    counts = _back(counts, counts.groupBy(*family).agg(F.sum("_a").alias("_na"), F.sum("_b").alias("_nb")), family)
    for c in ("_a", "_b"):
        counts = running(counts, family, [value], f"_to{c}", F.col(c))
    gap = F.abs(ratio(F.col("_to_a"), F.col("_na")) - ratio(F.col("_to_b"), F.col("_nb")))
    return counts.groupBy(*family).agg(F.max(gap).alias("d"))


def cohen_d(df: DataFrame, group: Column, value: str) -> DataFrame:
    """Effect size between the rows with and without `group`, with the pooled sample deviation."""
    a, b = F.when(group, F.col(value)), F.when(~group, F.col(value))
    sums = df.agg(F.count(a).alias("n1"), F.count(b).alias("n2"), F.avg(a).alias("m1"), F.avg(b).alias("m2"), F.var_samp(a).alias("v1"), F.var_samp(b).alias("v2"))
    pooled = F.sqrt(ratio((F.col("n1") - 1) * F.col("v1") + (F.col("n2") - 1) * F.col("v2"), F.col("n1") + F.col("n2") - 2))
    return sums.select("n1", "n2", ratio(F.col("m1") - F.col("m2"), pooled).alias("d"))


def circle(df: DataFrame, family: list[str], x: str, y: str) -> DataFrame:
    """Algebraic least-squares circle through points: xc, yc, r, from centred sums."""
    mean = df.groupBy(*family).agg(F.avg(x).alias("_mx"), F.avg(y).alias("_my"))
    u, v = F.col(x) - F.col("_mx"), F.col(y) - F.col("_my")
    s = {"uu": u * u, "vv": v * v, "uv": u * v, "uz": u * (u * u + v * v), "vz": v * (u * u + v * v)}
    sums = df.join(mean, family).groupBy(*family).agg(*[F.sum(e).alias(k) for k, e in s.items()], F.count("*").alias("n"), F.first("_mx").alias("mx"), F.first("_my").alias("my"))
    det = F.col("uu") * F.col("vv") - F.col("uv") * F.col("uv")
    uc = ratio(F.col("uz") * F.col("vv") - F.col("vz") * F.col("uv"), 2 * det)
    vc = ratio(F.col("vz") * F.col("uu") - F.col("uz") * F.col("uv"), 2 * det)
    sums = sums.withColumns({"_u": uc, "_v": vc})
    r = F.sqrt(F.col("_u") * F.col("_u") + F.col("_v") * F.col("_v") + (F.col("uu") + F.col("vv")) / F.col("n"))
    return sums.select(*family, (F.col("mx") + F.col("_u")).alias("xc"), (F.col("my") + F.col("_v")).alias("yc"), r.alias("r"))


def correlation_by(df: DataFrame, family: list[str], a: str, b: str) -> DataFrame:
    return df.groupBy(*family).agg(safe_corr(F.col(a), F.col(b)).alias("r"))
