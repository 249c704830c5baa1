"""Responses to stimuli: baselines, averages over trials, projections, triggered averages, stimulus intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.operators.columns import ratio, steady_mean
from tracelake.operators.events import bouts
from tracelake.operators.stats import numbered


def zscored_by(df: DataFrame, key: str, values: list[str]) -> DataFrame:
    """The values of each key in population standard deviations from its mean; null for a constant one. Sums meet by key first."""
    stats = df.groupBy(key).agg(*[f(c).alias(f"_{n}_{c}") for c in values for n, f in (("m", F.avg), ("s", F.stddev_pop))])
    rows = df.join(stats, key)
    return rows.select(*[ratio(F.col(c) - F.col(f"_m_{c}"), F.col(f"_s_{c}")).alias(c) if c in values else c for c in df.columns])


def trial_average(pairs: DataFrame, key: list[str], bin_of: Column, values: list[str]) -> DataFrame:
    """Mean over trials of each value, by key and bin of the time since onset: key, rel_bin, values, n."""
    return pairs.withColumn("rel_bin", bin_of).groupBy(*key, "rel_bin").agg(*[F.avg(c).alias(c) for c in values], F.count("*").alias("n"))


def median_over(df: DataFrame, levels: list[list[str]], value: str) -> DataFrame:
    """Medians of medians: of `value` by the first level's columns, then of those by the next level's, and so on."""
    for columns in levels:
        df = df.groupBy(*columns).agg(F.percentile(value, F.lit(0.5)).alias(value))
    return df


def at_rounded_time(samples: DataFrame, onsets: DataFrame, key: str, t: str, step: int) -> DataFrame:
    """Samples with the onsets of their key at the same time, both rounded (half up) to multiples of `step`: an equi-join."""
    slot = lambda c: F.floor((F.col(c) + step // 2) / step).cast("long")
    return samples.withColumn("slot", slot(t)).join(onsets.withColumn("slot", slot("onset")), [key, "slot"])


def frames_before(samples: DataFrame, onset_index: DataFrame, key: str, index: str, n: int) -> DataFrame:
    """Samples that are 1 to n frames before an onset's frame (column onset_index): adds offset from -n to -1."""
    asked = onset_index.withColumn("offset", F.explode(F.sequence(F.lit(-n), F.lit(-1)))).withColumn(index, F.col("onset_index") + F.col("offset"))
    return samples.join(asked, [key, index])


def projections(df: DataFrame, key: list[str], over: str, value: str, base_mean: str, base_sd: str) -> DataFrame:
    """Maxima over `over` (planes, say) of F - F0, (F - F0) / F0, F and (F - F0) / sd0: key, max_df, max_dff, max_f, max_snr."""
    change = F.col(value) - F.col(base_mean)
    made = {"max_df": change, "max_dff": ratio(change, F.col(base_mean)), "max_f": F.col(value), "max_snr": ratio(change, F.col(base_sd))}
    return df.groupBy(*key).agg(*[F.max(e).alias(n) for n, e in made.items()])


def bright_mean(df: DataFrame, key: list[str], most: str, value: str, least: float, n: int) -> DataFrame:
    """Mean of `value` over a key's frames whose maximum is above `least`; null with fewer than n of them."""
    bright = F.col(most) > least
    return df.groupBy(*key).agg(F.when(F.count_if(bright) >= n, F.avg(F.when(bright, F.col(value)))).alias("mean"), F.count_if(bright).alias("n"))


def triggered_average(samples: DataFrame, pulses: DataFrame, key: str, index: str, value: str, before: int, after: int) -> DataFrame:
    """Mean sample by its place around the pulses (key, at, width) of the most frequent width (the least of equally frequent ones)."""
    modal = pulses.groupBy("width").count().orderBy(F.desc("count"), "width").limit(1).select("width")
    own = pulses.join(F.broadcast(modal), "width").select(key, "at")  # a single row
    asked = own.withColumn("offset", F.explode(F.sequence(F.lit(-before), F.lit(after)))).withColumn(index, F.col("at") + F.col("offset"))
    return samples.join(asked, [key, index]).groupBy("offset").agg(F.avg(value).alias("mean"), F.count("*").alias("n"))


def subtracted(df: DataFrame, key: str, level: Column, values: Column, by: str = "mean") -> DataFrame:
    """Add `corrected`: values less the mean (or median) of those of the key where `level` holds."""
    base = steady_mean(F.when(level, values.cast("double"))) if by == "mean" else F.percentile(F.when(level, values), F.lit(0.5))
    return df.join(df.groupBy(key).agg(base.alias("_base")), key).withColumn("corrected", values - F.col("_base")).drop("_base")


def pulses_above(df: DataFrame, key: str, t: str, value: Column, before: int, level: float, gap: int) -> DataFrame:
    """Intervals in which value exceeds, by `level` in size, its mean over the times before `before`; closer than `gap`, they merge."""
    corrected = subtracted(df, key, F.col(t) < before, value)
    return bouts(corrected.where(F.abs("corrected") > level), key, t, gap)


def template_onsets(played: DataFrame, templates: DataFrame, key: str, order: str, template: str, gap: int) -> DataFrame:
    """Stimulus intervals of templates played one after another: key, first, last, n of runs of active samples closer than `gap`.

    played: key, order, template; templates: template, length, active (sample numbers from 0). A key's templates follow each
    other without pause.
    """
    length = templates.select(template, "length")
    start = F.sum("length").over(Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    placed = played.join(length, template).withColumn("_start", F.coalesce(start, F.lit(0)))
    active = placed.join(templates.select(template, "active"), template).select(key, "_start", F.explode("active").alias("_a")).select(key, (F.col("_start") + F.col("_a")).alias("t"))
    return bouts(active, key, "t", gap)


def logged_onsets(df: DataFrame, key: str, start: str, pre: int, post: int) -> DataFrame:
    """Onset and offset of each stimulus of a log of trial starts: start + pre + 1, and the next start - post (null for the last)."""
    following = F.lead(start).over(Window.partitionBy(key).orderBy(start))
    return df.select(key, start, (F.col(start) + pre + 1).alias("onset"), (following - post).alias("offset"))


def common_range(df: DataFrame, key: list[str], part: str, t: str, step: int) -> DataFrame:
    """The times that all parts of a key cover, on multiples of `step`: key, first, last."""
    ends = df.groupBy(*key, part).agg(F.min(t).alias("_a"), F.max(t).alias("_b")).groupBy(*key).agg(F.max("_a").alias("_a"), F.min("_b").alias("_b"))
    return ends.select(*key, (F.ceil(F.col("_a") / step) * step).cast("long").alias("first"), (F.floor(F.col("_b") / step) * step).cast("long").alias("last"))


def repaired_shift(df: DataFrame, key: str, order: str, axes: list[str], span: int, most: float, most_total: float) -> DataFrame:
    """Smoothed shifts, an axis set to 0 if it leaves its smoothed course by more than `most` once or by `most_total` in all."""
    half = span // 2
    w = Window.partitionBy(key).orderBy(order)
    rows = df
    for a in axes:
        # The frame shrinks evenly at both ends: running sums at its two borders.
        rows = rows.withColumns({f"_c_{a}": F.sum(a).over(w.rowsBetween(Window.unboundedPreceding, 0)), "_i": F.row_number().over(w), "_n": F.count("*").over(Window.partitionBy(key))})
    k = F.least(F.lit(half), F.col("_i") - 1, F.col("_n") - F.col("_i"))
    for a in axes:
        upper = F.coalesce(*[F.when(k == j, F.lead(f"_c_{a}", j).over(w)) for j in range(half + 1)])
        lower = F.coalesce(*[F.when(k == j, F.coalesce(F.lag(f"_c_{a}", j + 1).over(w), F.lit(0.0))) for j in range(half + 1)])
        rows = rows.withColumn(f"_s_{a}", (upper - lower) / (2 * k + 1))
    off = lambda a: F.abs(F.col(a) - F.col(f"_s_{a}"))
    worst = rows.groupBy(key).agg(*[((F.max(off(a)) > most) | (F.sum(off(a)) > most_total)).alias(f"_bad_{a}") for a in axes])
    rows = rows.join(worst, key)
    return rows.select(*df.columns, *[F.when(F.col(f"_bad_{a}"), 0.0).otherwise(F.col(f"_s_{a}")).alias(f"smooth_{a}") for a in axes])


def summed_shifts(df: DataFrame, key: list[str], axes: list[str], scale: dict[str, float] | None = None) -> DataFrame:
    """Shifts added up over the iterations of a key, in units of `scale` for each axis."""
    return df.groupBy(*key).agg(*[(F.sum(a) * float((scale or {}).get(a, 1.0))).alias(a) for a in axes])


def mean_shifts(df: DataFrame, key: list[str], axes: list[str], zeroed: tuple[str, ...] = ()) -> DataFrame:
    """Mean shift over planes; the axes of `zeroed` are set to 0."""
    return df.groupBy(*key).agg(*[(F.lit(0.0) if a in zeroed else F.avg(a)).alias(a) for a in axes])


def responsive(df: DataFrame, key: str, value: str, low: float, high: float, least: float, scale: Column) -> DataFrame:
    """Keys whose range between two percentiles, over `scale`, exceeds `least`: key, score."""
    score = ratio(F.percentile(value, F.lit(high)) - F.percentile(value, F.lit(low)), scale)
    return df.groupBy(key).agg(score.alias("score")).where(F.col("score") > least)


def cluster_traces(df: DataFrame, cluster: str, t: str, value: str, individual: str) -> DataFrame:
    """Mean trace of each cluster: cluster, t, mean, individuals (different ones)."""
    return df.groupBy(cluster, t).agg(F.avg(value).alias("mean"), F.count_distinct(individual).alias("individuals"))


def relabelled(df: DataFrame, label: str, order: str) -> DataFrame:
    """Labels renumbered from 1 by where each first occurs in the order: adds new_label."""
    first = df.groupBy(label).agg(F.min(order).alias("_first"))
    return df.join(numbered(first, ["_first", label], "new_label").drop("_first"), label)
