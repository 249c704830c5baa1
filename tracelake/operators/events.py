"""Event detection, intervals and joins in time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def islands(df: DataFrame, key: str, order: list[str], active: Column) -> DataFrame:
    """Runs of active rows in each key's order: key, onset and offset (row numbers from 1; the offset is exclusive), n."""
    w = Window.partitionBy(key).orderBy(*order)
    rows = df.withColumns({"_i": F.row_number().over(w), "_on": F.coalesce(active, F.lit(False))})
    rows = rows.withColumn("_new", (F.col("_on") & ~F.lag("_on", 1, False).over(w)).cast("int"))
    rows = rows.withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).where("_on")
    return rows.groupBy(key, "_run").agg(F.min("_i").cast("long").alias("onset"), (F.max("_i") + 1).cast("long").alias("offset"), F.count("*").alias("n")).drop("_run")


def bouts(df: DataFrame, key: str, t: str, gap: int, least: bool = False) -> DataFrame:
    """Events merged while the next follows within less than `gap` (or, if `least`, within `gap` too): key, first, last, n."""
    w = Window.partitionBy(key).orderBy(t)
    since = F.col(t) - F.lag(t).over(w)
    new = (since > gap) if least else (since >= gap)
    rows = df.withColumn("_new", F.coalesce(new.cast("int"), F.lit(1)))
    rows = rows.withColumn("_bout", F.sum("_new").over(w.rangeBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(key, "_bout").agg(F.min(t).alias("first"), F.max(t).alias("last"), F.count("*").alias("n")).drop("_bout")


def nearest(left: DataFrame, right: DataFrame, on: str, t: str, keep: str) -> DataFrame:
    """Each left row with the right row of its `on` that is nearest in time; the earlier wins ties. Columns near_t and near_<keep>.

    Both sides are put in one order and looked up backward and forward: no pairs are formed.
    """
    r = right.groupBy(on, t).agg(F.min(keep).alias(keep))
    rows = left.withColumn("_r", F.lit(None).cast("struct<t:bigint,k:bigint>")).unionByName(
        r.select(on, t, F.struct(F.col(t).cast("long").alias("t"), F.col(keep).cast("long").alias("k")).alias("_r")), allowMissingColumns=True
    )
    w = Window.partitionBy(on).orderBy(t)
    before = F.last("_r", ignorenulls=True).over(w.rangeBetween(Window.unboundedPreceding, 0))
    after = F.first("_r", ignorenulls=True).over(w.rangeBetween(0, Window.unboundedFollowing))
    rows = rows.withColumns({"_b": before, "_a": after}).where("_r is null")
    closer = F.col("_a.t") - F.col(t) < F.col(t) - F.col("_b.t")
    best = F.when(F.col("_b").isNull() | closer, F.col("_a")).otherwise(F.col("_b"))
    return rows.withColumn("_n", best).select(*left.columns, F.col("_n.t").alias("near_t"), F.col("_n.k").alias(f"near_{keep}"))


def within(samples: DataFrame, onsets: DataFrame, key: str, before: int, after: int) -> DataFrame:
    """Samples (key, t, ...) of [onset - before, onset + after) of the onsets (key, onset, ...) of the same key, with rel.

    An equi-join on the key and a time bucket as long as the window: each onset goes to the two or three that it touches.
    """
    width = before + after
    s = samples.withColumn("_b", F.floor(F.col("t") / width).cast("long"))
    o = onsets.withColumn("_b", F.explode(F.sequence(F.floor((F.col("onset") - before) / width).cast("long"), F.floor((F.col("onset") + after - 1) / width).cast("long"))))
    rel = F.col("t") - F.col("onset")
    return s.join(o, [key, "_b"]).where((rel >= -before) & (rel < after)).withColumn("rel", rel).drop("_b")


def trials(df: DataFrame, key: str, order: str, kind: str) -> DataFrame:
    """Each event as a trial that ends just before the key's next one: trial, of its kind's `occurrence`, start, end (null for the last)."""
    w = Window.partitionBy(key).orderBy(order)
    k = Window.partitionBy(key, kind).orderBy(order)
    return df.select("*", F.row_number().over(w).cast("long").alias("trial"), F.row_number().over(k).cast("long").alias("occurrence"), (F.lead(order).over(w) - 1).alias("end"))
