"""Frames of recordings: names, order, planes, channels, chunks, scaling and metadata."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.operators.columns import ratio
from tracelake.operators.stats import numbered

#: Which underscore-separated parts of a recording's name make the subject, its number and the repetition, by layout (0 first).
LAYOUTS = {0: ([0], 1, 2), 1: ([0, 1], None, 2), 2: ([0, 1, 2], None, None), 3: ([0], 1, 3)}


def name_keys(name: Column, layout: int) -> Column:
    """A struct of subject, subject_number and repetition from a name of parts; null where a part is missing or no number."""
    subject, number, repetition = LAYOUTS[layout]
    parts = F.split(name, r"\s*_\s*")
    part = lambda i: F.lit(None).cast("int") if i is None else F.get(parts, F.lit(i)).try_cast("int")
    whole = F.when(F.size(parts) > subject[-1], F.array_join(F.slice(parts, 1, len(subject)), "_"))
    return F.struct(whole.alias("subject"), part(number).alias("subject_number"), part(repetition).alias("repetition"))


def stacked(df: DataFrame, key: str, order: list[str], planes: int) -> DataFrame:
    """Frames of each key, numbered in order over all its parts, as stack and plane (from 0); an incomplete last stack is dropped."""
    w = Window.partitionBy(key)
    rows = df.withColumns({"_i": F.row_number().over(w.orderBy(*order)) - 1, "_n": F.count("*").over(w)})
    rows = rows.withColumns({"stack": F.floor(F.col("_i") / planes).cast("long"), "plane": F.pmod("_i", F.lit(planes)).cast("long")})
    return rows.where(F.col("stack") < F.floor(F.col("_n") / planes)).drop("_i", "_n")


def without(df: DataFrame, key: str, t: str, gone: DataFrame) -> DataFrame:
    """Rows of df whose (key, t) are not in `gone`, renumbered within their key: index from 0."""
    left = df.join(gone.select(key, t).distinct(), [key, t], "left_anti")
    return left.withColumn("index", (F.row_number().over(Window.partitionBy(key).orderBy(t)) - 1).cast("long"))


def without_plane(df: DataFrame, plane: str, which: Column) -> DataFrame:
    """Rows of other planes than `which`, with those after it moved up by one."""
    return df.where(F.col(plane) != which).withColumn(plane, F.when(F.col(plane) > which, F.col(plane) - 1).otherwise(F.col(plane)))


def voxel_size(field: Column, zoom: Column, pixels: Column, step: float) -> Column:
    """Side of a pixel, field / (zoom * pixels), rounded to multiples of `step`."""
    return F.round(ratio(field, zoom * pixels) / step) * step


def clipped_sums(df: DataFrame, group: list[str], volume: str, n: int, value: str, shift: float) -> DataFrame:
    """Sums of n volumes each of value + shift, negative ones as 0: group, block (of n volumes, from 0), total."""
    block = F.floor(F.col(volume) / n).cast("long").alias("block")
    return df.groupBy(*group, block).agg(F.sum(F.greatest(F.col(value) + shift, F.lit(0.0))).alias("total"))


def shifted_channel(df: DataFrame, channel: str, which, value: str, group: list[str]) -> DataFrame:
    """One channel's rows, with its least value in each group moved to 0."""
    own = df.where(F.col(channel) == which)
    return own.join(own.groupBy(*group).agg(F.min(value).alias("_least")), group).withColumn(value, F.col(value) - F.col("_least")).drop("_least")


def merged_channels(df: DataFrame, key: list[str], channel: str, value: str, channels: list) -> DataFrame:
    """One row for each key with a column for each channel (mean of its rows)."""
    return df.groupBy(*key).pivot(channel, channels).agg(F.avg(value))


def scaled_to(value: Column, most: Column | None, bits: int) -> Column:
    """value, or value / most * 2**bits, rounded half away from zero and clamped to `bits` unsigned bits."""
    scaled = value if most is None else ratio(value, most) * float(1 << bits)
    return F.least(F.greatest(F.round(scaled), F.lit(0.0)), F.lit(float((1 << bits) - 1))).cast("long")


def chunk(order: list[str], size: int, key: list[str]) -> Column:
    """Number (from 1) of the run of at most `size` rows of a key that a row is in."""
    return F.ceil(F.row_number().over(Window.partitionBy(*key).orderBy(*order)) / size).cast("long")


def concatenated(df: DataFrame, key: str, values: str) -> DataFrame:
    """Elements of all arrays of a key, arrays in the order of `values`' owner: key, source, position, value."""
    return df.select(F.col(key).alias("source"), F.posexplode(values).alias("position", "value"))


def depth_corrected(value: Column, z: Column, z0: float, length: float) -> Column:
    """value * exp((z - z0) / length); zeros stay."""
    return F.when(value == 0, value).otherwise(value * F.exp((z - z0) / length))


def with_defaults(given: dict, defaults: dict) -> dict:
    """Defaults overlaid by the given options; unknown names are ignored."""
    return {k: given.get(k, v) for k, v in defaults.items()}


def union_all(tables: list[DataFrame], columns: list[str]) -> DataFrame:
    """Rows of all tables with these columns, found by name in any case; missing ones are null."""

    def pruned(df: DataFrame) -> DataFrame:
        there = {c.lower(): c for c in df.columns}
        return df.select(*[F.col(there[c.lower()]).alias(c) for c in columns if c.lower() in there])

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(pruned, tables))


def bracketed(value: Column, i: int) -> Column:
    """The i-th (from 0) element of a bracketed list of numbers, as text "[a, b, c]"."""
    return F.get(F.from_json(value, "array<double>"), F.lit(i))


def homogenised(df: DataFrame, key: str, t: str, expected: Column) -> DataFrame:
    """Frame times of each key, cut to or continued (by the last difference) up to its `expected` count: key, frame (from 1), time."""
    w = Window.partitionBy(key)
    rows = df.select(key, F.col(t).alias("time"), F.row_number().over(w.orderBy(t)).cast("long").alias("frame"), (F.col(t) - F.lag(t).over(w.orderBy(t))).alias("_d"), F.count("*").over(w).alias("_n"), expected.cast("long").alias("_want"))
    kept = rows.where(F.col("frame") <= F.col("_want")).select(key, "frame", "time")
    last = rows.where((F.col("frame") == F.col("_n")) & (F.col("_n") < F.col("_want")))
    more = last.select(key, "time", "_d", "_n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_want") - F.col("_n"))).alias("_k"))
    return kept.unionByName(more.select(key, (F.col("_n") + F.col("_k")).alias("frame"), (F.col("time") + F.col("_d") * F.col("_k")).alias("time")))


def with_gaps(df: DataFrame, key: str, block: str, order: str, n: int) -> DataFrame:
    """Each key's rows with n empty rows between blocks, and a new clock: key, block, value columns, clock (from 0)."""
    edge = df.groupBy(key, block).agg(F.max(order).alias(order))
    later = Window.partitionBy(key).orderBy(block)
    gaps = edge.withColumn("_more", F.lead(block).over(later).isNotNull()).where("_more").drop("_more")
    gaps = gaps.withColumn("_gap", F.explode(F.sequence(F.lit(1), F.lit(n))))
    rows = df.withColumn("_gap", F.lit(0)).unionByName(gaps, allowMissingColumns=True)
    return rows.withColumn("clock", (F.row_number().over(Window.partitionBy(key).orderBy(block, order, "_gap")) - 1).cast("long")).drop("_gap")


def by_position(left: DataFrame, right: DataFrame, key: str, left_order: list[str], right_order: list[str]) -> DataFrame:
    """The k-th row of a key on the left with its k-th row on the right; rows without a counterpart are dropped. Adds position (from 1)."""
    a = left.withColumn("position", F.row_number().over(Window.partitionBy(key).orderBy(*left_order)).cast("long"))
    b = right.withColumn("position", F.row_number().over(Window.partitionBy(key).orderBy(*right_order)).cast("long"))
    return a.join(b, [key, "position"])


def first_seen_ids(df: DataFrame, name: str, order: str) -> DataFrame:
    """(name, id): names numbered from 1 by where they first occur."""
    first = df.groupBy(name).agg(F.min(order).alias("_first"))
    return numbered(first, ["_first", name], "id").select(name, "id")


def containing(rows: DataFrame, text: str, keys: DataFrame, key: str = "k") -> DataFrame:
    """Rows with each key that their text contains, once for a key however often it does and however often the key is given.

    Only pieces as long as some key are looked up, by an equi-join: a text of n characters has at most n for each length
    that keys have. The lengths are one row. Rows that repeat are one; null texts and keys count for nothing, an empty key
    is part of every text.
    """
    known = keys.where(F.col(key).isNotNull()).select(F.col(key).alias("_piece")).distinct()
    lengths = known.agg(F.collect_set(F.length("_piece")).alias("_lengths"))
    at = F.length(text)
    fitting = F.filter("_lengths", lambda n: n <= at)
    pieces = F.flatten(F.transform(fitting, lambda n: F.transform(F.sequence(F.lit(1), at - n + 1), lambda i: F.substring(F.col(text), i, n))))
    cut_up = rows.where(F.col(text).isNotNull()).crossJoin(F.broadcast(lengths)).select(*rows.columns, F.explode(F.array_distinct(pieces)).alias("_piece"))
    return cut_up.join(known, "_piece").select(*rows.columns, F.col("_piece").alias(key)).distinct()
