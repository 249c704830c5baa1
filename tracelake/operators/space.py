"""Geometry: points within a distance, crossings of levels and planes, directions, deviations, views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def near_points(points: DataFrame, others: DataFrame, d: float, key: str) -> DataFrame:
    """(key, n_near, least): how many of `others` with another key lie within d of each point, and the least distance.

    Both have key, x and y. Points meet at square cells of side d: one side is sent to its cell and the eight around it.
    """
    cell = lambda c, by: (F.floor(F.col(c) / d) + by).alias(f"c{c}")
    steps = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    here = points.select(key, "x", "y", F.explode(steps).alias("i")).select("*", F.explode(steps).alias("j"))
    here = here.select(key, "x", "y", cell("x", F.col("i")), cell("y", F.col("j")))
    there = others.select(F.col(key).alias("_key"), F.col("x").alias("_x"), F.col("y").alias("_y"), cell("x", F.lit(0)), cell("y", F.lit(0)))
    apart = F.sqrt(F.pow(F.col("x") - F.col("_x"), 2) + F.pow(F.col("y") - F.col("_y"), 2))
    near = here.join(there, ["cx", "cy"]).where(F.col(key) != F.col("_key")).withColumn("d", apart).where(F.col("d") <= d)
    found = near.groupBy(key).agg(F.count("*").alias("n_near"), F.min("d").alias("least"))
    return points.select(key).join(found, key, "left").select(key, F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "least")


def crossings(values: Column, level: float) -> Column:
    """Where (from 1, linear between samples) a series passes from one side of a level to the other."""
    v = lambda i: F.get(values, i) - level
    between = F.transform(F.sequence(F.lit(0), F.size(values) - 2), lambda i: F.when(v(i) * v(i + 1) < 0, i + 1 + v(i) / (v(i) - v(i + 1))))
    return F.when(F.size(values) >= 2, F.filter(between, lambda x: x.isNotNull())).otherwise(F.array().cast("array<double>"))


def distance(point: list[Column], ref: list[Column]) -> Column:
    return F.sqrt(sum((a - b) * (a - b) for a, b in zip(point, ref)))


def plane_crossing(a: list[Column], b: list[Column], ref: list[float], normal: list[float]) -> Column:
    """Where the segment from a to b crosses the plane through ref with that normal, as an array; null if it doesn't (or lies in it)."""
    side = lambda p: sum((x - r) * n for x, r, n in zip(p, ref, normal))
    u, v = side(a), side(b)
    t = F.try_divide(u, u - v)
    return F.when((u * v <= 0) & (u != v), F.array(*[x + t * (y - x) for x, y in zip(a, b)]))


def plane_hits(nodes: DataFrame, path: str, order: str, axes: list[str], ref: list[float], normal: list[float], most: float) -> DataFrame:
    """(path, node, at, d): of each path the crossing of the plane that is nearest to ref and within `most` of it."""
    w = Window.partitionBy(path).orderBy(order)
    a, b = [F.col(x) for x in axes], [F.lead(x).over(w) for x in axes]
    rows = nodes.withColumn("at", plane_crossing(a, b, ref, normal)).where("at is not null")
    rows = rows.withColumn("d", distance([F.get("at", F.lit(i)) for i in range(len(axes))], [F.lit(r) for r in ref])).where(F.col("d") <= most)
    best = rows.groupBy(path).agg(F.min_by(F.struct(F.col(order).alias("node"), "at", "d"), F.struct("d", order)).alias("x"))
    return best.select(path, "x.node", "x.at", "x.d")


def tangents(nodes: DataFrame, path: str, order: str, axes: list[str], step: int) -> DataFrame:
    """Each node less the one `step` after it on its path: adds t_<axis>, null at the end."""
    w = Window.partitionBy(path).orderBy(order)
    return nodes.select("*", *[(F.col(x) - F.lead(x, step).over(w)).alias(f"t_{x}") for x in axes])


def mean_direction(df: DataFrame, key: list[str], axes: list[str]) -> DataFrame:
    """Mean unit vector of each key, of length one, from its rows' vectors; zero vectors count for nothing."""
    length = F.sqrt(sum(F.col(x) * F.col(x) for x in axes))
    sums = df.groupBy(*key).agg(*[F.sum(F.try_divide(F.col(x), length)).alias(x) for x in axes])
    return sums.select(*key, *[F.try_divide(F.col(x), length).alias(x) for x in axes])


def jitter(df: DataFrame, key: str, axes: list[str]) -> DataFrame:
    """Each row's deviation from its key's centroid: adds j_<axis> and distance."""
    mean = df.groupBy(key).agg(*[F.avg(x).alias(f"_{x}") for x in axes])
    rows = df.join(mean, key).withColumns({f"j_{x}": F.col(x) - F.col(f"_{x}") for x in axes})
    return rows.withColumn("distance", F.sqrt(sum(F.col(f"j_{x}") * F.col(f"j_{x}") for x in axes))).drop(*[f"_{x}" for x in axes])


def mirrored(value: Column, low: Column, high: Column, flip: bool = True) -> Column:
    """A coordinate mirrored within its bounding box."""
    return high - value + low if flip else value


def without_gaps(df: DataFrame, path: str, order: str, value: str) -> DataFrame:
    """Paths without two missing values in a row; isolated ones become the mean of their neighbours, missing ends are dropped."""
    w = Window.partitionBy(path).orderBy(order)
    missing = F.col(value).isNull()
    rows = df.withColumns({"_p": F.lag(value).over(w), "_n": F.lead(value).over(w), "_first": F.lag(order).over(w).isNull(), "_last": F.lead(order).over(w).isNull(), "_two": missing & F.lag(missing, 1, False).over(w)})
    bad = rows.groupBy(path).agg(F.bool_or("_two").alias("_bad")).where("_bad").select(path)
    rows = rows.join(bad, path, "left_anti").where(~(missing & (F.col("_first") | F.col("_last"))))
    return rows.withColumn(value, F.coalesce(F.col(value), (F.col("_p") + F.col("_n")) / 2)).select(*df.columns)


def sphere_view(cx: Column, cy: Column, radius: Column, width: Column, height: Column, vfov: Column) -> Column:
    """A struct of the unit vector to a sphere's centre seen at pixel (cx, cy), and the angle of its radius, for a vertical field of view in degrees."""
    focal = height / (2 * F.tan(F.radians(vfov) / 2))
    x, y = cx - width / 2, cy - height / 2
    norm = lambda *v: F.sqrt(sum(a * a for a in v))
    n, edge = norm(x, y, focal), norm(x + radius, y, focal)
    cos = (x * (x + radius) + y * y + focal * focal) / (n * edge)
    return F.struct((x / n).alias("x"), (y / n).alias("y"), (focal / n).alias("z"), F.acos(F.least(F.lit(1.0), cos)).alias("angle"))
