"""Images and volumes as long rows of pixels (key, y, x, value; volumes with z too), or as arrays, one frame a row."""

from __future__ import annotations

from functools import reduce
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.functions.shared import stored
from tracelake.functions.ship import ship
from tracelake.operators.columns import ratio, safe_corr
from tracelake.operators.graphs import connected_components

#: Pixels on a side of the squares that are labelled in one place.
SIDE = 256


def pruned(df: DataFrame, key: str, masked: Column) -> DataFrame:
    """Pixels (key, y, x, ...) of rows and columns of their image that are not masked throughout."""
    rows = df.withColumn("_m", masked)
    for axis in ("y", "x"):
        whole = rows.groupBy(key, axis).agg(F.bool_and("_m").alias("_all"))
        df = df.join(whole.where("not _all").select(key, axis), [key, axis], "left_semi")
    return df


def blurred_2d(values: Column, height: int, width: int, sigma: float, size: int) -> Column:
    """Separable Gaussian of `size` taps a side (made odd) over an image that is an array by rows, with zeros beyond its edges."""
    half = size // 2
    taps = F.array(*[F.exp(F.lit(-(k * k) / (2 * sigma * sigma))) for k in range(-half, half + 1)])
    total = F.aggregate(taps, F.lit(0.0), lambda a, t: a + t)

    def along(step: int, place, length: int):
        def made(image: Column) -> Column:
            def at(_, i):
                tap = lambda a, k: a + F.when((place(i) + k).between(0, length - 1), F.get(taps, k + half) / total * F.coalesce(F.get(image, i + k * step), F.lit(0.0))).otherwise(0.0)
                return F.aggregate(F.sequence(F.lit(-half), F.lit(half)), F.lit(0.0), tap)

            return F.transform(image, at)

        return made

    rows = along(1, lambda i: i % width, width)(values)
    return F.get(F.transform(F.array(rows), along(width, lambda i: F.floor(i / width).cast("int"), height)), F.lit(0))


def _touching(values: str, shape: tuple[int, ...]) -> Column:
    """Of an array by rows of that shape: a struct (a, b, u, v) of places and values for all cells a < b that touch, corners included.

    One expression for each direction, so the plan does not grow with the image.
    """
    strides = [1]
    for n in reversed(shape[1:]):
        strides.insert(0, strides[0] * n)
    cells = F.sequence(F.lit(0), F.lit(strides[0] * shape[0] - 1))

    def beside(direction: tuple[int, ...]) -> Column:
        step = sum(d * s for d, s in zip(direction, strides))

        def pair(i: Column) -> Column:
            inside = [(F.floor(i / s) % n + d).between(0, n - 1) for d, s, n in zip(direction, strides, shape) if d]
            both = F.struct(i.alias("a"), (i + step).alias("b"), F.get(values, i).alias("u"), F.get(values, i + step).alias("v"))
            return F.when(reduce(lambda x, y: x & y, inside), both)

        return F.filter(F.transform(cells, pair), lambda p: p.isNotNull())

    return F.concat(*[beside(d) for d in product((-1, 0, 1), repeat=len(shape)) if d > (0,) * len(shape)])


def neighbour_correlation(frames: DataFrame, values: str, shape: tuple[int, ...]) -> DataFrame:
    """Mean correlation over frames of each cell with the cells that touch it, an undefined one as 0: cell (from 0), rho.

    The pairs follow from the shape alone; each is summed over frames once and counts for both its cells.
    """
    r = frames.select(F.inline(_touching(values, shape))).groupBy("a", "b").agg(F.coalesce(safe_corr(F.col("u"), F.col("v")), F.lit(0.0)).alias("r"))
    both = r.select("a", "r").unionByName(r.select(F.col("b").alias("a"), "r"))
    return both.groupBy(F.col("a").alias("cell")).agg(F.avg("r").alias("rho"))


def components(df: DataFrame, key: str, least: int = 1, largest: bool = False) -> DataFrame:
    """Pixels (key, y, x) by the connected component (corners included) of their image: adds component (from 1, by first pixel) and n.

    Components of fewer than `least` pixels are dropped, or all but the largest (the first of equally large ones). Pixels of a
    square of SIDE are labelled in one place; only what touches across the edges of squares meets at joins, all images together.
    """
    here = df.select(key, "y", "x").distinct()
    own = stored(_labelled(here, key))
    steps = F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy, dx in ((0, 1), (1, -1), (1, 0), (1, 1))])
    edge = own.where(F.pmod("y", F.lit(SIDE)).isin(0, SIDE - 1) | F.pmod("x", F.lit(SIDE)).isin(0, SIDE - 1))
    near = edge.select(key, F.struct(key, "fy", "fx").alias("a"), F.struct(_square("y"), _square("x")).alias("_in"), F.explode(steps).alias("d"), "y", "x")
    near = near.select(key, "a", "_in", (F.col("y") + F.col("d.dy")).alias("y"), (F.col("x") + F.col("d.dx")).alias("x")).where(F.col("_in") != F.struct(_square("y"), _square("x")))
    edges = near.join(edge, [key, "y", "x"]).select("a", F.struct(key, "fy", "fx").alias("b")).distinct()
    roots = connected_components(edges).select(F.col(f"node.{key}").alias(key), F.col("node.fy").alias("fy"), F.col("node.fx").alias("fx"), F.struct(F.col("root.fy").alias("y"), F.col("root.fx").alias("x")).alias("first"))
    # One row for each square's own components, with their first pixel in the image and how many pixels they have.
    parts = own.groupBy(key, "fy", "fx").agg(F.count("*").alias("_n")).join(roots, [key, "fy", "fx"], "left")
    parts = stored(parts.withColumn("first", F.coalesce("first", F.struct(F.col("fy").alias("y"), F.col("fx").alias("x")))))
    sizes = parts.groupBy(key, "first").agg(F.sum("_n").alias("n")).where(F.col("n") >= least)
    if largest:
        sizes = sizes.groupBy(key).agg(F.min_by(F.struct("first", "n"), F.struct(-F.col("n"), "first")).alias("s")).select(key, "s.first", "s.n")
    order = sizes.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("first", "n"))).alias("order"))
    numbered = order.select(key, F.posexplode("order").alias("component", "s")).select(key, "s.first", "s.n", (F.col("component") + 1).cast("long").alias("component"))
    named = parts.join(numbered, [key, "first"]).select(key, "fy", "fx", "n", "component")
    return own.join(named, [key, "fy", "fx"]).select(key, "y", "x", "n", "component")


def _square(c: str) -> Column:
    return F.floor(F.col(c) / SIDE)


def _labelled(pixels: DataFrame, key: str) -> DataFrame:
    """Pixels (key, y, x; none null) with fy and fx, the first pixel of their component within their square."""
    ship(pixels.sparkSession)
    kinds = {c: pixels.schema[c].dataType.simpleString() for c in (key, "y", "x")}

    def run(square: pd.DataFrame) -> pd.DataFrame:
        square = square.sort_values(["y", "x"], kind="stable")
        y, x = (square[c].to_numpy(np.int64) for c in ("y", "x"))
        width = SIDE + 2  # so that what is left of a row's first pixel is nothing
        cell = (y - y.min()) * width + x % SIDE
        pairs = []
        for step in (1, width - 1, width, width + 1):
            at = np.minimum(np.searchsorted(cell, cell + step), len(cell) - 1)
            found = np.flatnonzero(cell[at] == cell + step)
            pairs.append((found, at[found]))
        a, b = (np.concatenate(p) for p in zip(*pairs))
        first, before = np.arange(len(cell)), None
        while before is None or (first != before).any():
            before = first.copy()
            least = np.minimum(first[a], first[b])
            # The roots of both ends are linked as well, so that long lines take few rounds.
            for at in (before[a], before[b], a, b):
                np.minimum.at(first, at, least)
            first = first[first]
        return square[[key, "y", "x"]].assign(fy=y[first], fx=x[first])

    squares = pixels.where(F.col(key).isNotNull() & F.col("y").isNotNull() & F.col("x").isNotNull()).withColumns({"_y": _square("y"), "_x": _square("x")})
    return squares.groupBy(key, "_y", "_x").applyInPandas(run, ", ".join(f"{n} {k}" for n, k in kinds.items()) + f", fy {kinds['y']}, fx {kinds['x']}")


def centroids(df: DataFrame, key: str, label: str, weight: Column | None = None) -> DataFrame:
    """(key, label, cy, cx, n) of the pixels of each label, weighted; label 0 is background."""
    w = F.lit(1.0) if weight is None else weight
    mean = lambda c: ratio(F.sum(F.col(c) * w), F.sum(w))
    return df.where(F.col(label) != 0).groupBy(key, label).agg(mean("y").alias("cy"), mean("x").alias("cx"), F.count("*").alias("n"))


def as_label_image(df: DataFrame, key: str, label: str) -> DataFrame:
    """One label for each pixel that any has: the largest wins where they overlap."""
    return df.groupBy(key, "y", "x").agg(F.max(label).alias(label))


def dilated(df: DataFrame, key: str, height: int, width: int, reach: int = 1) -> DataFrame:
    """Pixels (key, y, x) within `reach` of a pixel given, in both directions, inside the image."""
    steps = F.sequence(F.lit(-reach), F.lit(reach))
    out = df.select(key, (F.col("y")).alias("y"), F.col("x").alias("x"), F.explode(steps).alias("_dy")).select("*", F.explode(steps).alias("_dx"))
    out = out.select(key, (F.col("y") + F.col("_dy")).alias("y"), (F.col("x") + F.col("_dx")).alias("x"))
    return out.where(F.col("y").between(0, height - 1) & F.col("x").between(0, width - 1)).distinct()


def seam_weighted(df: DataFrame, key: list[str], place: str, step: int, size: int, patches: int, value: str) -> DataFrame:
    """Each sample in every patch [p * step, p * step + size) that covers its place, weighted by 1 / their number: adds patch, weight, part."""
    first = F.greatest(F.lit(0), F.floor((F.col(place) - size) / step) + 1).cast("long")
    last = F.least(F.lit(patches - 1), F.floor(F.col(place) / step)).cast("long")
    rows = df.where(first <= last).withColumns({"weight": ratio(F.lit(1), last - first + 1), "patch": F.explode(F.sequence(first, last))})
    return rows.withColumn("part", F.col(value) * F.col("weight"))


def bounds(df: DataFrame, key: list[str], z: str) -> DataFrame:
    """First and last plane of each segment: key, first, last."""
    return df.groupBy(*key).agg(F.min(z).alias("first"), F.max(z).alias("last"))


def coverage(df: DataFrame, component: str, pixel: list[str], weight: str) -> DataFrame:
    """Of each pixel: components normalised by their energy and by their maximum, summed, and how many cover it."""
    norms = df.groupBy(component).agg(F.sqrt(F.sum(F.col(weight) * F.col(weight))).alias("_e"), F.max(weight).alias("_m"))
    rows = df.join(norms, component)
    return rows.groupBy(*pixel).agg(F.sum(ratio(F.col(weight), F.col("_e"))).alias("by_energy"), F.sum(ratio(F.col(weight), F.col("_m"))).alias("by_max"), F.count_if(F.col(weight) > 0).alias("n"))


def own_plane(footprints: DataFrame, planes: DataFrame, component: str, z: str, weight: str) -> DataFrame:
    """Footprints restricted to their component's own plane (planes: component, plane); components left empty are dropped."""
    own = footprints.join(planes, component).where(F.col(z) == F.col("plane")).drop("plane")
    full = own.groupBy(component).agg(F.sum(weight).alias("_w")).where("_w <> 0").select(component)
    return own.join(full, component, "left_semi")
