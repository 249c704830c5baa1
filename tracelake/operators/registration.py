"""Rigid registration of image frames (arrays by rows) to a template by phase correlation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.functions.ship import ship


def template(frames: DataFrame, key: str, values: str) -> DataFrame:
    """(key, template): the mean image of each key's frames."""
    cells = frames.select(key, F.posexplode(values).alias("i", "v")).groupBy(key, "i").agg(F.avg("v").alias("v"))
    return cells.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "v"))), lambda c: c["v"]).alias("template"))


def _vertex(before: float, at: float, after: float) -> float:
    """Where the parabola through three heights has its top, from the middle one."""
    bend = before - 2 * at + after
    return 0.5 * (before - after) / bend if bend < 0 else 0.0


def offset(image: np.ndarray, target: np.ndarray, most: int | None = None) -> tuple[float, float, float]:
    """(dy, dx, peak): how far the image's content lies beyond the target's, to parts of a pixel; at most `most` pixels either way."""
    cross = np.fft.fft2(image - image.mean()) * np.conj(np.fft.fft2(target - target.mean()))
    size = np.abs(cross)
    if not size.max() > 1e-9:
        return 0.0, 0.0, 0.0
    surface = np.fft.ifft2(np.divide(cross, size, out=np.zeros_like(cross), where=size > 1e-9 * size.max())).real
    height, width = surface.shape
    allowed = surface
    if most is not None:
        near = lambda n: np.minimum(np.arange(n), n - np.arange(n)) <= most
        allowed = np.where(near(height)[:, None] & near(width)[None], surface, -np.inf)
    y, x = np.unravel_index(int(np.argmax(np.round(allowed, 9))), surface.shape)
    peak = surface[y, x]
    dy = _vertex(surface[y - 1, x], peak, surface[(y + 1) % height, x]) + (y if y <= height // 2 else y - height)
    dx = _vertex(surface[y, x - 1], peak, surface[y, (x + 1) % width]) + (x if x <= width // 2 else x - width)
    return float(dy), float(dx), float(peak)


def offsets(frames: DataFrame, templates: DataFrame, key: str, frame: str, values: str, height: int, width: int, most: int | None = None) -> DataFrame:
    """(key, frame, dy, dx, peak) of each frame against its key's template; null for an image of another size or with null or NaN.

    templates: key, template. Frames are worked on where they are but for the join with one row for each key.
    """
    rows = frames.select(key, frame, F.col(values).cast("array<double>").alias("image")).join(templates.select(key, "template"), key)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for image, target in zip(batch["image"], batch["template"]):
                pair = [np.zeros(0) if v is None else np.asarray(v, float) for v in (image, target)]
                fine = all(v.size == height * width and np.isfinite(v).all() for v in pair)
                found.append(offset(*(v.reshape(height, width) for v in pair), most) if fine else (np.nan,) * 3)
            yield pd.DataFrame({key: batch[key], frame: batch[frame]} | dict(zip(("dy", "dx", "peak"), np.array(found).reshape(-1, 3).T)))

    ship(frames.sparkSession)
    kinds = [f"{c} {frames.schema[c].dataType.simpleString()}" for c in (key, frame)]
    out = rows.mapInPandas(run, ", ".join([*kinds, "dy double", "dx double", "peak double"]))
    return out.select(key, frame, *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in ("dy", "dx", "peak")])


def moved(values: Column, height: int, width: int, dy: Column, dx: Column) -> Column:
    """An image (array by rows) moved back by a whole number of pixels: what comes in at the edges is null."""
    def at(_, i):
        y, x = F.floor(i / width) + F.round(dy), i % width + F.round(dx)
        inside = y.between(0, height - 1) & x.between(0, width - 1)
        return F.when(inside, F.get(values, (y * width + x).cast("int")))

    return F.transform(values, at)
