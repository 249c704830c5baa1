"""Components of pixels that are labelled by squares: those of a flood fill, wherever the edges of squares lie."""

import numpy as np
import pytest

from tracelake.operators import images


def _flood(pixels):
    left, out = set(pixels), {}
    while left:
        todo, one = [left.pop()], set()
        while todo:
            k, y, x = todo.pop()
            one.add((k, y, x))
            near = {(k, y + dy, x + dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1)} & left
            left -= near
            todo += near
        out |= {p: (min(one), len(one)) for p in one}
    return out


@pytest.mark.parametrize("side", [3, 256])
def test_squares_give_the_components_of_images(spark, monkeypatch, side):
    monkeypatch.setattr(images, "SIDE", side)
    joined, plain = [], images.connected_components
    monkeypatch.setattr(images, "connected_components", lambda edges: joined.append(edges.count()) or plain(edges))
    rng = np.random.default_rng(6)
    pixels = [(k, int(y), int(x)) for k in (1, 2) for y, x in zip(*np.nonzero(rng.random((40, 30)) < 0.35))]
    # A line that winds through the whole image, and places below zero.
    pixels += [(3, y, x) for y in range(0, 40, 2) for x in range(30)] + [(3, y, 29 if y % 4 == 1 else 0) for y in range(1, 39, 2)] + [(4, -1, -1), (4, 0, 0), (4, -7, 5)]
    df = spark.createDataFrame([*pixels, pixels[0]], "k int, y long, x long").repartition(4)
    want = _flood(pixels)
    got = {(r.k, r.y, r.x): (r.component, r.n) for r in images.components(df, "k").collect()}
    first = {k: sorted({f for f, _ in want.values() if f[0] == k}) for k in (1, 2, 3, 4)}
    assert got == {p: (first[p[0]].index(f) + 1, n) for p, (f, n) in want.items()}
    assert joined[0] < (len(pixels) if side == 3 else 10)
    assert {(r.k, r.y, r.x) for r in images.components(df, "k", 5).collect()} == {p for p, (_, n) in want.items() if n >= 5}
