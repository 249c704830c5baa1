"""Stitching of trees against the greedy definition, nulls and ties included."""

import math
import random

import pytest

from tracelake.operators import stitching

TREE = "f string, tree int, node int, parent int, x double, y double, z double"


def _greedy(rows):
    """One link at a time, the least of all that still join two groups."""
    rows = [r for r in rows if None not in (r[0], r[1], r[2], *r[4:]) and not any(map(math.isnan, r[4:]))]
    roots, top = {}, {}
    for f, tree, node, parent, *at in sorted(rows, key=lambda r: r[2]):
        top[f, tree] = tree
        if parent is None:
            roots.setdefault((f, tree), at)
    edges = sorted((math.sqrt(sum((a - b) * (a - b) for a, b in zip(at, p))), child, host, node, f) for (f, child), at in roots.items() for g, host, node, _, *p in rows if g == f and host != child)
    out = []
    for d, child, host, node, f in edges:
        if top[f, child] == child and top[f, host] != child:
            out.append((f, child, host, node, round(d, 9)))
            was = top[f, host]
            top = {k: was if k[0] == f and v == child else v for k, v in top.items()}
    return sorted(out)


@pytest.mark.parametrize("reach", [1.5, 40.0])
def test_stitches_are_those_of_greedy_merging(spark, reach):
    rng = random.Random(7)
    rows, node = [], 0
    for f, trees in (("a", 14), ("b", 2), ("c", 1)):
        for tree in range(trees):
            middle = [rng.randint(0, 9) for _ in range(3)]
            for i in range(rng.randint(1, 6)):
                rows.append((f, tree, node, None if i == 0 else node - 1, *[float(m + rng.randint(0, 2)) for m in middle]))
                node += 1
    rows += [("b", 7, 900, None, None, 1.0, 1.0), ("b", 8, 901, None, float("nan"), 1.0, 1.0), (None, 1, 902, None, 1.0, 1.0, 1.0), ("b", None, 903, None, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, TREE)
    links = stitching.stitches(df, "f", reach)
    got = sorted((r.f, r.child, r.host, r.node, round(r.d, 9)) for r in links.collect())
    assert got == _greedy(rows) and len(got) == 14
    whole = stitching.stitched(df, links, "f").collect()
    assert len(whole) == len(rows)
    assert len({r.whole for r in whole if r.f == "a"}) == 1 and sum(r.parent is None for r in whole if r.f == "a") == 1


def test_stitches_of_no_trees(spark):
    df = spark.createDataFrame([], TREE)
    assert stitching.stitches(df, "f", 1.0).collect() == []


def test_crowded_trees_meet_few_nodes(spark, monkeypatch):
    """A first search that reaches everything is narrowed, so that edges grow as the nodes do and not with their square."""
    rng = random.Random(3)
    rows = [("a", i // 3, i, None if i % 3 == 0 else i - 1, *[rng.random() for _ in range(3)]) for i in range(900)]
    found, search = [], stitching.near_nodes

    def counted(*args):
        edges = search(*args).localCheckpoint()
        found.append(edges.count())
        return edges

    monkeypatch.setattr(stitching, "near_nodes", counted)
    got = stitching.stitches(spark.createDataFrame(rows, TREE), "f", 2.0).collect()
    assert sorted((r.f, r.child, r.host, r.node, round(r.d, 9)) for r in got) == _greedy(rows)
    # All pairs of 300 trees were 89,700 edges.
    assert sum(found) < 20 * len(rows)


def test_roots_at_one_place_are_no_crowd(spark):
    """Halving ends where only roots and nodes at the very same place are left together."""
    rows = [("a", i, i, None, 1.0, 2.0, 3.0) for i in range(6)] + [("a", 9, 9, None, 5.0, 2.0, 3.0)]
    df = spark.createDataFrame(rows, TREE)
    assert stitching.first_reach(df, df, "f", 16.0) > 0
    got = stitching.stitches(df, "f", 16.0).collect()
    assert sorted((r.f, r.child, r.host, r.node, round(r.d, 9)) for r in got) == _greedy(rows)
