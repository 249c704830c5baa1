"""Hierarchical clustering by complete linkage on correlation distance, family by family, in rounds of joins.

In every round all clusters that are each other's nearest merge at once. Complete linkage is reducible (a merged cluster is
never nearer to others than its parts were), so the tree is that of merging the nearest pair of all, one at a time. Distances
that are given are rows, and every round is an aggregation of them. Those of series are made again, as products of blocks, of
which only each cluster's nearest become rows: the time is that of all pairs, rows and memory are not. A cluster's list of its
nearest decides more than one round (a cluster is as far from two merged ones as from the farther, and no nearer to what the
lists leave out than their ends say), so that few such passes are needed. Only lists of a bounded size, and the last clusters of
a family, meet in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.functions.shared import cut, stored
from tracelake.functions.ship import ship
from tracelake.operators import series
from tracelake.operators.graphs import connected_components

#: Digits of a distance, so that the order of summing does not decide between equal ones.
DIGITS = 12
#: A family with no more pairs left than this (those of 256 clusters) is merged to its end in one place.
TOGETHER = 256 * 255 // 2
#: Values of the series of one block, and series whose products with a block are held at a time.
VALUES, TILE = 1 << 20, 256
#: A family of series is merged to its end in one place once it has at most so many clusters; as a matrix of their series' distances if these have at most so many values, else of rows of pairs.
CLUSTERS, HELD = 2048, 1 << 22
#: How many of a cluster's nearest are listed, and entries of a family's lists that meet in one place.
LISTED, ENTRIES = 64, 1 << 20
#: The first so many members of clusters are compared side by side, those beyond cluster by cluster.
LEVELS = 16


def _z(values: str) -> Column:
    return F.transform(series.zscored(series.doubles(values)), lambda v: F.coalesce(v, F.lit(0.0)))


def distances(df: DataFrame, family: str, key: str, values: str) -> DataFrame:
    """(family, a, b, d) of all pairs a < b within a family: 1 less the correlation of their arrays of one length, in which null or NaN counts as the mean; 1 for a constant one."""
    rows = df.select(family, F.col(key).alias("a"), _z(values).alias("za"))
    other = rows.select(family, F.col("a").alias("b"), F.col("za").alias("zb"))
    dot = F.aggregate(F.zip_with("za", "zb", lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v) / F.size("za")
    return rows.join(other, family).where("a < b").select(family, "a", "b", F.round(1 - dot, DIGITS).alias("d"))


def reciprocal(left: DataFrame, family: str) -> DataFrame:
    """(family, a, b, height) of the pairs of left (family, a, b, d) that are each other's nearest."""
    ends = left.select(family, F.explode(F.array("a", "b")).alias("end"), F.struct("d", "a", "b").alias("pair"))
    return _mutual(ends, family)


def _mutual(ends: DataFrame, family: str) -> DataFrame:
    """reciprocal() of (family, end, pair), pair being d, a and b."""
    nearest = ends.groupBy(family, "end").agg(F.min("pair").alias("pair")).select(family, "pair.a", "pair.b", "pair.d")
    return nearest.groupBy(family, "a", "b").agg(F.max("d").alias("height"), F.count("*").alias("n")).where("n = 2").drop("n")


def _blocks(points: DataFrame, family: str) -> DataFrame:
    """points (family, root, z) in blocks, once for each pair of blocks (one, two) of its family: adds block. A cluster's points are in one block."""
    points = points.where(F.col("root").isNotNull() & F.col("z").isNotNull() & F.col(family).isNotNull()).withColumn("size", F.size("z"))
    counts = points.groupBy(family, "size").agg(F.ceil(F.count("*") * F.col("size") / VALUES).alias("blocks"))
    dealt = points.join(counts, [family, "size"]).withColumn("block", F.pmod(F.xxhash64("root"), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return dealt.select(family, "size", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "block", "root", "z")


def _apart(whole: bool, every: bool, family: str):
    """Of the points of one or two blocks, the nearest other cluster of each cluster (family, end, d, a, b), or every pair of clusters once (end null).

    whole: points of one root are a cluster, as far from another as their farthest pair; else each stands for itself.
    """

    def run(key: tuple, points: pd.DataFrame) -> pd.DataFrame:
        points = points.sort_values("root", kind="stable")
        sides = [points[points["block"] == b] for b in key[2:]]
        (names, x, first), (others, y, second) = [_side(side, whole) for side in sides]
        same, out, least, at = key[2] == key[3], [], np.full(len(others), np.inf), np.zeros(len(others), np.int64)
        begin, edges = 0, np.append(first, len(x))
        while begin < len(names) and len(others):
            end = max(begin + 1, int(np.searchsorted(edges, edges[begin] + TILE, side="right")) - 1)
            dots = x[edges[begin] : edges[end]] @ y.T / key[1]
            if len(y) > len(others):
                dots = np.minimum.reduceat(dots, second, axis=1)
            if len(dots) > end - begin:
                dots = np.minimum.reduceat(dots, first[begin:end] - first[begin], axis=0)
            d = np.round(1 - dots, DIGITS) + 0.0
            if same:
                d[names[begin:end, None] == others[None]] = np.inf
            if every:
                i, j = np.nonzero(np.triu(d < np.inf, begin + 1) if same else d < np.inf)
                out.append((names[begin + i], others[j], d[i, j]))
            else:
                # Of equal distances the first, that of the least keys.
                j = np.argmin(d, axis=1)
                out.append((names[begin:end], others[j], d[np.arange(len(j)), j]))
                i = np.argmin(d, axis=0)
                near = d[i, np.arange(len(others))]
                at, least = np.where(near < least, begin + i, at), np.minimum(least, near)
            begin = end
        if not (every or same) and len(names):
            out.append((others, names[at], least))
        columns = [np.concatenate([o[i] for o in out]) for i in range(3)] if out else [np.zeros(0, np.int64)] * 3
        ends = None if every else columns[0]
        rows = pd.DataFrame({family: [key[0]] * len(columns[0]), "end": ends, "d": columns[2], "a": np.minimum(*columns[:2]), "b": np.maximum(*columns[:2])})
        return rows[rows["d"] < np.inf]

    return run


def _side(points: pd.DataFrame, whole: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Clusters, points, and where each cluster's points begin."""
    roots = points["root"].to_numpy(np.int64)
    first = np.flatnonzero(np.concatenate(([True], roots[1:] != roots[:-1]))) if whole and len(roots) else np.arange(len(roots))
    return roots[first], np.stack(points["z"].to_numpy()) if len(roots) else np.zeros((0, 0)), first


def _made(points: DataFrame, family: str, whole: bool, every: bool) -> DataFrame:
    ship(points.sparkSession)
    kind = points.schema[family].dataType.simpleString()
    return _blocks(points, family).groupBy(family, "size", "one", "two").applyInPandas(_apart(whole, every, family), f"{family} {kind}, end long, d double, a long, b long")


def _points(df: DataFrame, family: str, key: str, values: str) -> DataFrame:
    z = F.transform(_z(values), lambda v: F.nanvl(v, F.lit(0.0)))
    return df.select(family, F.col(key).cast("long").alias("root"), z.alias("z"))


def reciprocal_series(df: DataFrame, family: str, key: str, values: str) -> DataFrame:
    """reciprocal() of distances(), without their rows; key: whole numbers. An infinite value makes its series count as constant, and null arrays are left out."""
    found = _made(_points(df, family, key, values), family, False, False).select(family, "end", F.struct("d", "a", "b").alias("pair"))
    return _mutual(found, family)


def _merged(members: DataFrame, now: DataFrame, family: str) -> DataFrame:
    """members (family, root, place, ...) after the merges of a round."""
    sizes = members.groupBy(family, "root").agg(F.count("*").alias("_size"))
    shift = now.join(sizes.withColumnRenamed("root", "a"), [family, "a"]).select(family, F.col("b").alias("root"), F.col("a").alias("_into"), "_size")
    moved = members.join(shift, [family, "root"], "left").withColumn("place", F.col("place") + F.coalesce("_size", F.lit(0)))
    return moved.withColumn("root", F.coalesce("_into", "root")).select(members.columns)


def _levels(side: tuple) -> tuple[np.ndarray, np.ndarray, list[int], np.ndarray]:
    """A side's points with the first member of each cluster before the second ones, and so on, clusters of more members before those of fewer.

    Returns the clusters' order, the points, the number of clusters with each member, and where the members of each cluster beyond LEVELS begin.
    """
    _, x, first = side
    size = np.diff(np.append(first, len(x)))
    order = np.argsort(-size, kind="stable")
    counts = [int((size > j).sum()) for j in range(min(LEVELS, size.max(initial=0)))]
    index = [first[order[:c]] + j for j, c in enumerate(counts)]
    more = order[: int((size > LEVELS).sum())]
    index += [np.arange(first[i] + LEVELS, first[i] + size[i]) for i in more]
    return order, x[np.concatenate(index)] if index else x, counts, np.cumsum(np.append(0, size[more] - LEVELS))[:-1]


def _least(rows: np.ndarray, levels: tuple) -> np.ndarray:
    """The least product of each row with each cluster of the levels."""
    _, y, counts, starts = levels
    every = rows @ y.T
    least, at = every[:, : counts[0]], counts[0]
    for c in counts[1:]:
        np.minimum(least[:, :c], every[:, at : at + c], out=least[:, :c])
        at += c
    if c := len(starts):
        np.minimum(least[:, :c], np.minimum.reduceat(every[:, at:], starts, axis=1), out=least[:, :c])
    return least


def _tiles(one: tuple, levels: tuple) -> Iterator[tuple[int, int, np.ndarray]]:
    """For some clusters of the side one at a time, from begin to end: their least products with each cluster of the levels."""
    (names, x, first), begin = one, 0
    edges = np.append(first, len(x))
    while begin < len(names) and len(levels[0]):
        end = max(begin + 1, int(np.searchsorted(edges, edges[begin] + TILE, side="right")) - 1)
        if edges[end] - edges[begin] > TILE:
            parts = (_least(x[i : min(i + TILE, edges[end])], levels).min(axis=0) for i in range(edges[begin], edges[end], TILE))
            dots = reduce(np.minimum, parts)[None]
        else:
            least, own = _least(x[edges[begin] : edges[end]], levels), edges[begin : end + 1] - edges[begin]
            dots = least[own[:-1]]
            for i in np.flatnonzero(np.diff(own) > 1):
                np.minimum.reduce(least[own[i] : own[i + 1]], axis=0, out=dots[i])
        yield begin, end, dots
        begin = end


def _nearest(one: tuple, two: tuple, same: bool, length: int, most: int) -> list[tuple]:
    """Of each cluster of the side one, the `most` nearest of the side two (end, d, a, b), in the order of d, a and b."""
    names, levels, out = one[0], _levels(two), []
    others, place = two[0][levels[0]], np.argsort(levels[0])
    # As many greatest of parts of a row bound its own from below; what rounding makes equal is let in.
    width = max(1, len(others) // (4 * most))
    for begin, end, dots in _tiles(one, levels):
        if same:
            dots[np.arange(end - begin), place[begin:end]] = -np.inf
        best = np.maximum.reduceat(dots, np.arange(0, len(others), width), axis=1) if width > 1 else dots
        least = np.partition(best, -most, axis=1)[:, -most] if best.shape[1] > most else np.full(end - begin, -np.inf)
        at = np.flatnonzero(dots >= (least - 2 * length * 10.0**-DIGITS)[:, None])
        i, j = np.divmod(at, len(others))
        i, j = i[found := dots[i, j] > -np.inf], j[found]
        d = np.round(1 - dots[i, j] / max(1, length), DIGITS) + 0.0
        i, j = names[begin + i], others[j]
        low, high = np.minimum(i, j), np.maximum(i, j)
        order = np.lexsort((high, low, d, i))
        order = order[_nth(i[order]) < most]
        out.append((i[order], d[order], low[order], high[order]))
    return out


def _nth(values: np.ndarray) -> np.ndarray:
    """Of sorted values, how many equal ones come before each."""
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))[: len(values)]
    return np.arange(len(values)) - np.repeat(first, np.diff(np.append(first, len(values))))


def _listed(family: str):
    """Of the points of one or two blocks, the nearest other clusters of each cluster, as many as the key says."""

    def run(key: tuple, points: pd.DataFrame) -> pd.DataFrame:
        points = points.sort_values("root", kind="stable")
        sides = [_side(points[points["block"] == b], True) for b in key[3:]]
        same = key[3] == key[4]
        out = _nearest(sides[0], sides[1], same, key[1], key[2])
        out += [] if same else _nearest(sides[1], sides[0], same, key[1], key[2])
        columns = [np.concatenate([o[i] for o in out]) if out else np.zeros(0, np.int64) for i in range(4)]
        return pd.DataFrame({family: [key[0]] * len(columns[0])} | dict(zip(("end", "d", "a", "b"), columns)))

    return run


def _lists(members: DataFrame, counts: DataFrame, family: str) -> DataFrame:
    """(family, end, d, a, b, nth): the nearest clusters of each, k of the counts (family, k)."""
    ship(members.sparkSession)
    kind = members.schema[family].dataType.simpleString()
    dealt = _blocks(members, family).join(counts.select(family, "k"), family)
    found = dealt.groupBy(family, "size", "k", "one", "two").applyInPandas(_listed(family), f"{family} {kind}, end long, d double, a long, b long")
    found = found.withColumn("nth", F.row_number().over(Window.partitionBy(family, "end").orderBy("d", "a", "b")))
    return found.join(counts.select(family, "k"), family).where("nth <= k").drop("k")


def _decided(family: str):
    """Merges of a family (b not null, step its round) that the lists of its clusters decide, and of each cluster which one it is in then and how far its leaves move on (b null)."""

    def run(key: tuple, lists: pd.DataFrame, sizes: pd.DataFrame) -> pd.DataFrame:
        names = np.sort(sizes["root"].to_numpy(np.int64))
        count, lists = len(names), lists.sort_values(["end", "nth"], kind="stable")
        ends = np.searchsorted(names, lists["end"].to_numpy())
        low, high, d = np.searchsorted(names, lists["a"].to_numpy()), np.searchsorted(names, lists["b"].to_numpy()), lists["d"].to_numpy()
        # What a list leaves out comes after its last pair; after a merge it is only known to be no nearer.
        last = np.flatnonzero(np.append(ends[1:] != ends[:-1], True))[: len(ends)]
        bound, at_low, at_high = np.full(count, np.inf), np.full(count, count), np.full(count, count)
        bound[ends[last]], at_low[ends[last]], at_high[ends[last]] = d[last], low[last], high[last]
        pair, one = np.unique(low * count + high, return_index=True)
        low, high, d, merges = pair // count, pair % count, d[one], []
        while len(low):
            order = np.lexsort((high, low, d))
            low, high, d = low[order], high[order], d[order]
            first = np.full(count, len(low))
            for side in (high, low):
                np.minimum.at(first, side, np.arange(len(low)))
            now = (first[low] == np.arange(len(low))) & (first[high] == np.arange(len(low)))
            for side in (low, high):
                now &= (d < bound[side]) | (d == bound[side]) & ((low < at_low[side]) | (low == at_low[side]) & (high <= at_high[side]))
            if not now.any():
                break
            a, b = low[now], high[now]
            merges.append((a, b, d[now]))
            bound[a], at_low[:] = np.minimum(bound[a], bound[b]), -1
            into, parts = np.arange(count), np.ones(count, np.int64)
            into[b], parts[a] = a, 2
            x, y = into[low], into[high]
            order = np.flatnonzero(x != y)
            pair, far = np.minimum(x, y)[order] * count + np.maximum(x, y)[order], d[order]
            order = np.argsort(pair, kind="stable")
            pair, far = pair[order], far[order]
            start = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))[: len(pair)]
            known = np.diff(np.append(start, len(pair)))
            d = np.maximum.reduceat(far, start) if len(pair) else far
            low, high = pair[start] // count, pair[start] % count
            # A distance is known where those of all parts are.
            kept = (known == parts[low] * parts[high]) & (d <= np.maximum(bound[low], bound[high]))
            low, high, d = low[kept], high[kept], d[kept]
        return _moves(key[0], family, names, sizes, merges)

    return run


def _moves(name, family: str, names: np.ndarray, sizes: pd.DataFrame, merges: list[tuple]) -> pd.DataFrame:
    """Rows of the merges of each step (a, b, height; by index of names), and of where each cluster is then."""
    size = sizes.set_index("root")["size"].reindex(names).to_numpy().copy()
    count = [len(a) for a, _, _ in merges]
    a, b, height = (np.concatenate([m[i] for m in merges]) if merges else np.zeros(0, np.int64) for i in range(3))
    into, move = np.arange(len(names)), np.zeros(len(names), np.int64)
    for x, y, _ in merges:
        move[y] = size[x]
        size[x] += size[y]
    # The leaves of b move with those of a from then on.
    for x, y in zip(a[::-1].tolist(), b[::-1].tolist()):
        into[y] = into[x]
        move[y] += move[x]
    left = len(names) - np.cumsum([0, *count[:-1]])
    made = pd.DataFrame({"a": names[a], "b": names[b], "height": height.astype(float), "step": np.repeat(np.arange(len(count)), count), "left": np.repeat(left[: len(count)], count), "into": None, "move": None})
    rows = pd.concat([made.astype(object), pd.DataFrame({"a": names, "into": names[into], "move": move}).astype(object)])
    rows.insert(0, family, name)
    return rows.astype({c: "Int64" for c in ("a", "b", "step", "left", "into", "move")} | {"height": float})


def _tree(apart: np.ndarray) -> list[tuple]:
    """The merges of a matrix of distances (infinite on its diagonal), round by round: indexes a and b, height."""
    index, out = np.arange(len(apart)), []
    while len(index) > 1:
        # Of equal distances the first, that of the least keys.
        near = np.argmin(apart, axis=1)
        a = np.flatnonzero((near[near] == np.arange(len(near))) & (np.arange(len(near)) < near))
        b = near[a]
        out.append((index[a], index[b], apart[a, b]))
        apart[a] = np.maximum(apart[a], apart[b])
        apart[:, a] = np.maximum(apart[:, a], apart[:, b])
        apart[a, a] = np.inf
        kept = np.delete(np.arange(len(index)), b)
        apart, index = apart[np.ix_(kept, kept)], index[kept]
    return out


def _whole(family: str):
    """All merges of a family from its points."""

    def run(key: tuple, points: pd.DataFrame) -> pd.DataFrame:
        points = points.sort_values("root", kind="stable")
        names, x, first = _side(points, True)
        sizes = pd.DataFrame({"root": names, "size": np.diff(np.append(first, len(x)))})
        apart, levels = np.empty((len(names), len(names))), _levels((names, x, first))
        for begin, end, dots in _tiles((names, x, first), levels):
            apart[begin:end, levels[0]] = np.round(1 - dots / max(1, x.shape[1]), DIGITS) + 0.0
        np.fill_diagonal(apart, np.inf)
        return _moves(key[0], family, names, sizes, _tree(np.maximum(apart, apart.T)))

    return run


def _paired(family: str):
    """All merges of a family from its pairs of clusters."""

    def run(key: tuple, pairs: pd.DataFrame, sizes: pd.DataFrame) -> pd.DataFrame:
        names = np.sort(sizes["root"].to_numpy(np.int64))
        apart = np.full((len(names), len(names)), np.inf)
        i, j = np.searchsorted(names, pairs["a"].to_numpy()), np.searchsorted(names, pairs["b"].to_numpy())
        apart[i, j] = apart[j, i] = pairs["d"]
        return _moves(key[0], family, names, sizes, _tree(apart))

    return run


def linked_series(df: DataFrame, family: str, key: str, values: str) -> tuple[DataFrame, DataFrame]:
    """linked() of distances(), without their rows: they are made again, block by block, in each pass. See reciprocal_series for odd values."""
    points = _points(df, family, key, values).where(F.col("root").isNotNull() & F.col("z").isNotNull())
    # One series for each key, the least where there are several.
    points = points.groupBy(family, "root").agg(F.min("z").alias("z"))
    members = stored(points.select(family, F.col("root").alias("leaf"), "root", F.lit(0).cast("long").alias("place"), "z"))
    kind, columns, made, rounds, ready = df.schema[family].dataType.simpleString(), members.columns, [], 0, []
    rows = f"{family} {kind}, a long, b long, height double, step long, left long, into long, move long"
    alone, members = members.where(F.col(family).isNull()).drop("z"), members.where(F.col(family).isNotNull())
    while True:
        k = F.greatest(F.lit(1), F.least(F.lit(LISTED), F.floor(F.lit(ENTRIES) / F.col("clusters")))).cast("int")
        sizes = members.groupBy(family, "root").agg(F.count("*").alias("size"), F.sum(F.size("z")).alias("held"), F.min(F.size("z")).alias("low"), F.max(F.size("z")).alias("high"))
        counts = stored(sizes.groupBy(family).agg(F.count("*").alias("clusters"), F.sum("held").alias("held"), F.min("low").alias("low"), F.max("high").alias("high")).withColumn("k", k))
        most, uneven = counts.agg(F.max("clusters"), F.bool_or((F.col("low") < F.col("high")) & (F.col("clusters") > 1))).first()
        if uneven:
            raise ValueError("series of one family differ in length")
        of = lambda some: members.join(counts.where(some).select(family), family).select(columns)  # noqa: E731, B023
        ready.append((of(F.col("clusters") <= CLUSTERS), counts))
        if (most or 0) <= CLUSTERS:
            break
        members, counts = of(F.col("clusters") > CLUSTERS), counts.where(F.col("clusters") > CLUSTERS)
        found = _lists(members, counts if most <= ENTRIES else counts.withColumn("k", F.lit(1)), family)
        if most > ENTRIES:
            now = stored(_mutual(found.select(family, "end", F.struct("d", "a", "b").alias("pair")), family).withColumn("round", F.lit(rounds).cast("long")))
            made.append(now)
            members, rounds = stored(_merged(members, now, family)), rounds + 1
            continue
        sizes = members.groupBy(family, "root").agg(F.count("*").alias("size"))
        step = stored(found.groupBy(family).cogroup(sizes.groupBy(family)).applyInPandas(_decided(family), rows))
        made.append(step.where("b is not null").select(family, "a", "b", "height", (F.col("step") + rounds).alias("round")))
        rounds += step.agg(F.max("step")).first()[0] + 1
        members = stored(_moved(members, step, family).select(columns))
    leaves, ended = [alone.select(family, F.col("leaf").alias(key), "place")], []
    for some, counts in ready:
        small = lambda x: some.join(counts.where(x).select(family), family)  # noqa: E731, B023
        ended.append(small(F.col("held") <= HELD).groupBy(family).applyInPandas(_whole(family), rows))
        large = small(F.col("held") > HELD)
        if not large.isEmpty():
            pairs, sizes = _made(large, family, True, True), large.groupBy(family, "root").agg(F.count("*").alias("size"))
            ended.append(pairs.groupBy(family).cogroup(sizes.groupBy(family)).applyInPandas(_paired(family), rows))
    ended = stored(reduce(DataFrame.unionByName, ended))
    leaves += [_moved(some, ended, family).select(family, F.col("leaf").alias(key), "place") for some, _ in ready]
    # Rounds go on until no family has over TOGETHER pairs left; then one pair merges at a time.
    merges = ended.where("b is not null")
    many = merges.where(F.col("left") * (F.col("left") - 1) / 2 > TOGETHER).agg(F.max("step")).first()[0]
    later = F.col("step") > F.lit(-1 if many is None else many)
    order = F.row_number().over(Window.partitionBy(family, later).orderBy("height", "a", "b"))
    step = F.when(later, order + (0 if many is None else many + 1) - 1).otherwise(F.col("step"))
    made.append(merges.select(family, "a", "b", "height", (step + rounds).cast("long").alias("round")))
    return reduce(DataFrame.unionByName, leaves), reduce(DataFrame.unionByName, made)


def _moved(members: DataFrame, step: DataFrame, family: str) -> DataFrame:
    """members (family, root, place, ...) after the moves (b null) of a step."""
    moves = step.where("b is null").select(family, F.col("a").alias("root"), F.col("into").alias("_into"), "move")
    moved = members.join(moves, [family, "root"])
    return moved.withColumns({"root": F.col("_into"), "place": F.col("place") + F.col("move")}).drop("_into", "move")


def _rest(family: str):
    """Merge what is left of one family, at most TOGETHER pairs: its merges (b not null), and how far each cluster's leaves move on (b null)."""

    def run(key: tuple, pairs: pd.DataFrame, sizes: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(pairs):
            names = np.unique(np.concatenate([pairs["a"], pairs["b"]]))
            n, size = len(names), sizes.set_index("root")["size"].reindex(names).to_numpy().copy()
            apart = np.full((n, n), np.inf)
            i, j = np.searchsorted(names, pairs["a"]), np.searchsorted(names, pairs["b"])
            apart[i, j] = apart[j, i] = pairs["d"]
            within, shift = [[k] for k in range(n)], np.zeros(n, np.int64)
            for step in range(n - 1):
                # Of equal distances the first, that of the least keys.
                a, b = sorted(divmod(int(np.argmin(apart)), n))
                out.append((names[a], names[b], apart[a, b], step, 0))
                shift[within[b]] += size[a]
                size[a] += size[b]
                within[a] += within[b]
                apart[a] = apart[:, a] = np.maximum(apart[a], apart[b])
                apart[b] = apart[:, b] = np.inf
                apart[a, a] = np.inf
            out += [(name, None, None, None, move) for name, move in zip(names, shift)]
        rows = pd.DataFrame(out, columns=["a", "b", "height", "step", "move"])
        rows.insert(0, family, key[0])
        return rows.astype({"b": "Int64", "step": "Int64"})

    return run


def linked(df: DataFrame, family: str, key: str, d: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The leaves (family, key, place) and the merges (family, a, b, height, round) of each family's tree.

    key: whole numbers; d: from distances(), or any (family, a, b, d) with a < b for all pairs. A cluster goes by its least
    key; of equally near pairs the one of least keys is the nearer. place: from 0 in the family, the subtree with the least
    key coming first in every merge. A family of one key, or a null family, has no merges. Rounds go on until no family has
    over TOGETHER pairs left; what is left of each is then merged in one place.
    """
    members = cut(df.select(family, F.col(key).cast("long").alias("leaf"), F.col(key).cast("long").alias("root"), F.lit(0).cast("long").alias("place")).distinct())
    left, made, rounds = cut(d.select(family, F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"), "d")), [], 0
    while (left.groupBy(family).count().agg(F.max("count")).first()[0] or 0) > TOGETHER:
        now = cut(reciprocal(left, family).withColumn("round", F.lit(rounds).cast("long")))
        made.append(now)
        into = lambda x: now.select(family, F.col("b").alias(x), F.col("a").alias(f"into_{x}"))  # noqa: E731, B023
        moved = left.join(into("a"), [family, "a"], "left").join(into("b"), [family, "b"], "left")
        moved = moved.select(family, F.coalesce("into_a", "a").alias("x"), F.coalesce("into_b", "b").alias("y"), "d").where("x <> y")
        left = cut(moved.groupBy(family, F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(F.max("d").alias("d")))
        members = cut(_merged(members, now, family))
        rounds += 1
    return _ended(df, family, key, members, left, made, rounds)


def _ended(df: DataFrame, family: str, key: str, members: DataFrame, left: DataFrame, made: list[DataFrame], rounds: int) -> tuple[DataFrame, DataFrame]:
    """Leaves and merges once what is left of each family is merged in one place."""
    ship(df.sparkSession)
    sizes = members.groupBy(family, "root").agg(F.count("*").alias("size"))
    kind = df.schema[family].dataType.simpleString()
    rest = left.groupBy(family).cogroup(sizes.groupBy(family)).applyInPandas(_rest(family), f"{family} {kind}, a long, b long, height double, step long, move long")
    rest = cut(rest)
    made.append(rest.where("b is not null").select(family, "a", "b", "height", (F.col("step") + rounds).alias("round")))
    move = rest.where("b is null").select(family, F.col("a").alias("root"), "move")
    leaves = members.join(move, [family, "root"], "left").select(family, F.col("leaf").alias(key), (F.col("place") + F.coalesce("move", F.lit(0))).alias("place"))
    return leaves, reduce(DataFrame.unionByName, made)


def clusters(leaves: DataFrame, merges: DataFrame, family: str, key: str, count: int | None = None, height: float | None = None) -> DataFrame:
    """(family, key, place, cluster): the tree cut into at most `count` clusters, or at a height; clusters are numbered from 1 in the order of leaves."""
    if height is not None:
        kept = merges.where(F.col("height") <= height)
    else:
        # The last merges of a family, as many as make one cluster of `count`, are undone.
        last = Window.partitionBy(family).orderBy(F.desc("height"), F.desc("round"), F.desc("a"))
        kept = merges.withColumn("_i", F.row_number().over(last)).where(F.col("_i") >= count)
    node = lambda c: F.struct(F.col(family).alias("f"), F.col(c).alias("k"))
    roots = connected_components(kept.select(node("a").alias("a"), node("b").alias("b")))
    of = roots.select(F.col("node.f").alias(family), F.col("node.k").alias(key), F.col("root.k").alias("_root"))
    rows = leaves.join(of, [family, key], "left").withColumn("_root", F.coalesce("_root", key))
    first = rows.groupBy(family, "_root").agg(F.min("place").alias("_first"))
    numbers = first.withColumn("cluster", F.row_number().over(Window.partitionBy(family).orderBy("_first"))).drop("_first")
    return rows.join(numbers, [family, "_root"]).select(family, key, "place", "cluster")
