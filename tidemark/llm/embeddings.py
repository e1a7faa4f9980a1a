"""Exact near-duplicate pairs of embeddings by a cover tree and dual traversal.

Equal vectors are one point. Points go to the nearest of some pivots, and crowded cells are split, so every cell
is bounded. Each cell is a cover tree of nested levels with halving radii. A point meets another cell only where
triangle inequalities allow a link: it must lie within the threshold of the border between both pivots, and within
the threshold of the other cell's ball. Of two cells, the subtrees that are left are traversed together: pairs of
nodes, level by level, are dropped when their centres are farther apart than both covering radii and the threshold
allow, and counted whole when they are nearer than both covering radii and the threshold demand; only what is left
is compared point by point, in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import join_hot, staged

LEAST_COSINE = 0.95
#: Numbers (points times their length) that a cell holds, about; so a cell's memory does not depend on the length.
CELL_VALUES = 1 << 20
#: Pivots, at most, and the vectors of the sample they are taken from; pivots only decide how points are dealt out.
PIVOTS, SAMPLE = 1024, 2048
#: Chord lengths of the tree's levels below the root.
RADII = (1.0, 0.5, 0.25, 0.125)
#: Slack of bounds that single precision needs.
SLACK = 3e-3
#: Rows of a matrix of distances that are made at once.
ROWS = 512

POINTS = "cell string, point bigint, weight bigint, vector array<double>, path array<bigint>"
MEETINGS = "pair string, left boolean, point bigint, weight bigint, vector array<double>, path array<bigint>"


def units(rows: list) -> np.ndarray:
    """Vectors as rows of length 1."""
    x = np.array(rows, np.float64)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def chords(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances between unit vectors."""
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


def pivots(x: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` rows, each farthest from those before it."""
    chosen, near = [0], chords(x, x[:1])[:, 0]
    while len(chosen) < min(most, len(x)) and near.max() > 1e-9:
        k = int(near.argmax())
        chosen.append(k)
        near = np.minimum(near, chords(x, x[k : k + 1])[:, 0])
    return x[chosen]


def cover_tree(x: np.ndarray) -> np.ndarray:
    """For every point its node on each level, as the place of the node's centre; centres stay centres below."""
    path = np.zeros((len(x), len(RADII)), np.int64)
    parent = np.zeros(len(x), np.int64)
    for level, radius in enumerate(RADII):
        home = np.arange(len(x))
        order = np.argsort(parent, kind="stable")
        for own in np.split(order, np.flatnonzero(np.diff(parent[order])) + 1):
            if len(own) > 1:
                centre = parent[own[0]]
                _net(x, np.concatenate(([centre], own[own != centre])), radius, home)
        path[:, level] = parent = home
    return path


def _net(x: np.ndarray, rest: np.ndarray, radius: float, home: np.ndarray) -> None:
    """Deal ``rest`` to centres farther apart than ``radius``, the first point being one; blocks of candidates at once."""
    least = 1 - radius * radius / 2
    while len(rest):
        block = rest[:256]
        near = x[block] @ x[block].T >= least
        chosen: list[int] = []
        for k in range(len(block)):
            taken = np.flatnonzero(near[k, chosen])
            if len(taken):
                home[block[k]] = block[chosen[taken[0]]]
            else:
                home[block[k]] = block[k]
                chosen.append(k)
        rest = rest[256:]
        if len(rest):
            inside = x[rest] @ x[block[chosen]].T >= least
            found = inside.any(1)
            home[rest[found]] = block[chosen][inside[found].argmax(1)]
            rest = rest[~found]


class Side:
    """Points of a cell and the levels of its tree that they are in. Where a node's centre is not among them, its first
    point stands for it; covering radii are measured, so bounds hold either way."""

    def __init__(self, points: np.ndarray, weights: np.ndarray, vectors: np.ndarray, path: np.ndarray):
        self.points, self.weights, self.raw = points, weights, vectors
        self.x = vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))
        self.levels = []
        every = np.zeros(len(points), np.int64)
        last = path.shape[1] - 1
        for k in range(path.shape[1]):
            centres, first, own = np.unique(path[:, k], return_index=True, return_inverse=True)
            if k < last and (len(centres) > len(points) // 2 or len(centres) < 2):
                continue  # a level that groups nearly nothing, or everything, tells no more than the next one
            at = first.copy()
            central = np.flatnonzero(points == path[:, k])
            at[own[central]] = central
            away = np.sqrt(np.maximum(2 - 2 * (self.x * self.x[at[own]]).sum(1), 0))
            radius = np.zeros(len(centres))
            np.maximum.at(radius, own, away)
            up = np.zeros(len(centres), np.int64)
            up[own] = every
            order = np.argsort(own, kind="stable")
            bounds = np.searchsorted(own[order], np.arange(len(centres) + 1))
            self.levels.append((self.x[at].astype(np.float32), radius, up, order, bounds, np.bincount(own, weights, len(centres))))
            every = own


def _members(nodes: np.ndarray, level: tuple) -> tuple[np.ndarray, np.ndarray]:
    """The points of the nodes end to end and how many each has."""
    order, bounds = level[3], level[4]
    n = bounds[nodes + 1] - bounds[nodes]
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(bounds[nodes], n)
    return order[at], n


def _close(one: tuple, two: tuple, limit: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of nodes of two levels that may hold a link, a block of rows at a time, and how far apart their centres are."""
    for low in range(0, len(one[1]), ROWS):
        rows = one[0][low : low + ROWS]
        reach = one[1][low : low + ROWS].max() + two[1].max() + limit + SLACK
        dot = rows @ two[0].T
        i, j = np.nonzero(dot >= 1 - reach * reach / 2) if reach < 2 else np.nonzero(np.ones_like(dot, bool))
        apart = np.sqrt(np.maximum(2 - 2 * dot[i, j], 0))
        i = i + low
        kept = apart <= one[1][i] + two[1][j] + limit + SLACK
        if same:
            kept &= i <= j
        yield i[kept], j[kept], apart[kept]


def dual_traversal(a: Side, b: Side | None, least: float = LEAST_COSINE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights linked to each point, and pairs of places that connect what is linked; places of ``b`` follow those of
    ``a``. Without ``b`` the points of ``a`` are compared with each other."""
    same = b is None
    b = a if same else b
    limit = math.sqrt(2 - 2 * least)
    found = _Links(a, b, least, same)
    depth = len(a.levels) if len(a.levels) == len(b.levels) else 1  # only levels of one radius nest in each other
    levels = list(zip(a.levels[-depth:], b.levels[-depth:]))
    open_ = None
    for k, (one, two) in enumerate(levels):
        parts = []
        for i, j, apart in _close(one, two, limit, same):
            if open_ is not None:  # pairs whose parents were dropped or counted
                up_i, up_j = one[2][i], two[2][j]
                n = len(levels[k - 1][1][1])
                kept = np.isin(np.minimum(up_i, up_j) * n + np.maximum(up_i, up_j) if same else up_i * n + up_j, open_)
                i, j, apart = i[kept], j[kept], apart[kept]
            several = (one[4][i + 1] - one[4][i] > 1) | (two[4][j + 1] - two[4][j] > 1)
            inside = several & (apart + one[1][i] + two[1][j] <= limit - SLACK)
            found.whole(one, two, i[inside], j[inside])
            parts.append((i[~inside], j[~inside]))
        i, j = (np.concatenate([p[c] for p in parts] or [np.zeros(0, np.int64)]) for c in (0, 1))
        open_ = i * len(two[1]) + j
    found.compare(levels[-1][0], levels[-1][1], i, j)
    return found.count, np.concatenate(found.ends or [np.zeros(0, np.int64)]), np.concatenate(found.roots or [np.zeros(0, np.int64)])


class _Links:
    """Links as they are met: the weight at each place, and for linked places another one they are connected with."""

    def __init__(self, a: Side, b: Side, least: float, same: bool):
        self.a, self.b, self.least, self.same = a, b, least, same
        self.shift = 0 if same else len(a.points)
        self.count = np.zeros(self.shift + len(b.points))
        self.ends: list[np.ndarray] = []
        self.roots: list[np.ndarray] = []

    def whole(self, one: tuple, two: tuple, i: np.ndarray, j: np.ndarray) -> None:
        """Every point of one node with every point of the other."""
        for x, y in zip(i.tolist(), j.tolist()):
            p, q = _members(np.array([x]), one)[0], _members(np.array([y]), two)[0] + self.shift
            if self.same and x == y:
                self.count[p] += one[5][x] - self.a.weights[p]
            else:
                self.count[p] += two[5][y]
                self.count[q] += one[5][x]
            both = np.concatenate((p, q))
            self.ends.append(both)
            self.roots.append(np.full(len(both), p[0]))

    def compare(self, one: tuple, two: tuple, i: np.ndarray, j: np.ndarray) -> None:
        """The points of each pair of nodes that is left, one by one."""
        single = (one[4][i + 1] - one[4][i] == 1) & (two[4][j + 1] - two[4][j] == 1)
        self._take(one[3][one[4][i[single]]], two[3][two[4][j[single]]])
        for x, y in zip(i[~single].tolist(), j[~single].tolist()):
            p, q = _members(np.array([x]), one)[0], _members(np.array([y]), two)[0]
            for low in range(0, len(p), ROWS):
                at, to = np.nonzero(self.a.x[p[low : low + ROWS]] @ self.b.x[q].T >= self.least - 1e-9)
                at, to = p[low + at], q[to]
                once = at < to if self.same and x == y else np.ones(len(at), bool)
                self._take(at[once], to[once])

    def _take(self, p: np.ndarray, q: np.ndarray) -> None:
        for low in range(0, len(p), 100_000):
            own, its = p[low : low + 100_000], q[low : low + 100_000]
            if self.same:
                own, its = own[own != its], its[own != its]
            u, v = self.a.raw[own], self.b.raw[its]
            exact = (u * v).sum(1) / (np.sqrt((u * u).sum(1)) * np.sqrt((v * v).sum(1))) >= self.least
            own, its = own[exact], its[exact]
            np.add.at(self.count, own, self.b.weights[its])
            np.add.at(self.count, its + self.shift, self.a.weights[own])
            ends = np.unique(np.concatenate((own, its + self.shift)))  # each end is told once, however many links it has
            root = connected(len(ends), np.searchsorted(ends, own), np.searchsorted(ends, its + self.shift))
            self.ends.append(ends)
            self.roots.append(ends[root])


def connected(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``n`` places the least place connected with it by the pairs."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _side(rows: pd.DataFrame) -> Side:
    return Side(rows["point"].to_numpy(), rows["weight"].to_numpy().astype(float), np.stack(rows["vector"].to_numpy()).astype(float), np.stack(rows["path"].to_numpy()))


def _sound(v: Column) -> Column:
    fine = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return F.coalesce(fine, F.lit(False))


def _cells(points: DataFrame, most: int | None) -> tuple[DataFrame, dict]:
    """The points with the cell each is dealt to (the nearest pivot among vectors of its length, and a part of a crowded
    one), and the pivots by length."""
    n = points.count()
    some = points.orderBy(F.xxhash64("point"), "point").limit(SAMPLE).select("vector").collect()
    by_size: dict[int, list] = {}
    for r in some:
        by_size.setdefault(len(r["vector"]), []).append(r["vector"])
    known = {}
    for d, x in by_size.items():
        wanted = 1 + n * len(x) // (len(some) * (most or max(1, CELL_VALUES // d)))  # about so many cells
        known[d] = pivots(units(x), max(1, min(PIVOTS, int(wanted))))
    broadcast = points.sparkSession.sparkContext.broadcast(known)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, cells = batch.column("vector").to_pylist(), [""] * batch.num_rows
            for d in {len(v) for v in vectors}:
                at = [k for k, v in enumerate(vectors) if len(v) == d]
                near = (units([vectors[k] for k in at]) @ broadcast.value[d].T).argmax(1) if d in broadcast.value else np.zeros(len(at), int)
                for k, c in zip(at, near.tolist()):
                    cells[k] = f"{d}/{c}"
            yield pa.RecordBatch.from_arrays([pa.array(cells, pa.string()), *batch.columns], names=["home", *batch.schema.names])

    dealt = staged(points.mapInArrow(deal, "home string, point bigint, weight bigint, vector array<double>"), "dealt")
    size = F.split_part("home", F.lit("/"), F.lit(1)).cast("long")
    room = F.lit(most) if most else F.greatest(F.floor(F.lit(CELL_VALUES) / size), F.lit(1))
    parts = dealt.groupBy("home").agg(F.count("*").alias("n")).select("home", F.greatest(F.ceil(F.col("n") / room), F.lit(1)).cast("int").alias("parts"))
    parts = {r["home"]: r["parts"] for r in parts.collect()}  # a row for each pivot
    share = F.lit(1)
    if any(n > 1 for n in parts.values()):
        share = F.try_element_at(F.create_map(*(F.lit(x) for k, n in parts.items() if n > 1 for x in (k, n))), F.col("home"))
    part = F.pmod(F.xxhash64("point"), F.coalesce(share, F.lit(1)))
    return dealt.withColumn("cell", F.concat_ws("/", "home", part.cast("string"))).drop("home"), {"pivots": known, "parts": parts}


def _grow(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("point", ignore_index=True)
    path = cover_tree(units(list(rows["vector"])))
    rows["path"] = list(rows["point"].to_numpy()[path])
    return rows[["cell", "point", "weight", "vector", "path"]]


def _reaches(trees: DataFrame, known: dict) -> dict[str, float]:
    """The radius of the ball around each pivot that holds its points."""
    broadcast = trees.sparkSession.sparkContext.broadcast(known["pivots"])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most: dict[str, float] = {}
        for batch in batches:
            for cell, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                d, c, _ = cell.split("/")
                pivot = broadcast.value[int(d)][int(c)] if int(d) in broadcast.value else None
                away = 2.0 if pivot is None else float(chords(units([vector]), pivot[None, :])[0, 0])
                most[f"{d}/{c}"] = max(most.get(f"{d}/{c}", 0.0), away)
        yield pa.RecordBatch.from_arrays([pa.array(list(most), pa.string()), pa.array(list(most.values()), pa.float64())], names=["home", "reach"])

    found = trees.select("cell", "vector").mapInArrow(measure, "home string, reach double").groupBy("home").agg(F.max("reach").alias("reach"))
    return {r["home"]: r["reach"] for r in found.collect()}


def _meetings(trees: DataFrame, known: dict, least: float) -> DataFrame:
    """Each point once for its own cell, and once for each pair of cells in which it may have a link."""
    limit = math.sqrt(2 - 2 * least) + SLACK
    broadcast = trees.sparkSession.sparkContext.broadcast(known | {"reach": _reaches(trees, known)})

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told, parts, reach = (broadcast.value[k] for k in ("pivots", "parts", "reach"))
        for batch in batches:
            pairs, left, rows = [], [], []
            vectors = batch.column("vector").to_pylist()
            for row, (cell, vector) in enumerate(zip(batch.column("cell").to_pylist(), vectors)):
                d, c, part = (int(x) for x in cell.split("/"))
                pairs.append(cell)
                left.append(True)
                rows.append(row)
                if d in told:
                    away = chords(units([vector]), told[d])[0]
                    between = chords(told[d], told[d][c][None, :])[:, 0]
                    ball = np.array([reach.get(f"{d}/{k}", -1.0) for k in range(len(away))])
                    border = (away**2 - away[c] ** 2) / np.maximum(2 * between, 1e-9)
                    near = (ball >= 0) & (away <= ball + limit) & (border <= limit)
                else:
                    near, away = np.ones(1, bool), np.zeros(1)
                near[c] = True
                for k in np.flatnonzero(near).tolist():
                    for other in range(parts.get(f"{d}/{k}", 1)):
                        name = f"{d}/{k}/{other}"
                        if name != cell:
                            pairs.append(f"{min(cell, name)}|{max(cell, name)}")
                            left.append(cell < name)
                            rows.append(row)
                if len(rows) > 4096:
                    yield table(batch, pairs, left, rows)
                    pairs, left, rows = [], [], []
            if rows:
                yield table(batch, pairs, left, rows)

    def table(batch: pa.RecordBatch, pairs: list, left: list, rows: list) -> pa.RecordBatch:
        names = ["point", "weight", "vector", "path"]
        own = batch.select(names).take(pa.array(rows, pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array(pairs, pa.string()), pa.array(left), *own.columns], names=["pair", "left", *names])

    return trees.mapInArrow(deal, MEETINGS)


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", least: float = LEAST_COSINE, most: int | None = None) -> DataFrame:
    """``key``, n_links, component_id and kept for every row.

    n_links counts the other rows with a cosine of at least ``least``; component_id is the least key reachable by
    links. Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do
    vectors of different lengths with each other, nor rows with a null key (whose component is null; they are not
    kept). Rows that share a key are one node of a component, whatever their vectors. ``most`` points make a cell
    (by default as many as have CELL_VALUES numbers).
    """
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("raw"))
    rows = rows.withColumn("raw", F.when(F.col("id").isNotNull() & _sound(F.col("raw")), F.col("raw")))
    groups = rows.where("raw is not null").groupBy("raw").agg(F.min("id").alias("id"), F.count("*").alias("weight"))
    groups = staged(groups.withColumn("point", F.monotonically_increasing_id()), "points")
    points = groups.select("point", "weight", F.transform("raw", lambda x: x.cast("double")).alias("vector"))
    dealt, known = _cells(points, most)
    trees = staged(dealt.select("cell", "point", "weight", "vector").groupBy("cell").applyInPandas(_grow, POINTS), "trees")

    def meet(met: pd.DataFrame) -> pd.DataFrame:
        one, two = met[met["left"]], met[~met["left"]]
        alone = "|" not in met["pair"].iloc[0]
        if not alone and (one.empty or two.empty):
            return pd.DataFrame({"point": [], "links": [], "root": []}).astype("int64")
        a, b = _side(one), None if alone else _side(two)
        count, ends, roots = dual_traversal(a, b, least)
        names = a.points if alone else np.concatenate((a.points, b.points))
        root = connected(len(names), ends, roots)
        linked = count > 0
        return pd.DataFrame({"point": names[linked], "links": count[linked].astype(np.int64), "root": names[root[linked]]})

    found = staged(_meetings(trees, known, least).groupBy("pair").applyInPandas(meet, "point bigint, links bigint, root bigint"), "found")
    links = found.groupBy("point").agg(F.sum("links").alias("links"))
    total = rows.count()
    # rows of one key with several vectors tie what these are linked to
    twice = rows.where("id is not null").groupBy("id").agg(F.count("*").alias("c")).where("c > 1").select("id")
    held = join_hot(rows.join(twice, "id", "left_semi").where("raw is not null"), groups.select("raw", "point", "weight"), "raw", "weight", total).select("id", "point").distinct()
    tied = held.join(held.groupBy("id").agg(F.min("point").alias("root")), "id").where("point <> root").select("point", "root")
    parts = components(found.select(F.col("point").alias("a"), F.col("root").alias("b")).union(tied))
    least_key = groups.join(parts.withColumnRenamed("node", "point"), "point").groupBy("component").agg(F.min("id").alias("component_id"))
    placed = parts.withColumnRenamed("node", "point").join(least_key, "component").select("point", "component_id")
    home = groups.join(links, "point", "left").join(placed, "point", "left")
    home = staged(home.select("raw", "weight", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component_id", "id").alias("component")), "home")
    joined = join_hot(rows, home, "raw", "weight", total)
    if not twice.isEmpty():  # a row without a sound vector still is of its key's component
        of_key = joined.where("component is not null").join(twice, "id", "left_semi").groupBy("id").agg(F.min("component").alias("of_key"))
        joined = joined.join(staged(of_key, "keys"), "id", "left").withColumn("component", F.coalesce("component", "of_key"))
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return joined.select(F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
