"""Centroid clustering (Lloyd's rounds) by ball-tree filtering.

The kept vectors are dealt into blocks once; each block becomes a metric tree whose nodes hold a centre, a covering
radius, a count and the exact sum of their vectors, and is written to the shared folder. In a round, a task walks its
trees level by level with the centroids that may still be nearest to some vector of a node: one that is farther from the
ball than another centroid can be from any of its vectors goes, and a ball with one centroid left is assigned whole, by
its count and sum. Balls that stay mixed down to their leaves are settled by exact whole-number distances. What is
shuffled is a sum for each centroid and component of a task; the driver holds the centroids only.

Everything that decides is whole-number arithmetic: bounds are widened by more than doubles can err, so a centroid that
ties with the nearest is never dropped before the exact step, which takes the smaller number.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import staged

SIZE, CENTROIDS, ROUNDS, SCALE = 64, 16, 3, 64.0
#: Vectors of one tree, and of a leaf.
BLOCK, LEAF = 8192, 24
#: Components must lie within so many units of 0, so that squared distances fit a whole number of 64 bits.
MOST_UNITS = 1 << 27
#: Rows that one exact step compares with all centroids.
_STEP = 4096

TREE = "ids array<bigint>, points binary, low array<int>, high array<int>, left array<int>, radius array<double>, sums binary"


def scaled(vector: Column, size: int = SIZE, scale: float = SCALE) -> Column:
    """The vector's components as floor(scale * x), or null where it is not kept.

    Kept are vectors of exactly ``size`` components, none null, not finite or beyond MOST_UNITS units.
    """
    # null and NaN fail the test; both infinities are out of bounds
    bound = F.lit(MOST_UNITS / scale)
    x = F.transform(vector, lambda v: v.cast("double"))
    fine = (F.size(vector) == size) & F.forall(x, lambda v: F.coalesce((v >= -bound) & (v < bound), F.lit(False)))
    return F.when(fine, F.transform(x, lambda v: F.floor(v * scale).cast("int")))


@dataclass
class Tree:
    """A metric tree over vectors in tree order: node k holds rows low[k]:high[k]; its children are left[k] and left[k] + 1."""

    ids: np.ndarray
    points: np.ndarray
    low: np.ndarray
    high: np.ndarray
    left: np.ndarray
    radius: np.ndarray
    sums: np.ndarray

    def row(self) -> dict:
        return {"ids": self.ids, "points": self.points.astype(np.int32).tobytes(), "low": self.low, "high": self.high, "left": self.left, "radius": self.radius, "sums": self.sums.tobytes()}


def grow(ids: np.ndarray, points: np.ndarray, leaf: int = LEAF) -> Tree:
    """Splits by the nearer of two far ends until at most ``leaf`` vectors or equal ones are left. ``ids`` may be any objects."""
    order = np.arange(len(points))
    real = points.astype(np.float64)
    low, high, left, radius, sums = [0], [len(points)], [-1], [], []
    k = 0
    while k < len(low):
        own = order[low[k] : high[k]]
        total = points[own].sum(0, dtype=np.int64)
        sums.append(total)
        x = real[own]
        off = np.sqrt(((x - total / len(own)) ** 2).sum(1))
        radius.append(float(off.max()))
        if len(own) > leaf:
            a = x[int(off.argmax())]
            from_a = ((x - a) ** 2).sum(1)
            b = x[int(from_a.argmax())]
            near = from_a <= ((x - b) ** 2).sum(1)
            n = int(near.sum())
            if 0 < n < len(own):
                order[low[k] : high[k]] = np.concatenate((own[near], own[~near]))
                left[k] = len(low)
                low += [low[k], low[k] + n]
                high += [low[k] + n, high[k]]
                left += [-1, -1]
        k += 1
    i4 = lambda v: np.array(v, np.int32)
    return Tree(ids[order], points[order], i4(low), i4(high), i4(left), np.array(radius), np.array(sums, np.int64))


def _squares(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole vectors to whole centroids."""
    most = max(int(np.abs(points).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    if most < 1 << 21:  # products and their sums stay exact in doubles
        x, c = points.astype(np.float64), centroids.astype(np.float64)
        return ((x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)).astype(np.int64)
    x = points.astype(np.int64)
    return np.stack([((x - c) ** 2).sum(1) for c in centroids.astype(np.int64)], 1)


def assign(tree: Tree, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Each row's nearest centroid, the vectors and their sum for each centroid, and how many balls were taken whole."""
    k = len(centroids)
    out = np.full(len(tree.points), -1, np.int32)
    count, total = np.zeros(k, np.int64), np.zeros((k, tree.points.shape[1]), np.int64)
    real, whole = centroids.astype(np.float64), 0
    size = (tree.high - tree.low).astype(np.int64)
    node, may = np.zeros(1, np.int64), np.ones((1, k), bool)
    mixed = []
    while len(node):
        centre = tree.sums[node] / size[node][:, None]
        d = np.sqrt(((centre[:, None, :] - real[None]) ** 2).sum(2))
        r = tree.radius[node][:, None]
        spare = 1e-9 * (d + r + np.abs(real).max(initial=1.0))
        least = np.where(may, d + r + spare, np.inf).min(1)
        may &= d - r - spare <= least[:, None]
        one = may.sum(1) == 1
        for n, c in zip(node[one], may[one].argmax(1)):
            out[tree.low[n] : tree.high[n]] = c
            count[c] += size[n]
            total[c] += tree.sums[n]
            whole += 1
        leaf = ~one & (tree.left[node] < 0)
        mixed += [np.arange(tree.low[n], tree.high[n]) for n in node[leaf]]
        rest = ~one & ~leaf
        children = tree.left[node[rest]].astype(np.int64)
        node, may = np.concatenate((children, children + 1)), np.concatenate((may[rest], may[rest]))
    if mixed:
        rows = np.concatenate(mixed)
        for s in range(0, len(rows), _STEP):
            own = rows[s : s + _STEP]
            near = _squares(tree.points[own], centroids).argmin(1)  # the first of equals
            out[own] = near
            count += np.bincount(near, minlength=k)
            np.add.at(total, near, tree.points[own].astype(np.int64))
    return out, count, total, whole


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[Tree]:
    for batch in batches:
        for r in batch.to_pylist():
            points = np.frombuffer(r["points"], np.int32)
            sums = np.frombuffer(r["sums"], np.int64)
            nodes = len(r["low"])
            i4 = lambda v: np.array(v, np.int32)
            yield Tree(
                np.array(r["ids"], object), points.reshape(len(r["ids"]), -1), i4(r["low"]), i4(r["high"]),
                i4(r["left"]), np.array(r["radius"]), sums.reshape(nodes, -1),
            )


def forest(kept: DataFrame, key: str, block: int = BLOCK, leaf: int = LEAF) -> DataFrame:
    """The staged trees of rows with ``key`` and whole components ``units``: one row for each block of a task's vectors."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, held = [c.split()[0] for c in TREE.split(", ")], []

        def made(rows: pa.Table) -> pa.RecordBatch:
            points = rows.column("units").combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1)
            tree = grow(np.array(rows.column(key).to_pylist(), object), points, leaf).row()
            return pa.RecordBatch.from_pylist([{n: tree[n].tolist() if n == "ids" else tree[n] for n in names}], schema=_ARROW)

        n = 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, block - n)
                held.append(part)
                n += part.num_rows
                batch = batch.slice(part.num_rows)
                if n == block:
                    yield made(pa.Table.from_batches(held))
                    held, n = [], 0
        if n:
            yield made(pa.Table.from_batches(held))

    return staged(kept.select(key, "units").mapInArrow(build, TREE), "trees")


_ARROW = pa.schema([
    ("ids", pa.list_(pa.int64())), ("points", pa.binary()), ("low", pa.list_(pa.int32())), ("high", pa.list_(pa.int32())),
    ("left", pa.list_(pa.int32())), ("radius", pa.list_(pa.float64())), ("sums", pa.binary()),
])


def first_centroids(kept: DataFrame, key: str, n: int = CENTROIDS) -> np.ndarray:
    """The ``n`` vectors with the smallest SHA-256 of ``1:<key>``, in that order; equal keys by their components."""
    order = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    found = kept.select(order.alias("order"), "units").orderBy("order", "units").limit(n).collect()
    return np.array([r["units"] for r in found], np.int64)


def cluster(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", centroids: int = CENTROIDS, rounds: int = ROUNDS, size: int = SIZE, scale: float = SCALE, block: int = BLOCK, leaf: int = LEAF) -> DataFrame:
    """key, cluster, distance, cluster_inertia, inertia and centroid_sha256 for every kept vector (see ``scaled``).

    Distances are squared and exact; ties go to the smaller number. A round replaces each non-empty centroid by the
    componentwise floor of its vectors' mean, empty ones stay; after ``rounds`` the vectors are assigned once more.
    Repeated rows and keys count as they stand; a null key is a vector like others, hashed as an empty text. Fewer kept
    vectors than ``centroids`` give as many clusters as there are vectors; none give an empty result. Other columns of
    the table are left out, whatever their names. Sums of distances beyond 64 bits are null.
    """
    spark = vectors.sparkSession
    kept = vectors.select(F.col(key).cast("bigint").alias("id"), scaled(F.col(vector), size, scale).alias("units")).where("units is not null")
    now = first_centroids(kept, "id", centroids)
    out = f"`{key}` bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    if not len(now):
        return spark.createDataFrame([], out)
    trees = forest(kept, "id", block, leaf)
    for _ in range(rounds):
        at = spark.sparkContext.broadcast(now)

        def gather(batches: Iterator[pa.RecordBatch], at=at) -> Iterator[pa.RecordBatch]:
            """A task's count (component -1) and sums for each centroid."""
            c = at.value
            total = np.zeros((len(c), c.shape[1] + 1), np.int64)
            for tree in _trees(batches):
                _, count, sums, _ = assign(tree, c)
                total[:, 0] += count
                total[:, 1:] += sums
            full = np.flatnonzero(total[:, 0])
            n = c.shape[1] + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(full, n).astype(np.int32)), pa.array(np.tile(np.arange(-1, n - 1), len(full)).astype(np.int32)), pa.array(total[full].ravel())],
                names=["cluster", "component", "total"],
            )

        sums = trees.mapInArrow(gather, "cluster int, component int, total bigint").groupBy("cluster", "component").agg(F.sum("total").alias("total"))
        found = {(r["cluster"], r["component"]): r["total"] for r in sums.collect()}  # centroids times components at most
        at.destroy()
        now = np.array([[found[c, j] // found[c, -1] for j in range(size)] if (c, -1) in found else now[c] for c in range(len(now))], np.int64)
    last = spark.sparkContext.broadcast(now)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tree in _trees(batches):
            near, _, _, _ = assign(tree, last.value)
            off = tree.points.astype(np.int64) - last.value[near]
            yield pa.RecordBatch.from_arrays([pa.array(tree.ids.tolist(), pa.int64()), pa.array(near), pa.array((off * off).sum(1))], names=["id", "cluster", "distance"])

    rows = staged(trees.mapInArrow(label, "id bigint, cluster int, distance bigint"), "clustered")
    per = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("cluster_inertia")).collect()  # one row for each centroid at most
    total = sum(r["cluster_inertia"] for r in per)
    fits = lambda v: int(v) if v < 1 << 63 else None
    told = spark.createDataFrame(
        [(r["cluster"], fits(r["cluster_inertia"]), fits(total), ",".join(map(str, now[r["cluster"]]))) for r in per],
        "cluster int, cluster_inertia bigint, inertia bigint, components string",
    )
    told = F.broadcast(told.select("cluster", "cluster_inertia", "inertia", F.sha2("components", 256).alias("centroid_sha256")))
    return rows.join(told, "cluster").select(F.col("id").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
