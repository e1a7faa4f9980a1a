"""Near-duplicates by the Jaccard similarity of word n-gram sets.

Copies share one set and count once from the start. N-grams are put in a rare-first order by counts over all
documents, kept in a table of fixed size that hashed n-grams share. Two sets that are similar enough share an n-gram
in their prefixes of that order, so documents meet on prefix n-grams, under length and positional filters. They
first meet one leading document for each n-gram and length band; links found there join most groups of near copies.
Then only pairs that are still in different components meet. A suffix filter (overlaps bounded by hashed counts)
goes before each pair's one verification on whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import LOWER, join_hot, mix, row_of, runs, sieve, sifted, span_hashes, staged, steps, utf8

SHINGLE_WORDS = 4
#: Similarity in hundredths.
LEAST_PERCENT = 85
#: Counters of hashed n-grams; the table stays this size whatever the corpus holds.
COUNTERS = 1 << 21
#: Hash ranges of the suffix filter.
RANGES = 64
_CHUNK = 1 << 13

_WORD = np.ones(256, bool)
_WORD[[0x20, 9, 10, 11, 12, 13]] = False


def shingle_sets(column: pa.Array, words: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of every row as sorted 64-bit hashes end to end, and each row's bounds in them."""
    data, bounds = utf8(column)
    data = LOWER[data]
    starts, ends = runs(data, bounds, _WORD)
    hashes = span_hashes(data, starts, ends)
    rows = row_of(starts, bounds)
    n = len(column)
    counts = np.bincount(rows, minlength=n)
    base = np.cumsum(counts) - counts
    left = base[rows] + counts[rows] - np.arange(len(rows))  # words from here to the row's end
    value, size = np.zeros(len(rows), np.uint64), np.minimum(left, words)
    for k in range(words):
        has = k < size
        at = np.flatnonzero(has)
        value[at] = mix(value[at] * np.uint64(0x9E3779B97F4A7C15) + hashes[at + k] + np.uint64(k + 1))
    whole = (left >= words) | ((np.arange(len(rows)) == base[rows]) & (counts[rows] < words))
    value, rows = value[whole], rows[whole]
    order = np.lexsort((value, rows))
    value, rows = value[order], rows[order]
    if len(value):
        new = np.concatenate(([True], (value[1:] != value[:-1]) | (rows[1:] != rows[:-1])))
        value, rows = value[new], rows[new]
    return value, np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=n))))


def _row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
    return (total[bounds[1:]] - total[bounds[:-1]]).view(np.int64)


def _counter(values: np.ndarray, counters: int) -> np.ndarray:
    return (values >> np.uint64(17)).astype(np.int64) % counters


def measure(docs: DataFrame, key: str, text: str, words: int, counters: int) -> DataFrame:
    """A row for each document (node, n, two fingerprints of its set) and, per task, n-gram counts in chunks."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, waiting = np.zeros(counters, np.int32), []
        names = ["node", "n", "f1", "f2", "chunk", "counts"]

        def count() -> None:
            if waiting:
                counts[:] += np.bincount(np.concatenate(waiting), minlength=counters).astype(np.int32)
                waiting.clear()

        for batch in steps(batches, text):
            value, bounds = shingle_sets(batch.column(text), words)
            waiting.append(_counter(value, counters))
            if sum(map(len, waiting)) > 1 << 20:
                count()
            k = batch.num_rows
            yield pa.RecordBatch.from_arrays([
                batch.column(key), pa.array(np.diff(bounds), pa.int64()), pa.array(_row_sums(value, bounds)),
                pa.array(_row_sums(mix(value ^ np.uint64(0xA5A5A5A5A5A5A5A5)), bounds)), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary()),
            ], names=names)
        count()
        for c in range(0, counters, _CHUNK):
            own = counts[c : c + _CHUNK]
            if own.any():
                yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64())] + [pa.nulls(1, pa.int64())] * 3 + [pa.array([c], pa.int32()), pa.array([own.tobytes()])], names=names)

    return docs.select(F.col(key).cast("long").alias(key), text).mapInArrow(scan, "node bigint, n bigint, f1 bigint, f2 bigint, chunk int, counts binary")


def _added(chunks: DataFrame, counters: int) -> np.ndarray:
    """The counts of all tasks: added up by chunk on the executors, then ``counters`` numbers in all."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for c, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums.setdefault(c, np.zeros(len(data) // 4, np.int64))
                sums[c] += np.frombuffer(data, np.int32)
        for c, own in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([own.tobytes()])], names=["chunk", "counts"])

    total = np.zeros(counters, np.int64)
    for r in chunks.repartition("chunk").mapInArrow(add, "chunk int, counts binary").toLocalIterator():
        own = np.frombuffer(r["counts"], np.int64)
        total[r["chunk"] : r["chunk"] + len(own)] = own
    return total


def _prefixes(docs: DataFrame, key: str, text: str, words: int, percent: int, totals: np.ndarray) -> DataFrame:
    """node, n, the rare-first prefix of its set, and how much of the set lies in each hash range."""
    broadcast = docs.sparkSession.sparkContext.broadcast(totals)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = broadcast.value
        for batch in steps(batches, text):
            value, bounds = shingle_sets(batch.column(text), words)
            n = np.diff(bounds)
            rows = np.repeat(np.arange(batch.num_rows), n)
            shape = np.bincount(rows * RANGES + (value & np.uint64(RANGES - 1)).astype(np.int64), minlength=batch.num_rows * RANGES)
            order = np.lexsort((value, counts[_counter(value, len(counts))], rows))
            prefix = np.where(n > 0, n - -(-percent * n // 100) + 1, 0)
            place = np.arange(len(value)) - bounds[:-1][rows]
            first = order[place < prefix[rows]]
            yield pa.RecordBatch.from_arrays([
                batch.column(key), pa.array(n, pa.int64()),
                pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(prefix))).astype(np.int32), pa.array(value[first].view(np.int64))),
                pa.FixedSizeListArray.from_arrays(pa.array(shape, pa.int32()), RANGES).cast(pa.list_(pa.int32())),
            ], names=["node", "n", "prefix", "shape"])

    return docs.select(key, text).mapInArrow(scan, "node bigint, n bigint, prefix array<bigint>, shape array<int>")


def _sets(docs: DataFrame, key: str, text: str, words: int, wanted: DataFrame) -> DataFrame:
    """node and shingles of at least the documents in ``wanted``; the filter spares moving any text."""
    broadcast = docs.sparkSession.sparkContext.broadcast(sieve(wanted))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen = batch.filter(pa.array(sifted(batch.column(key).to_numpy(), broadcast.value)))
            for own in steps(iter([chosen]), text):
                value, bounds = shingle_sets(own.column(text), words)
                yield pa.RecordBatch.from_arrays([own.column(key), pa.ListArray.from_arrays(bounds.astype(np.int32), pa.array(value.view(np.int64)))], names=["node", "shingles"])

    return docs.where(F.col(key).isNotNull()).select(key, text).mapInArrow(scan, "node bigint, shingles array<bigint>")


def _enough(overlap: Column, percent: int) -> Column:
    """Whether an overlap of sets of x_n and y_n suffices: 100 i >= p (x + y - i)."""
    return (100 + percent) * overlap >= percent * (F.col("x_n") + F.col("y_n"))


def _verified(pairs: DataFrame, shapes: DataFrame, leads: DataFrame, sets, percent: int) -> DataFrame:
    """The pairs (x, y, each once) that are similar enough: suffix filter first, then whole sets."""
    shape = lambda v: shapes.select(F.col("node").alias(v), F.col("n").alias(f"{v}_n"), F.col("shape").alias(f"{v}_shape"))
    bound = F.aggregate(F.zip_with("x_shape", "y_shape", lambda a, b: F.least(a, b)), F.lit(0), lambda s, v: s + v)
    left = staged(pairs.distinct().join(shape("x"), "x").join(shape("y"), "y").where(_enough(bound, percent)).select("x", "y", "x_n", "y_n"), "pairs")
    known = sets(left.select("x").union(left.select("y")).distinct()).join(leads, "node", "left_semi")
    known = staged(known, "shingles")
    whole = lambda v: known.select(F.col("node").alias(v), F.col("shingles").alias(f"{v}_set"))
    common = F.size(F.array_intersect("x_set", "y_set")).cast("long")
    return left.join(whole("x"), "x").join(whole("y"), "y").where(_enough(common, percent)).select("x", "y")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS, percent: int = LEAST_PERCENT, counters: int = COUNTERS) -> DataFrame:
    """``key``, n_shingles and component_id (the least key reachable by links) for every document.

    Links are pairs of different texts with a Jaccard similarity of at least ``percent`` hundredths; rows with
    equal non-empty sets are linked too. Texts without words (null, empty, blank) link with nothing. Rows that share
    a key are one node. Rows with a null key keep n_shingles and have no component. ``key`` is a whole number.
    """
    docs = docs.select(F.col(key).cast("long").alias(key), text)
    seen = staged(measure(docs, key, text, words, counters), "sets")
    rows = seen.where("chunk is null").select("node", "n", "f1", "f2")
    totals = _added(seen.where("chunk is not null").select("chunk", "counts"), counters)
    groups = staged(rows.where("n > 0 and node is not null").groupBy("n", "f1", "f2").agg(F.min("node").alias("lead"), F.count("*").alias("copies")), "groups")
    leads = groups.select(F.col("lead").alias("node"))

    prefixes = staged(_prefixes(docs, key, text, words, percent, totals).join(leads, "node", "left_semi"), "prefixes")
    shapes = prefixes.select("node", "n", "shape")
    grams = prefixes.select("node", "n", F.posexplode("prefix").alias("at", "gram"))
    shared = grams.select("gram").groupBy("gram").agg(F.count("*").alias("c")).where("c > 1")
    band = F.floor(F.log(F.col("n").cast("double")) / float(-np.log(percent / 100) / 2 + 1e-9)).cast("int")
    grams = staged(grams.join(shared, "gram").withColumn("band", band), "grams")
    sets = lambda wanted: _sets(docs, key, text, words, wanted)

    # for each n-gram and length band the document whose n-grams are met most, which is what copies were made from
    met = grams.groupBy("node").agg(F.sum("c").alias("met"))
    heads = grams.join(met, "node").groupBy("gram", "band").agg(F.max(F.struct("met", "node")).alias("head"), F.count("*").alias("k")).where("k > 1").select("gram", "band", F.col("head.node").alias("y"))
    links = grams.join(heads, ["gram", "band"]).where("node <> y").groupBy(F.col("node").alias("x"), "y").agg(F.count("*").alias("k"))
    best = links.groupBy("x").agg(F.max(F.struct("k", "y")).alias("m")).select("x", "m.y")
    links = staged(_verified(best, shapes, leads, sets, percent), "links")
    parts = staged(components(links, "x", "y"), "parts")

    # then all pairs that share a prefix n-gram and are not yet in one component
    placed = staged(grams.join(parts, "node", "left").select("gram", "node", "n", "at", F.coalesce("component", "node").alias("part")), "placed")
    here = placed.groupBy("gram", "part").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.max(F.col("n") - F.col("at")).alias("rest"))
    several = here.groupBy("gram").agg(F.min("part").alias("p"), F.max("part").alias("q")).where("p < q").select("gram")
    here = here.join(several, "gram")
    x_part, y_part = (here.select("gram", *(F.col(c).alias(f"{v}_{c}") for c in ("part", "least", "most", "rest"))) for v in "xy")
    close = (100 * F.col("x_most") >= percent * F.col("y_least")) & (100 * F.col("y_most") >= percent * F.col("x_least"))
    far_enough = (100 + percent) * F.least("x_rest", "y_rest") >= percent * (F.col("x_least") + F.col("y_least"))
    meet = x_part.join(y_part, "gram").where((F.col("x_part") < F.col("y_part")) & close & far_enough).select("gram", "x_part", "y_part", "y_least", "y_most", "y_rest")
    side = lambda v: placed.select("gram", F.col("part").alias(f"{v}_part"), F.col("node").alias(v), F.col("n").alias(f"{v}_n"), F.col("at").alias(f"{v}_at"))
    # the same bounds for each document of x's part before y's documents come in
    fits = (100 * F.col("x_n") >= percent * F.col("y_least")) & (100 * F.col("y_most") >= percent * F.col("x_n"))
    fits = fits & ((100 + percent) * F.least(F.col("x_n") - F.col("x_at"), F.col("y_rest")) >= percent * (F.col("x_n") + F.col("y_least")))
    pairs = meet.join(side("x"), ["gram", "x_part"]).where(fits).join(side("y"), ["gram", "y_part"])
    pairs = pairs.where((100 * F.least("x_n", "y_n") >= percent * F.greatest("x_n", "y_n")) & _enough(F.least(F.col("x_n") - F.col("x_at"), F.col("y_n") - F.col("y_at")), percent))
    more = staged(_verified(pairs.select("x", "y"), shapes, leads, sets, percent), "links")
    parts = staged(components(links.union(more), "x", "y"), "parts")

    alike = F.struct("n", "f1", "f2")
    home = groups.join(parts.withColumnRenamed("node", "lead"), "lead", "left").select(alike.alias("alike"), "copies", F.coalesce("component", "lead").alias("component_id"))
    # rows without words or a key have no group; the rows of a very large one stay where they are
    marked = rows.select("node", "n", F.when((F.col("n") > 0) & F.col("node").isNotNull(), alike).alias("alike"))
    joined = join_hot(marked, staged(home, "homes"), "alike", "copies", rows.count())
    return joined.select(F.col("node").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("node").isNotNull(), F.coalesce("component_id", "node")).alias("component_id"))
