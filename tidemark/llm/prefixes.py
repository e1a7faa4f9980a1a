"""A prefix trie of conversations, built as a Patricia tree.

Every turn becomes a 128-bit mark of its role and text, so texts are never moved. Distinct sequences of marks are sorted
over all tasks; neighbours and their common prefixes give the branch points, ends and leaves, which are the only nodes
made, each with the compressed edge above it. Counts, leaves and saved words are summed on this tree as the sorted
sequences go by. A prefix that spans tasks is summed by each of them and united by key, one row a task and depth. At last
the unary nodes inside edges are expanded, their sums being those of the point below plus suffix sums of the edge.

Sequences of more than CHUNK turns are cut: what follows a whole chunk is a trie of its own below it, built first, so no
row holds more than CHUNK marks whatever the length of a conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .runs import digests, ranked
from .shared import join_hot, staged

#: Turns that one sorted row holds at most.
CHUNK = 512
#: Letters of a mark.
_W = 32
FAMILY, MOST_SHARED = 20, 4

_NODE = "id string, root string, parent string, conv bigint, depth bigint, n bigint, ends bigint, children bigint, leaves bigint, below bigint, edge array<bigint>, whole boolean"
_ARROW = pa.schema([
    ("id", pa.string()), ("root", pa.string()), ("parent", pa.string()), *((c, pa.int64()) for c in ("conv", "depth", "n", "ends", "children", "leaves", "below")),
    ("edge", pa.list_(pa.int64())), ("whole", pa.bool_()),
])


def marked(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, place (from 0), mark and words of every turn that has a conversation.

    Turns are ordered by ``turn``, null first, ties by mark; null roles and texts are empty. Words are what blanks separate.
    """
    who, said = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    mark = F.md5(F.concat(F.char_length(who).cast("string"), F.lit(":"), who, said).cast("binary"))
    words = F.regexp_count(said, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")
    plain = turns.where(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("conv_id"), F.col(turn).alias("_turn"), mark.alias("mark"), words.alias("words"))
    return ranked(plain, "conv_id", [F.col("_turn").asc_nulls_first(), F.col("mark")]).drop("_turn")


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id, depth, mark and words of every conversation c after it took over turns of its family's first one.

    Its first h turns become those of conversation c - c % 20 (as many as that has; h is the CRC-32 of c in decimal,
    modulo 4), its other turns follow. A conversation left without turns is one row of depth 0. Rows without a
    conversation are left out; the remainder has the sign of c.
    """
    turns = marked(conversations)
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_SHARED).cast("int")
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    convs = turns.where("place = 0").select("conv_id", h.alias("h"), base.alias("base"))
    leads = turns.where((F.col("place") < MOST_SHARED - 1) & (F.col("conv_id") % FAMILY == 0)).withColumnRenamed("conv_id", "base")
    given = convs.where("h > 0").join(leads, "base").where("place < h").select("conv_id", (F.col("place") + 1).alias("depth"), "mark", "words")
    got = given.groupBy("conv_id").agg(F.count("*").alias("got"))
    short = convs.where("h > 0").join(got, "conv_id", "left").select("conv_id", (F.col("h") - F.coalesce("got", F.lit(0))).alias("missing")).where("missing > 0")
    own = turns.where(F.col("place") >= h).join(short, "conv_id", "left")
    own = own.select("conv_id", (F.col("place") + 1 - F.coalesce("missing", F.lit(0))).alias("depth"), "mark", "words")
    rows = staged(given.unionByName(own), "rebuilt")
    bare = convs.select("conv_id").join(rows.where("depth = 1"), "conv_id", "left_anti")
    return rows.unionByName(bare.select("conv_id", F.lit(0).cast("bigint").alias("depth"), F.lit(None).cast("string").alias("mark"), F.lit(0).cast("bigint").alias("words")))


def node_id(root: Column, seq: Column) -> Column:
    return F.md5(F.concat(root, F.lit("|"), seq).cast("binary"))


def common(a: str, b: str) -> int:
    """How many marks two sequences begin with alike."""
    n, most = 0, min(len(a), len(b))
    while n < most and a[n : n + _W] == b[n : n + _W]:
        n += _W
    return n // _W


@dataclass
class _Point:
    """A node on the path of the sequence last read; ``left``: an earlier task has begun it."""

    depth: int
    left: bool = False
    n: int = 0
    conv: int | None = None
    ends: int = 0
    children: int = 0
    leaves: int = 0
    below: int = 0

    def met(self, conv: int | None, n: int) -> None:
        self.n += n
        if conv is not None:
            self.conv = conv if self.conv is None else min(self.conv, conv)


class Builder:
    """The compressed tree of one root over sorted sequences, as far as one task has them.

    ``shared_left`` and ``shared_right`` are how many marks the first and last sequence share with the tasks beside it: the
    nodes so deep are given out one by one, as parts of sums (whole is false), all others once, with their edges.
    """

    def __init__(self, root: str, shared_left: int, base: int) -> None:
        self.root, self.base, self.seq, self.words = root, base, "", []
        self.left = shared_left
        self.stack = [_Point(d, True) for d in range(shared_left + 1)]
        self.rows: list[tuple] = []

    def add(self, seq: str, words: list[int], item: dict) -> None:
        self.close(common(self.seq, seq) if self.words else self.left, 0)
        self.seq, self.words = seq, words
        if len(words) > self.stack[-1].depth:
            self.stack.append(_Point(len(words)))
        top = self.stack[-1]
        top.met(item["conv"], item["n"])
        top.ends += item["ends"]
        for c in ("children", "leaves", "below"):
            setattr(top, c, getattr(top, c) + (item[c] or 0))

    def close(self, depth: int, right: int) -> None:
        """Gives out what is deeper than ``depth``; prefixes of up to ``right`` marks go on in the next task."""
        while self.stack[-1].depth > depth:
            p = self.stack.pop()
            above = max(self.stack[-1].depth, depth)
            if self.stack[-1].depth < above:
                self.stack.append(_Point(above))
            if not p.children and not p.left and p.depth > right:
                p.leaves = 1
            edge = self.words[above : p.depth]
            self._tell(p, above, edge, right)
            up = self.stack[-1]
            up.met(p.conv, p.n)
            up.leaves += p.leaves
            up.children += not p.left
            up.below += p.below + (p.n - (not p.left)) * sum(edge)

    def _tell(self, p: _Point, above: int, edge: list[int], right: int) -> None:
        if p.left:
            self._row(p, p.depth, p.depth - 1, p.ends, p.children, p.below, [edge[-1]], False)
            return
        below = p.below
        split = min(p.depth, max(above, right))
        rest = self.words[split : p.depth]
        if rest:
            sums, total = [], 0
            for w in reversed(rest):
                total += w
                sums.append(total)
            self._row(p, p.depth, split, p.ends, p.children, p.below, sums[::-1], True)
            below += (p.n - 1) * total
        for d in range(split, above, -1):
            last = d == p.depth
            self._row(p, d, d - 1, p.ends if last else 0, p.children if last else 1, below, [self.words[d - 1]], False)
            below += (p.n - 1) * self.words[d - 1]

    def _row(self, p: _Point, depth: int, above: int, ends: int, children: int, below: int, edge: list[int], whole: bool) -> None:
        self.rows.append((self._id(depth), None, self._id(above), p.conv, self.base + depth, p.n, ends, children, p.leaves, below, edge, whole))

    def _id(self, depth: int) -> str:
        return hashlib.md5(f"{self.root}|{self.seq[: depth * _W]}".encode()).hexdigest()

    def finish(self, right: int) -> None:
        self.close(0, right)
        p = self.stack[0]
        self.rows.append((self._id(0), self.root, None, p.conv, self.base, p.n, p.ends, p.children, p.leaves, p.below, [0], False))


def _sorted_items(items: DataFrame) -> DataFrame:
    """Items in the order of root and sequence over all tasks, with part and row; staged."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            at = pa.array(range(row, row + batch.num_rows), pa.int64())
            row += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * batch.num_rows, pa.int32()), at], names=[*batch.schema.names, "part", "row"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema) + ", part int, row bigint"
    return staged(items.repartitionByRange("root", "seq").sortWithinPartitions("root", "seq").mapInArrow(number, schema), "sequences")


def _borders(rows: DataFrame) -> dict[int, tuple[int, int]]:
    """For each part, how many marks it shares with the one before and the one after; -1 where the root is another."""
    ends = rows.groupBy("part").agg(F.min_by(F.struct("root", "seq"), "row").alias("first"), F.max_by(F.struct("root", "seq"), "row").alias("last"))
    out: dict[int, tuple[int, int]] = {}
    before = None
    for r in ends.orderBy("part").toLocalIterator():  # two sequences of a part at a time
        shared = common(before[1]["seq"], r["first"]["seq"]) if before and before[1]["root"] == r["first"]["root"] else -1
        if before:
            out[before[0]] = (out[before[0]][0], shared)
        out[r["part"]] = (shared, -1)
        before = (r["part"], r["last"])
    return out


def _points(rows: DataFrame, base: int) -> DataFrame:
    """The compressed tree's nodes, those of several tasks still in parts."""
    borders = rows.sparkSession.sparkContext.broadcast(_borders(rows))  # two numbers a part

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, tree = (None, None), None
        for batch in batches:
            for r in batch.to_pylist():
                if (r["part"], r["root"]) != now:
                    if tree:
                        tree.finish(max(0, borders.value[now[0]][1]) if r["part"] != now[0] else 0)
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*tree.rows), _ARROW.types)], schema=_ARROW)
                    tree = Builder(r["root"], max(0, borders.value[r["part"]][0]) if r["part"] != now[0] else 0, base)
                    now = (r["part"], r["root"])
                tree.add(r["seq"], r["words"], r)
                if len(tree.rows) > 4096:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*tree.rows), _ARROW.types)], schema=_ARROW)
                    tree.rows = []
        if tree:
            tree.finish(max(0, borders.value[now[0]][1]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*tree.rows), _ARROW.types)], schema=_ARROW)

    dealt = rows.repartition("part").sortWithinPartitions("part", "row")
    return staged(dealt.mapInArrow(build, _NODE), "points")


def trie(sequences: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """One row for each distinct prefix of the conversations, the empty one included: conv_id (its smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256.

    ``sequences`` has conv_id, depth (1, 2, ... without gaps; a row of depth 0 stands for a conversation without turns),
    mark and words; each pair of conv_id and depth once. saved_tokens are the words that need not be read again where members
    share a prefix; ends_sha256 is that of the sorted, comma-joined conv_ids that end there. No rows give no nodes.
    """
    spark = sequences.sparkSession
    top = sequences.agg(F.max("depth")).first()[0]
    if top is None:
        return _named(spark.createDataFrame([], _NODE).withColumns({"parent_conv": F.lit(None).cast("bigint"), "ends_sha256": F.lit("")}))
    level = F.greatest(F.floor((F.col("depth") - 1) / chunk), F.lit(0)).cast("int")
    rows = sequences.groupBy("conv_id", level.alias("level")).agg(F.array_sort(F.collect_list(F.struct("depth", "mark", "words"))).alias("all"))
    turns = F.filter("all", lambda x: x["mark"].isNotNull())
    rows = rows.select("conv_id", "level", F.array_join(F.transform(turns, lambda x: x["mark"]), "").alias("seq"), F.transform(turns, lambda x: x["words"]).alias("words"))
    levels = max(0, top - 1) // chunk + 1
    if levels > 1:  # a chunk hangs below all chunks before it
        own = [F.xxhash64("level", "seq"), F.xxhash64("seq", "level", F.lit(1))]
        w = Window.partitionBy("conv_id").orderBy("level")
        named = lambda frame: F.concat_ws(".", *(F.hex(F.bit_xor(x).over(frame)) for x in own))
        upto = named(w.rowsBetween(Window.unboundedPreceding, 0))
        before = F.when(F.col("level") == 0, "").otherwise(named(w.rowsBetween(Window.unboundedPreceding, -1)))
        follows = F.lead("level").over(w).isNotNull()
        rows = rows.select("*", before.alias("root"), F.when(follows, upto).alias("next"))
    else:
        rows = rows.select("*", F.lit("").alias("root"), F.lit(None).cast("string").alias("next"))
    rows = staged(rows, "chunks")
    parts, above, below = [], [], None
    for k in reversed(range(levels)):
        items = rows.where(F.col("level") == k).groupBy("root", "seq").agg(
            F.first("words").alias("words"), F.count("*").alias("n"), F.min("conv_id").alias("conv"), F.count_if(F.col("next").isNull()).alias("ends"), F.max("next").alias("next"),
        )
        if below is None:
            items = items.select("*", *(F.lit(0).cast("bigint").alias(c) for c in ("children", "leaves", "below")))
        else:
            items = items.join(below, "next", "left")
        items = _sorted_items(items)
        # later chunks hang below the point that ends this one
        above.append(items.where("next is not null").select(node_id(F.col("next"), F.lit("")).alias("id"), "conv", "children"))
        found = _points(items, k * chunk)
        united = found.where(~F.col("whole")).groupBy("id").agg(
            F.first("root").alias("root"), F.first("parent").alias("parent"), F.min("conv").alias("conv"), F.first("depth").alias("depth"),
            *(F.sum(c).alias(c) for c in ("n", "ends", "children", "leaves", "below")), F.first("edge").alias("edge"), F.lit(False).alias("whole"),
        )
        united = staged(united, "united")
        below = united.where(F.col("root").isNotNull()).select(F.col("root").alias("next"), "children", "leaves", "below")
        parts.append((found.where("whole"), united))
    points = None
    for whole, united in parts:
        both = whole.unionByName(united)
        points = both if points is None else points.unionByName(both)
    points = staged(points, "trie")
    real = F.col("root").isNull() | (F.col("root") == "")  # the roots of later chunks are points of earlier ones
    up = points.where(real & (F.col("children") > 0)).select("id", "conv", "children")
    for part in above:
        up = up.unionByName(part)
    up = up.toDF("parent", "parent_conv", "kids")
    ends = rows.where("next is null").select(node_id(F.col("root"), F.col("seq")).alias("id"), "conv_id", F.col("conv_id").cast("string").alias("ends"))
    ended = digests(ends, "id", ["conv_id"], ["ends"], separator=",")
    nodes = join_hot(points.where(real), up, "parent", "kids", points.count())
    return _named(nodes.join(ended, "id", "left"))


def _named(points: DataFrame) -> DataFrame:
    """Expands edges to nodes."""
    nodes = points.select("*", F.posexplode("edge").alias("at", "suffix"), F.size("edge").alias("long"))
    last = F.col("at") == F.col("long") - 1
    n = lambda c: F.col(c).cast("bigint")
    top = (F.col("depth") == 0) & (F.col("children") == 0)
    return nodes.select(
        F.col("conv").alias("conv_id"), (n("depth") - F.col("long") + 1 + F.col("at")).alias("depth"),
        F.when(F.col("at") > 0, F.col("conv")).otherwise(F.col("parent_conv")).alias("parent_conv_id"), n("n").alias("n_convs"),
        F.when(last, n("children")).otherwise(F.lit(1).cast("bigint")).alias("n_children"), F.when(top, F.lit(1).cast("bigint")).otherwise(n("leaves")).alias("n_leaves"),
        F.when(F.col("depth") == 0, n("below")).otherwise(n("below") + (n("n") - 1) * F.col("suffix")).alias("saved_tokens"),
        F.when(last & F.col("ends_sha256").isNotNull(), F.col("ends_sha256")).otherwise(F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
