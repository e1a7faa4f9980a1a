"""Best-fit packing by large-item matching.

Documents become token ids (byte-level BPE by the ``tokenizers`` library) with an end id; only documents longer
than the capacity are cut. The packing is solved on the histogram of piece lengths, which has at most ``capacity``
rows whatever the corpus holds: lengths above a third of the capacity are matched greedily, two to a sequence at
most, then shorter lengths go to the smallest gap that takes them. Every piece then looks its place up by its rank
among the pieces of its length, so no task ever holds more than its own rows.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import KEPT, staged, steps

CAPACITY = 1024
END_ID = 2
VOCABULARY = "byte_bpe_50k.json"
#: Words kept with their ids in a Python worker; beyond it the table starts afresh, which changes no result.
KNOWN_WORDS = 200_000

PIECES = (
    "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, task int, place bigint"
)


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Where the installed public tokenizer files have ``name``."""
    import public_tokenizers

    return public_tokenizers.path(name)


# fixed values: the pre-tokenizer's pattern for texts of PLAIN characters alone, where ``re`` can say its classes
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼½¾", " \t\n\r"
PLAIN = re.compile("[\t\n\r\x20-\x7e\xa1-ɏ]*")
PLAIN_WORDS = re.compile(rf" ?[{_L}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")


class WordIds(dict):
    """Token ids, as little-endian bytes, of the stretches that the vocabulary's pre-tokenizer cuts text into."""

    def __init__(self, path: str):
        import regex
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        super().__init__()
        self.model = Tokenizer.from_file(path)
        self.words = regex.compile(PATTERN).findall
        self.special = [t.content for t in self.model.get_added_tokens_decoder().values()]

    def __missing__(self, word: str) -> bytes:
        found = array("I", self.model.encode(word, add_special_tokens=False).ids).tobytes()
        self[word] = found
        return found

    def encode(self, text: str) -> bytes:
        """All ids of ``text``; merges never cross the pre-tokenizer's cuts, so words are encoded one by one."""
        if any(mark in text for mark in self.special):
            return np.array(self.model.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if len(self) > KNOWN_WORDS:
            self.clear()
        words = PLAIN_WORDS.findall if PLAIN.fullmatch(text) else self.words
        return b"".join(map(self.__getitem__, words(text)))


_MODELS: dict[str, WordIds] = {}
KEPT["packing"] = _MODELS.clear


def word_ids(path: str) -> WordIds:
    """One table for each vocabulary and Python worker."""
    if path not in _MODELS:
        _MODELS[path] = WordIds(path)
    return _MODELS[path]


def token_pieces(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    path: str | None = None,
    keep_ids: bool = False,
) -> DataFrame:
    """One row per piece of each document: ``key``, piece, start, length, ids_crc32, task, place (and ids).

    Null and empty texts are the end id alone. ``task`` and ``place`` number the pieces of one length within a task.
    Repeated rows give their pieces again. Null keys stay null.
    """
    path = path or vocabulary_path()
    end = np.array([end_id], "<u4").tobytes()
    schema = PIECES.replace("doc_id", f"`{key}`", 1) + (", ids array<int>" if keep_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, task, seen = word_ids(path), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in steps(batches, text, keep="packing"):
            keys, piece, start, length, crc, place, ids = [], [], [], [], [], [], []
            for k, value in zip(batch.column(key).to_pylist(), batch.column(text).to_pylist()):
                all_ids = model.encode(value or "") + end
                n = len(all_ids) // 4
                at, size = 0, (n % capacity or capacity) if n > capacity else n
                while at < n:
                    own = all_ids[4 * at : 4 * (at + size)]
                    keys.append(k)
                    piece.append(0 if not at else piece[-1] + 1)
                    start.append(at)
                    length.append(size)
                    crc.append(zlib.crc32(own))
                    place.append(int(seen[size]))
                    seen[size] += 1
                    if keep_ids:
                        ids.append(np.frombuffer(own, "<i4"))
                    at, size = at + size, capacity
            columns = [pa.array(keys, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array([task] * len(keys), pa.int32()), pa.array(place, pa.int64())]
            names = [key, "piece", "start", "length", "ids_crc32", "task", "place"]
            if keep_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(F.col(key).cast("long").alias(key), text).mapInArrow(cut, schema)


def packing_plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Where the pieces of each length go: (length, first rank, rank after the last, first sequence, pieces in a
    sequence, first offset), and how many sequences there are.

    ``counts`` has how many pieces there are of each length. The work and the result depend on the number of
    lengths, never on the number of pieces.
    """
    left = {s: n for s, n in counts.items() if n > 0}
    used = dict.fromkeys(left, 0)
    plan, sequences = [], 0
    gaps: dict[int, list[tuple[int, int]]] = {}

    def put(size: int, n: int, sequence: int, each: int, offset: int) -> None:
        plan.append((size, used[size], used[size] + n, sequence, each, offset))
        used[size] += n
        left[size] -= n

    def open_gap(gap: int, first: int, n: int) -> None:
        if gap and n:
            gaps.setdefault(gap, []).append((first, n))

    third = capacity // 3
    large = sorted((s for s in left if s > third), reverse=True)
    for s in large:
        while left[s]:
            mate = next((t for t in large if t <= capacity - s and t <= s and left[t] >= (2 if t == s else 1)), None)
            n = left[s] if mate is None else left[s] // 2 if mate == s else min(left[s], left[mate])
            put(s, n, sequences, 1, 0)
            if mate is not None:
                put(mate, n, sequences, 1, s)
            open_gap(capacity - s - (mate or 0), sequences, n)
            sequences += n
    for s in sorted((s for s in left if s <= third), reverse=True):
        while left[s]:
            gap = min((g for g in gaps if g >= s), default=None)
            if gap is None:
                each = capacity // s
                full, rest = divmod(left[s], each)
                for n, k in ((full, each), (min(rest, 1), rest)):
                    if n:
                        put(s, n * k, sequences, k, 0)
                        open_gap(capacity - k * s, sequences, n)
                        sequences += n
                continue
            first, n = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap]
            each = gap // s
            full = min(n, left[s] // each)
            rest = left[s] - full * each if full < n else 0
            if full:
                put(s, full * each, first, each, capacity - gap)
                open_gap(gap - each * s, first, full)
            if rest:
                put(s, rest, first + full, rest, capacity - gap)
                open_gap(gap - rest * s, first + full, 1)
            open_gap(gap, first + full + bool(rest), n - full - bool(rest))
    return plan, sequences


def pack(docs: DataFrame, text: str = "text", key: str = "doc_id", capacity: int = CAPACITY, end_id: int = END_ID, path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """Every piece of every document with its sequence and its offset there.

    Columns: ``key``, piece, start, length, ids_crc32, sequence_id, offset, and ids with ``keep_ids``. An empty
    table gives no rows; ties in length are broken by where the rows were read, which moves no count.
    """
    spark = docs.sparkSession
    pieces = staged(token_pieces(docs, text, key, capacity, end_id, path, keep_ids), "pieces")
    by_task = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    # at most one row for each length up to the capacity
    counts = {int(r["length"]): int(r["n"]) for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan, _ = packing_plan(counts, capacity)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["length", "task"]).withColumn("rank", F.col("base") + F.col("place"))
    places = spark.createDataFrame(plan, "length bigint, rank_from bigint, rank_to bigint, first bigint, each bigint, shift bigint")
    hit = ranked.join(
        F.broadcast(places.withColumnRenamed("length", "size")),  # bounded by the capacity
        (F.col("length") == F.col("size")) & (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to")),
    )
    k = F.col("rank") - F.col("rank_from")
    return hit.select(
        key, "piece", "start", "length", "ids_crc32",
        (F.col("first") + F.floor(k / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("shift") + (k % F.col("each")) * F.col("length")).cast("long").alias("offset"),
        *(["ids"] if keep_ids else []),
    )
