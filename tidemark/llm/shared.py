"""Staged tables and Arrow helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that one numpy step works on; a longer document is a step of its own.
STEP_BYTES = 1 << 19


#: Folders made where no shared one is named, by application.
_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors share. Only a local session, whose executors are the
    driver itself, may do without it; then a temporary folder is used."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        name = spark.sparkContext.applicationId
        found = _LOCAL.setdefault(name, "") or f"file://{tempfile.mkdtemp(prefix='tidemark-')}"
        _LOCAL[name] = found
    return found.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder path below the shared one."""
    return f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: later reads never recompute its lineage."""
    path = new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: A key is hot if more than one row in so many has it; so at most so many keys are hot.
HOT_SHARE = 1000


def join_hot(left: DataFrame, right: DataFrame, key: str, rows: str, total: int) -> DataFrame:
    """``left`` with the columns of ``right``, which has one row for each key and counts in ``rows`` those of left.

    A left join that leaves hot keys where they are: of the keys that more than one row of ``total`` in HOT_SHARE has
    there are at most HOT_SHARE, which are broadcast; the others are joined by key. Rows without a key, or whose key
    right lacks, keep nulls. Both tables should be staged, as they are read more than once.
    """
    hot = F.broadcast(right.where(F.col(rows) * HOT_SHARE > total).withColumn("_hot", F.lit(True)))
    cold = right.where(F.col(rows) * HOT_SHARE <= total)
    marked = left.join(hot, key, "left")
    far = left.where(F.col(key).isNotNull()).join(hot.select(key), key, "left_anti")
    near = marked.where(F.col(key).isNull() | F.col("_hot")).drop("_hot")
    return near.unionByName(far.join(cold, key, "left"))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column end to end, and each row's bounds in them; null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(column.buffers()[1], width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    bytes_ = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    return bytes_, bounds - bounds[0]


#: What a Python worker keeps between tasks, by operator, and how to drop it.
KEPT: dict[str, Callable[[], None]] = {}


@cache
def _trim() -> Callable[[], object]:
    """Gives memory that is free in this process back to the system, where the C library can."""
    try:
        trim = ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):
        return pa.default_memory_pool().release_unused

    def both() -> None:
        pa.default_memory_pool().release_unused()
        trim(0)

    return both


def give_back() -> None:
    """Free memory of this process, the driver's too, goes back to the system."""
    _trim()()


def steps(batches: Iterator[pa.RecordBatch], text: str, limit: int = STEP_BYTES, keep: str = "") -> Iterator[pa.RecordBatch]:
    """Slices of the batches, each of at most ``limit`` text bytes unless one row alone has more.

    Workers serve one operator after another; what others than ``keep`` left in this one is dropped first.
    """
    for owner, drop in KEPT.items():
        if owner != keep:
            drop()
    _trim()()
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        total = np.cumsum(size)
        start = 0
        while start < batch.num_rows:
            base = total[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(total, base + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop
    _trim()()


def runs(data: np.ndarray, bounds: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes in ``member`` (a table of 256 flags); no run crosses rows."""
    inside = member[data]
    cut = np.unique(bounds[1:-1])
    cut = cut[(cut > 0) & (cut < len(data))]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    first[cut] = inside[cut]
    last[cut - 1] = inside[cut - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def row_of(starts: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The row that holds each start; starts ascend."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(np.searchsorted(starts, bounds)))


#: Bits of a sieve for each number in it, and at least and at most; a full one lets more through, never less.
SIEVE_EACH, SIEVE_LEAST, SIEVE_MOST = 16, 1 << 16, 1 << 28
_CHUNK = 1 << 13


def sieve(ids: DataFrame) -> np.ndarray:
    """A Bloom filter over a column of whole numbers, as large as their count demands: bits set on the executors, put
    together by chunk."""
    size = min(SIEVE_MOST, max(SIEVE_LEAST, 1 << int(ids.count() * SIEVE_EACH).bit_length()))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(size // 8, np.uint8)
        for batch in batches:
            for at in _sieve_places(batch.column(0).to_numpy(), size):
                np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
        for c in range(0, len(bits), _CHUNK):
            if bits[c : c + _CHUNK].any():
                yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([bits[c : c + _CHUNK].tobytes()])], names=["chunk", "bits"])

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for c, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found[c] = found.get(c, np.uint8(0)) | np.frombuffer(data, np.uint8)
        for c, own in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([own.tobytes()])], names=["chunk", "bits"])

    out = np.zeros(size // 8, np.uint8)
    chunks = ids.mapInArrow(scan, "chunk int, bits binary").repartition("chunk").mapInArrow(unite, "chunk int, bits binary")
    for r in chunks.toLocalIterator():  # the filter's size in all
        own = np.frombuffer(r["bits"], np.uint8)
        out[r["chunk"] : r["chunk"] + len(own)] = own
    return out


def _sieve_places(ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    h = mix(ids.astype(np.int64).view(np.uint64) + np.uint64(0x51ED270B))
    return (h % np.uint64(size)).astype(np.int64), ((h >> np.uint64(32)) % np.uint64(size)).astype(np.int64)


def sifted(ids: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Whether a sieve may hold each number; it never misses one that it holds."""
    a, b = _sieve_places(ids, len(bits) * 8)
    return (bits[a >> 3] >> (a & 7) & 1 & bits[b >> 3] >> (b & 7)).astype(bool)


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_UNIT = pow(_BASE, -1, 1 << 64)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = max(n, STEP_BYTES + 4096)
        for k, base in enumerate((_BASE, _UNIT)):
            factor = np.full(size, base, np.uint64)
            factor[0] = 1
            _POWERS[k] = np.multiply.accumulate(factor)
    return _POWERS[0][:n], _POWERS[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; the finaliser is a bijection, so different values stay different."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, equal for equal bytes wherever they stand."""
    powers, units = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers[: len(data)], out=sums[1:])
    raw = (sums[ends] - sums[starts]) * units[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def sums_by_row(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Whole-number sums of ``values`` for each of ``n`` rows."""
    return np.bincount(rows, weights=values, minlength=n).astype(np.int64)
