"""Removal of repeated byte strings by a distributed merge sort of suffixes.

Every 400-byte string has an anchor among its first 192 places: the leftmost least hash of 16 bytes. Equal strings
have it in the same place, so only suffixes at anchors are compared, and of those only the ones whose first 209
bytes stand elsewhere too. Tasks sort their suffixes into front-coded runs (each suffix stores the length it
shares with the one before, and the rest) and exchange them by ranges. A range is merged by a loser tree that
carries common-prefix lengths, so no compared byte is compared again. What comes out tells which suffixes share
how much, and together with the bytes before each anchor, which 400-byte strings repeat.

Equal texts are one text from the start; equal suffixes of a task travel once.
"""

from __future__ import annotations

import bisect
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import _BYTE, STEP_BYTES, _powers, join_hot, mix, sieve, sifted, span_hashes, staged, steps, utf8

MATCH_BYTES = 400
#: Places of a string that may hold its anchor, and bytes that an anchor's hash takes.
PLACES, GRAM = 192, 16
#: Suffixes of a run, and of a range, about; ranges at most; sampled suffixes for each range.
RUN_SUFFIXES, RANGE_SUFFIXES, MOST_RANGES, SAMPLED = 40_000, 20_000, 16_384, 16
_PLACE_BITS = np.uint64(28)
_HEAD = struct.Struct("<HHHII")


def anchors(data: np.ndarray, bounds: np.ndarray, match: int = MATCH_BYTES, places: int = PLACES) -> np.ndarray:
    """Places of the anchors of all strings of ``match`` bytes within rows."""
    n = len(data)
    size = np.diff(bounds)
    if n < match or not (size >= match).any():
        return np.zeros(0, np.int64)
    powers, inverse = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers[:n], out=sums[1:])
    grams = mix((sums[GRAM:] - sums[: n - GRAM + 1]) * inverse[: n - GRAM + 1])
    value = ((grams >> _PLACE_BITS) << _PLACE_BITS) | np.arange(len(grams), dtype=np.uint64)
    blocks = -(-len(value) // places) + 1
    padded = np.full(blocks * places, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(value)] = value
    table = padded.reshape(blocks, places)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    back = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = n - match + 1
    least = np.minimum(back[:starts], ahead[places - 1 : places - 1 + starts])
    at = (least & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)
    left = np.repeat(bounds[1:], size)[:starts] - np.arange(starts)
    at = at[left >= match]
    return at[np.concatenate(([True], at[1:] != at[:-1]))] if len(at) else at


def _anchored(data: np.ndarray, bounds: np.ndarray, match: int, places: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors in rows end to end, and hashes of the bytes from each on; long rows are taken by windows."""
    if len(data) <= 4 * STEP_BYTES:
        at = anchors(data, bounds, match, places)
        return at, span_hashes(data, at, at + match - places + 1).view(np.int64)
    found, hashes = [], []
    for low in range(0, len(data), STEP_BYTES):
        high = min(len(data), low + STEP_BYTES + match - 1)  # every string is whole in the window it starts in
        inner = bounds[(bounds > low) & (bounds < high)] - low
        own = data[low:high]
        at = anchors(own, np.concatenate(([0], inner, [high - low])), match, places)
        found.append(at + low)
        hashes.append(span_hashes(own, at, at + match - places + 1).view(np.int64))
    at, first = np.unique(np.concatenate(found), return_index=True)
    return at, np.concatenate(hashes)[first]


def _scan(docs: DataFrame, key: str, text: str, match: int, places: int) -> DataFrame:
    """row key, digest, bytes and sha256 of every text, with the hashes at its anchors and their places."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, text):
            data, bounds = utf8(batch.column(text))
            at, hashes = _anchored(data, bounds, match, places)
            row = np.searchsorted(bounds, at, "right") - 1
            offsets = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=batch.num_rows)))).astype(np.int32)
            view = memoryview(np.ascontiguousarray(data))
            sha = [hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            yield pa.RecordBatch.from_arrays([
                batch.column(key), pa.array(np.diff(bounds), pa.int64()), pa.array(sha, pa.string()),
                pa.ListArray.from_arrays(offsets, pa.array(hashes)), pa.ListArray.from_arrays(offsets, pa.array((at - bounds[row]).astype(np.int32))),
            ], names=["key", "n_bytes", "sha", "hashes", "places"])

    return docs.select(F.col(key).cast("long").alias(key), text).mapInArrow(scan, "key bigint, n_bytes bigint, sha string, hashes array<bigint>, places array<int>")


def shared_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes need no look."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    low, high = known, n  # a[:low] equal, a[:high] not
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def encode_run(records: list[tuple[bytes, bytes, int, int]]) -> bytes:
    """Sorted records (suffix, bytes before, owners, number) front-coded."""
    parts, last = [], b""
    for suffix, before, owners, number in records:
        same = shared_prefix(last, suffix)
        parts += [_HEAD.pack(same, len(suffix) - same, len(before), owners, number), suffix[same:], before]
        last = suffix
    return b"".join(parts)


def decode_run(data: bytes) -> Iterator[tuple[int, bytes, bytes, int, int]]:
    """The records of a run, each with the length it shares with the one before."""
    at, last = 0, b""
    while at < len(data):
        same, size, before, owners, number = _HEAD.unpack_from(data, at)
        at += _HEAD.size
        last = last[:same] + data[at : at + size]
        at += size
        yield same, last, data[at : at + before], owners, number
        at += before


class LoserTree:
    """Merges sorted runs. Each loser keeps the length it shares with the winner that beat it; of two runs that
    know their length with the same earlier winner, the longer one is smaller, and equal ones compare from there."""

    def __init__(self, runs: list[Iterator[tuple]]):
        self.runs = runs
        self.size = 1 << max(0, (len(runs) - 1).bit_length())
        self.now: list[tuple | None] = [next(r, None) for r in runs] + [None] * (self.size - len(runs))
        self.lcp = [0] * self.size
        self.tree = [0] * self.size
        self.top = self._play(1) if self.size > 1 else 0

    def _play(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        winner, loser = self._match(self._play(2 * node), self._play(2 * node + 1))
        self.tree[node] = loser
        return winner

    def _match(self, a: int, b: int) -> tuple[int, int]:
        x, y = self.now[a], self.now[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        if self.lcp[a] != self.lcp[b]:
            return (a, b) if self.lcp[a] > self.lcp[b] else (b, a)
        same = shared_prefix(x[1], y[1], self.lcp[a])
        first, second = (a, b) if x[1][same:] <= y[1][same:] else (b, a)
        self.lcp[second] = same
        return first, second

    def __iter__(self) -> Iterator[tuple[int, int, tuple]]:
        """Length shared with the record before, run, record."""
        while (record := self.now[self.top]) is not None:
            run = self.top
            yield self.lcp[run], run, record
            following = next(self.runs[run], None)
            self.now[run] = following
            self.lcp[run] = following[0] if following else 0
            winner, node = run, (run + self.size) // 2
            while node:
                winner, self.tree[node] = self._match(winner, self.tree[node])
                node //= 2
            self.top = winner


def repeats(group: list[tuple[bytes, bytes, int]], shared: list[int], match: int = MATCH_BYTES, places: int = PLACES) -> list[list[tuple[int, int]]]:
    """For suffixes of one group in order (suffix, bytes before, owners) with the lengths neighbours share: the
    distances before the anchor (from, to) at which the string of ``match`` bytes stands elsewhere too."""
    n = len(group)
    right = np.array([len(s) for s, _, _ in group])
    before = np.array([len(b) for _, b, _ in group])
    owners = np.array([k for _, _, k in group])
    low, high = np.maximum(match - right, 0), np.minimum(before, places - 1)
    if n == 1:
        return [[(int(low[0]), int(high[0]))] if owners[0] > 1 and low[0] <= high[0] else []]
    backwards = [b[::-1] for _, b, _ in group]
    order = sorted(range(n), key=backwards.__getitem__)
    left_shared = np.array([shared_prefix(backwards[a], backwards[b]) for a, b in zip(order, order[1:])])
    if n == 2 and (owners == 1).all():
        a, b = max(match - shared[0], 0), min(int(left_shared[0]), places - 1)
        return [[(a, b)], [(a, b)]] if a <= b else [[], []]
    shared_, order_ = np.array(shared), np.array(order)
    marks = np.unique(np.concatenate(([0], low, high + 1, match - shared_, left_shared + 1)))
    marks = marks[(marks >= 0) & (marks < places)]
    stops = np.append(marks[1:], places) - 1
    flags = np.zeros((len(marks), n), bool)
    first = np.zeros(n, np.int64)
    second = np.zeros(n, np.int64)
    for k, a in enumerate(marks.tolist()):
        valid = (low <= a) & (a <= high)
        if not valid.any():
            continue
        first[1:] = np.cumsum(shared_ < match - a)
        second[order_[1:]] = np.cumsum(left_shared < a)
        _, own = np.unique((first * n + second)[valid], return_inverse=True)
        flags[k, valid] = np.bincount(own, owners[valid])[own] > 1
    out = []
    for column in flags.T:
        spans: list[tuple[int, int]] = []
        for k in np.flatnonzero(column).tolist():
            if spans and spans[-1][1] + 1 == marks[k]:
                spans[-1] = (spans[-1][0], int(stops[k]))
            else:
                spans.append((int(marks[k]), int(stops[k])))
        out.append(spans)
    return out


def _contexts(batch: pa.RecordBatch, match: int, places: int) -> Iterator[tuple[int, int, bytes, bytes]]:
    for row, (text, found) in enumerate(zip(batch.column("text").to_pylist(), batch.column("places").to_pylist())):
        data = text.encode()
        for at in found:
            yield row, at, data[at : at + match], data[max(0, at - places + 1) : at]


def _splitters(held: DataFrame, total: int, match: int, places: int) -> list[bytes]:
    """Prefixes that cut all suffixes into ranges of about RANGE_SUFFIXES, from a sample of bounded size."""
    ranges = min(MOST_RANGES, total // RANGE_SUFFIXES + 1)
    if ranges == 1:
        return []
    rate = max(1, total // (ranges * SAMPLED))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            own = [s[: match - places + 1] for _, at, s, _ in _contexts(batch, match, places) if (hash(s[:64]) if rate == 1 else int.from_bytes(hashlib.blake2b(s, digest_size=6).digest())) % rate == 0]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.binary())], names=["prefix"])

    found = sorted({bytes(r["prefix"]) for r in held.mapInArrow(pick, "prefix binary").limit(2 * ranges * SAMPLED).collect()})
    return [found[len(found) * k // ranges] for k in range(1, ranges)] if len(found) >= ranges else found


def _runs(held: DataFrame, splitters: list[bytes], match: int, places: int) -> DataFrame:
    """Front-coded runs by range, and the owners of each run's suffixes."""
    broadcast = held.sparkSession.sparkContext.broadcast(splitters)
    names = ["bucket", "run", "data", "number", "key", "sha", "place"]
    types = [pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.string(), pa.int32()]

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts, number = broadcast.value, 0

        def flush(held_: dict) -> Iterator[pa.RecordBatch]:
            nonlocal number
            run = TaskContext.get().partitionId() * (1 << 24) + number
            number += 1
            ordered = sorted(held_)
            buckets: dict[int, list] = {}
            for k, (suffix, before) in enumerate(ordered):
                buckets.setdefault(bisect.bisect_right(cuts, suffix[: match - places + 1]), []).append((suffix, before, len(held_[suffix, before]), k))
            blocks = {b: encode_run(records) for b, records in buckets.items()}
            owners = [(k, *o) for k, x in enumerate(ordered) for o in held_[x]]
            m, n = len(blocks), len(owners)
            yield pa.RecordBatch.from_arrays([pa.array([*blocks], types[0]), pa.array([run] * m, types[1]), pa.array([*blocks.values()], types[2]), *(pa.nulls(m, t) for t in types[3:])], names=names)
            yield pa.RecordBatch.from_arrays([pa.nulls(n, types[0]), pa.array([run] * n, types[1]), pa.nulls(n, types[2]), *(pa.array(c, t) for c, t in zip(zip(*owners), types[3:]))], names=names)

        held_: dict[tuple[bytes, bytes], list] = {}
        n = 0
        for batch in steps(batches, "text"):
            keys, shas = batch.column("key").to_pylist(), batch.column("sha").to_pylist()
            for row, at, suffix, before in _contexts(batch, match, places):
                held_.setdefault((suffix, before), []).append((keys[row], shas[row], at))
                n += 1
                if n >= RUN_SUFFIXES:
                    yield from flush(held_)
                    held_, n = {}, 0
        if held_:
            yield from flush(held_)

    return held.mapInArrow(sort, "bucket int, run bigint, data binary, number int, key bigint, sha string, place int")


def _merge(match: int, places: int):
    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        runs = rows["run"].tolist()
        tree = LoserTree([decode_run(bytes(d)) for d in rows["data"]])
        out: list[tuple[int, int, int, int]] = []
        group: list[tuple[int, tuple]] = []
        shared: list[int] = []

        def settle() -> None:
            if len(group) > 1 or group and group[0][1][3] > 1:
                found = repeats([(r[1], r[2], r[3]) for _, r in group], shared, match, places)
                for (run, r), spans in zip(group, found):
                    out.extend((runs[run], r[4], a, b) for a, b in spans)

        for same, run, record in tree:
            if group and same < match - places + 1:
                settle()
                group, shared = [], []
            elif group:
                shared.append(same)
            group.append((run, record))
        settle()
        return pd.DataFrame(out, columns=["run", "number", "low", "high"])

    return merge


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _sifted_texts(texts: DataFrame, found: DataFrame) -> DataFrame:
    """At least the rows of ``texts`` (id, text) whose id ``found`` has as key; most others stay where they are."""
    bits = texts.sparkSession.sparkContext.broadcast(sieve(found.where("key is not null").select("key")))

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            kept = sifted(ids.fill_null(0).to_numpy(), bits.value) | ids.is_null().to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(kept))

    return texts.mapInArrow(sift, texts.schema)


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", match: int = MATCH_BYTES, places: int = PLACES) -> tuple[DataFrame, DataFrame]:
    """Two tables: every row's key, n_bytes, sha and whether other rows have its text (copies); and for each
    different text with something repeated, key and sha of its lead, spans (UTF-8 byte offsets), kept text and kept_sha256.

    A byte is repeated if a string of ``match`` bytes over it also starts elsewhere, in this text or another; matches
    never cross texts. Null texts are empty. Texts shorter than ``match`` have nothing repeated.
    """
    spark = docs.sparkSession
    scanned = staged(_scan(docs, key, text, match, places), "scanned")
    groups = staged(scanned.groupBy("sha").agg(F.min("key").alias("key"), F.count("*").alias("copies")), "texts")
    rows = join_hot(scanned.select("key", "n_bytes", "sha"), groups.select("sha", "copies"), "sha", "copies", scanned.count())
    # a lead is a row of its own key: copies of one text lie apart
    lead = scanned.where(F.size("hashes") > 0).alias("s").join(groups.alias("g"), F.col("s.sha").eqNullSafe(F.col("g.sha")) & F.col("s.key").eqNullSafe(F.col("g.key")))
    lead = staged(lead.select("s.key", "s.sha", "s.hashes", "s.places"), "leads")
    pairs = lead.select("key", "sha", F.explode(F.arrays_zip("hashes", "places")).alias("x")).select("key", "sha", F.col("x.hashes").alias("hash"), F.col("x.places").alias("place"))
    twice = staged(pairs.groupBy("hash").agg(F.count("*").alias("c")).where("c > 1"), "twice")
    anchored = lead.agg(F.sum(F.size("hashes"))).first()[0] or 0
    found = join_hot(pairs, twice, "hash", "c", anchored).where("c is not null")
    found = staged(found.groupBy("key", "sha").agg(F.sort_array(F.collect_set("place")).alias("places")), "found")
    texts = _sifted_texts(docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).where(F.octet_length("text") >= match), found)
    held = texts.join(found, texts["id"].eqNullSafe(found["key"])).where(F.sha2("text", 256) == F.col("sha")).select("key", "sha", "text", "places")
    held = staged(held, "held")
    total = held.agg(F.sum(F.size("places"))).first()[0] or 0
    sorted_ = staged(_runs(held, _splitters(held, total, match, places), match, places), "runs")
    hits = sorted_.where("bucket is not null").select("bucket", "run", "data").groupBy("bucket").applyInPandas(_merge(match, places), "run bigint, number int, low int, high int")
    owners = sorted_.where("bucket is null").select("run", "number", "key", "sha", "place")
    spans = owners.join(hits, ["run", "number"]).select("key", "sha", (F.col("place") - F.col("high")).alias("start"), (F.col("place") - F.col("low") + match).alias("stop"))
    spans = spans.groupBy("key", "sha").agg(F.collect_set(F.struct("start", "stop")).alias("found"))
    spans = spans.select(F.col("key").alias("k"), F.col("sha").alias("s"), "found")
    ready = held.join(spans, F.col("key").eqNullSafe(F.col("k")) & (F.col("sha") == F.col("s"))).select("key", "sha", "text", "found")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, kept, sha = [], [], []
            for value, raw in zip(batch.column("text").to_pylist(), batch.column("found").to_pylist()):
                data, spans_, at, parts = value.encode(), _merged([(s["start"], s["stop"]) for s in raw]), 0, []
                for a, b in spans_:
                    parts.append(data[at:a])
                    at = b
                rest = b"".join([*parts, data[at:]])
                out.append([{"start": a, "stop": b} for a, b in spans_])
                kept.append(rest.decode("utf-8", "ignore"))
                sha.append(hashlib.sha256(rest).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("sha"), pa.array(out, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), pa.array(kept, pa.string()), pa.array(sha, pa.string())], names=["key", "sha", "spans", "kept_text", "kept_sha256"])

    result = ready.mapInArrow(cut, "key bigint, sha string, spans array<struct<start: bigint, stop: bigint>>, kept_text string, kept_sha256 string")
    return rows, result


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", match: int = MATCH_BYTES, places: int = PLACES) -> DataFrame:
    """key, n_bytes, n_removed, n_spans and kept_sha256 for every row; rows whose text others have lose all of it."""
    rows, result = repeated_spans(docs, key, text, match, places)
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["stop"] - x["start"])
    found = result.groupBy("sha").agg(F.first(gone).alias("gone"), F.first(F.size("spans")).alias("runs"), F.first("kept_sha256").alias("left"))
    # copies are gone whole; what is cut out of other texts goes to their single rows
    alone = rows.where("copies = 1").join(found, "sha", "left")
    joined = alone.unionByName(rows.where("copies > 1"), allowMissingColumns=True)
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= match)
    return joined.select(
        F.col("key").alias(key), "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("gone", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("runs", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("left", "sha")).alias("kept_sha256"),
    )
