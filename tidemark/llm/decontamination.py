"""Benchmark decontamination with an FM-index per shard of training text.

The words of a shard that no test phrase uses cannot be part of a match, so they become separators; what remains
is indexed. Every test phrase is searched backwards in that index, its occurrences are located through sampled
suffix positions, and overlapping ones merge into the spans to remove. Words are compared by 64-bit hashes (a false
match needs a chance collision in every word of a phrase).

Test items come in blocks of bounded bytes. Mostly there is one, and one pass over the documents does it all. With
several, each has a pass of its own that gives rows for the documents with matches only; these are put together by
document. No task ever holds more than one block, or starts more than one Python worker.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .fmindex import FMIndex
from .shared import LOWER, row_of, runs, span_hashes, staged, steps, sums_by_row, utf8

WINDOW = 10
#: Test items are searched in blocks of at most so many bytes (an item alone may have more).
BLOCK_BYTES = 8 << 20
#: Text bytes of a shard, which has one index (a longer document is a shard of its own).
SHARD_BYTES = 8 << 20

_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = _WORD[0x80:] = True


def words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, row, first byte and end of every word of a text column; A-Z count as a-z."""
    data, bounds = utf8(column)
    data = LOWER[data]
    starts, ends = runs(data, bounds, _WORD)
    return span_hashes(data, starts, ends), row_of(starts, bounds), starts - bounds[:-1][row_of(starts, bounds)], ends - bounds[:-1][row_of(starts, bounds)]


@dataclass
class Phrases:
    """The windows of a block of test items: symbols by length, and the items that have each."""

    vocabulary: np.ndarray
    by_length: list[tuple[int, np.ndarray, np.ndarray]]  # length, windows (rows of symbols), number of each window
    item_at: np.ndarray  # bounds in items, by number of window
    items: np.ndarray  # places in ids
    ids: list

    @classmethod
    def of(cls, ids: list, texts: list[str | None], window: int = WINDOW) -> Phrases:
        hashes, rows, _, _ = words(pa.array(texts, pa.string()))
        vocabulary, symbols = np.unique(hashes, return_inverse=True)
        symbols = symbols.astype(np.int64) + 2  # 0 ends an index, 1 separates
        names = {x: k for k, x in enumerate(dict.fromkeys(ids))}
        bounds = np.searchsorted(rows, np.arange(len(ids) + 1))
        held: dict[int, dict[bytes, set[int]]] = {}
        for k, item in enumerate(ids):
            own = symbols[bounds[k] : bounds[k + 1]]
            size = min(window, len(own))
            for at in range(len(own) - size + 1) if size else ():
                held.setdefault(size, {}).setdefault(own[at : at + size].tobytes(), set()).add(names[item])
        by_length, counts, places, number = [], [0], [], 0
        for size, found in sorted(held.items()):
            table = np.frombuffer(b"".join(found), np.int64).reshape(-1, size)
            by_length.append((size, table, np.arange(number, number + len(found))))
            number += len(found)
            for x in found.values():
                places += sorted(x)
                counts.append(len(places))
        return cls(vocabulary, by_length, np.array(counts), np.array(places, np.int64), list(names))


def occurrences(hashes: np.ndarray, rows: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of words and window number of every occurrence in a shard's words."""
    none = (np.zeros(0, np.int64),) * 3
    if not len(hashes) or not phrases.by_length:
        return none
    place = np.minimum(np.searchsorted(phrases.vocabulary, hashes), len(phrases.vocabulary) - 1)
    known = phrases.vocabulary[place] == hashes
    fresh = np.concatenate(([True], (rows[1:] != rows[:-1]) | ~known[:-1] | ~known[1:]))
    stretch = np.cumsum(fresh)
    long_enough = np.bincount(stretch)[stretch] >= phrases.by_length[0][0]
    kept = np.flatnonzero(known & long_enough)
    if not len(kept):
        return none
    breaks = np.flatnonzero(np.diff(stretch[kept])) + 1
    text = np.insert(place[kept] + 2, breaks, 1)
    at_word = np.insert(kept, breaks, -1)
    index = FMIndex(text, len(phrases.vocabulary) + 2)
    firsts, sizes, numbers = [], [], []
    for size, table, number in phrases.by_length:
        low, high = index.ranges(table)
        n = high - low
        own = np.repeat(number, n)
        rows_found = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
        firsts.append(at_word[index.locate(rows_found)])
        sizes.append(np.full(len(own), size))
        numbers.append(own)
    return np.concatenate(firsts), np.concatenate(sizes), np.concatenate(numbers)


def _blocks(benchmark: DataFrame, key: str, text: str, most: int) -> list[DataFrame]:
    """The distinct rows of the benchmark in blocks of at most ``most`` bytes; a row alone may have more."""
    rows = benchmark.select(F.col(key).alias("id"), F.col(text).alias("text")).distinct()
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 16
    total = rows.agg(F.sum(size)).first()[0] or 0
    n = 16 * math.ceil(total / most) if total > most else 1
    cell = F.pmod(F.xxhash64("id", "text"), F.lit(n))
    sizes = sorted((r["cell"], r["size"]) for r in rows.groupBy(cell.alias("cell")).agg(F.sum(size).alias("size")).collect())
    cuts, held = [0], 0
    for c, own in sizes:
        if held and held + own > most:
            cuts.append(c)
            held = 0
        held += own
    return [rows.where((cell >= low) & (cell < high)) for low, high in zip(cuts, [*cuts[1:], n])]


def _shards(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple]:
    """Rows of about SHARD_BYTES with the hash, row, first byte and end of each of their words."""
    for batch in steps(batches, text, SHARD_BYTES):
        parts, at = [], 0
        for own in steps(iter([batch]), text):
            hashes, rows, begin, end = words(own.column(text))
            parts.append((hashes, rows + at, begin, end))
            at += own.num_rows
        yield batch, *(np.concatenate([p[k] for p in parts]) for k in range(4))


def _matches(hashes: np.ndarray, rows: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each word of a shard whether it is hit, and the rows and items (places in ids, each pair once) that match."""
    first, size, number = occurrences(hashes, rows, phrases)
    edge = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edge, first, 1)
    np.add.at(edge, first + size, -1)
    per = phrases.item_at[number + 1] - phrases.item_at[number]
    where = np.repeat(phrases.item_at[number], per) + np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
    many = max(1, len(phrases.ids))
    pair = np.unique(np.repeat(rows[first], per) * many + phrases.items[where])
    return np.cumsum(edge[:-1]) > 0, pair // many, pair % many


def _hit_runs(hit: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last word of each maximal run of hit words of a row."""
    new = np.concatenate(([True], rows[1:] != rows[:-1]))[: len(hit)]
    opens = hit & (new | ~np.concatenate(([False], hit[:-1]))[: len(hit)])
    closes = hit & (np.concatenate((new[1:], [True])) | ~np.concatenate((hit[1:], [False])))[: len(hit)]
    return np.flatnonzero(opens), np.flatnonzero(closes)


def _lists(row: np.ndarray, n: int, **values: np.ndarray) -> pa.Array:
    """For each of ``n`` rows the structs that ascending ``row`` gives it."""
    offsets = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=n)))).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(v, pa.int64()) for v in values.values()], names=[*values]))


def _items(row: np.ndarray, place: np.ndarray, ids: list, n: int, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=n)))).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array([ids[p] for p in place.tolist()], kind))


def _told(batch: pa.RecordBatch, plain: list[str], hit: np.ndarray, rows: np.ndarray, begin: np.ndarray, end: np.ndarray, items: pa.Array) -> pa.RecordBatch:
    """The rows with their result columns."""
    n = batch.num_rows
    counts = np.bincount(rows, minlength=n)
    base = np.cumsum(counts) - counts
    a, b = _hit_runs(hit, rows)
    new = [
        pa.array(counts, pa.int64()), pa.array(sums_by_row(hit, rows, n), pa.int64()), items,
        _lists(rows[a], n, start=a - base[rows[a]], stop=b + 1 - base[rows[a]]), _lists(rows[a], n, start=begin[a], stop=end[b]),
    ]
    return pa.RecordBatch.from_arrays([batch.column(c) for c in plain] + new, names=plain + ["n_words", "n_hit", "items", "word_runs", "spans"])


def find_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with n_words, n_hit, items, word_runs and spans.

    A test item's windows are its runs of ``window`` consecutive words, or all its words where it has fewer. n_hit
    counts the document's words inside any occurrence of a window, items lists the ids whose windows occur (rows of
    one id are one item), word_runs and spans hold the maximal runs of hit words, as word numbers and as UTF-8 byte
    offsets. Null and empty texts have no words; an empty benchmark hits nothing. Repeated rows count as they stand.
    Result columns replace columns of ``docs`` with these names.
    """
    rest = docs.drop("n_words", "n_hit", "items", "word_runs", "spans")
    plain, spark = rest.columns, docs.sparkSession
    id_type = benchmark.schema[item_key].dataType
    kind = to_arrow_type(id_type)
    runs_ = "array<struct<start: bigint, stop: bigint>>"
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rest.schema)
    schema += f"n_words bigint, n_hit bigint, items array<{id_type.simpleString()}>, word_runs {runs_}, spans {runs_}"
    blocks = _blocks(benchmark, item_key, item_text, block_bytes)

    def broadcast_of(block: DataFrame):
        rows = block.collect()  # of bounded bytes
        return spark.sparkContext.broadcast(Phrases.of([r["id"] for r in rows], [r["text"] for r in rows], window))

    if len(blocks) == 1:
        phrases = broadcast_of(blocks[0])

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, hashes, rows, begin, end in _shards(batches, text):
                hit, row, place = _matches(hashes, rows, phrases.value)
                yield _told(batch, plain, hit, rows, begin, end, _items(row, place, phrases.value.ids, batch.num_rows, kind))

        return rest.mapInArrow(search, schema)

    at = "_row" + "_" * max(map(len, plain))  # longer than any name there
    kept = staged(rest.withColumn(at, F.monotonically_increasing_id()), "texts")
    found = None
    for block in blocks:

        def meet(batches: Iterator[pa.RecordBatch], phrases=broadcast_of(block)) -> Iterator[pa.RecordBatch]:
            for batch, hashes, rows, _, _ in _shards(batches, text):
                hit, row, place = _matches(hashes, rows, phrases.value)
                n = batch.num_rows
                counts = np.bincount(rows, minlength=n)
                base = np.cumsum(counts) - counts
                a, b = _hit_runs(hit, rows)
                out = pa.RecordBatch.from_arrays(
                    [batch.column(at), _items(row, place, phrases.value.ids, n, kind), _lists(rows[a], n, start=a - base[rows[a]], stop=b + 1 - base[rows[a]])], names=[at, "items", "runs"]
                )
                yield out.filter(pa.array(np.bincount(rows[a], minlength=n) > 0))

        own = kept.select(at, text).mapInArrow(meet, f"{at} bigint, items array<{id_type.simpleString()}>, runs {runs_}")
        found = own if found is None else found.unionByName(own)
    found = staged(found, "matches").groupBy(at).agg(F.array_distinct(F.flatten(F.collect_list("items"))).alias("found_items" + at), F.flatten(F.collect_list("runs")).alias("found_runs" + at))
    joined = kept.join(found, at, "left").select(*plain, "found_items" + at, "found_runs" + at)

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, hashes, rows, begin, end in _shards(batches, text):
            n = batch.num_rows
            counts = np.bincount(rows, minlength=n)
            base = np.cumsum(counts) - counts
            edge = np.zeros(len(hashes) + 1, np.int64)
            for row, spans in enumerate(batch.column("found_runs" + at).to_pylist()):
                for x in spans or ():
                    edge[base[row] + x["start"]] += 1
                    edge[base[row] + x["stop"]] -= 1
            items = pa.array([x or [] for x in batch.column("found_items" + at).to_pylist()], pa.list_(kind))
            yield _told(batch, plain, np.cumsum(edge[:-1]) > 0, rows, begin, end, items)

    return joined.mapInArrow(unite, schema)


def remove_spans(docs: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """``docs`` with the byte spans cut out of the text; text without spans is left as it is, null stays null."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.get_field_index(text)
            out = []
            for value, found in zip(batch.column(place).to_pylist(), batch.column(spans).to_pylist()):
                if value and found:
                    data, at, parts = value.encode(), 0, []
                    for x in found:
                        parts.append(data[at : x["start"]])
                        at = x["stop"]
                    value = b"".join([*parts, data[at:]]).decode()
                out.append(value)
            yield batch.set_column(place, batch.schema.field(place), pa.array(out, batch.schema.field(place).type))

    return docs.mapInArrow(cut, docs.schema)
