"""Texts against a dictionary of names, with the places of what was found, and spans inside other spans.

One engine serves every dictionary: an automaton of all its names reads a text once, whatever their number. Names that
stand as whole words count; what overlaps is settled from the hits.
"""

from __future__ import annotations

import unicodedata
import uuid
from collections.abc import Callable, Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staging import staged

#: Names of one automaton. A larger dictionary is dealt into blocks, each a pass over the texts whose hits are added up.
MOST_NAMES = 200_000
#: What a match of each kind of place is told as.
REASONS = {"municipality": "municipality_exact", "authority": "authority_exact", "province": "province_exact"}
LOCATED = "array<struct<reason: string, entity_code: string, entity_name: string, field: string, matched_text: string, method: string, start: int, end: int>>"


@cache
def is_word(c: str) -> bool:
    """Letters, digits, marks and connecting punctuation."""
    return c.isalnum() or unicodedata.category(c) in ("Mn", "Mc", "Me", "Pc", "Nl")


@cache
def _plain(c: str) -> str:
    return "".join(x for x in unicodedata.normalize("NFKD", c).casefold() if not unicodedata.combining(x))


def folded(text: str) -> tuple[str, list[int] | range]:
    """Case-folded text without accents, and for each of its characters the place in ``text`` it came from."""
    if text.isascii():
        return text.lower(), range(len(text))
    out, places = [], []
    for k, c in enumerate(text):
        plain = _plain(c)
        out.append(plain)
        places += [k] * len(plain)
    return "".join(out), places


class Names:
    """An automaton over (name, number) pairs; equal names share a state."""

    def __init__(self, names: list[tuple[str, int]]) -> None:
        self.by_name: dict[str, list[int]] = {}
        for name, k in names:
            self.by_name.setdefault(name, []).append(k)
        self.found = ahocorasick.Automaton()
        for name in self.by_name:
            self.found.add_word(name, name)
        self.found.make_automaton()

    def hits(self, text: str) -> list[tuple[int, int, str]]:
        """start, end and name of every name that stands in the text as whole words, from left to right."""
        out, n = [], len(text)
        for last, name in self.found.iter(text) if self.by_name else ():
            start = last + 1 - len(name)
            if not (start and is_word(text[start - 1])) and not (last + 1 < n and is_word(text[last + 1])):
                out.append((start, last + 1, name))
        return sorted(out)


def leftmost_longest(hits: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """From left to right, the longest hit at the first place left."""
    out, free = [], 0
    for hit in sorted(hits, key=lambda h: (h[0], -h[1])):
        if hit[0] >= free:
            out.append(hit)
            free = hit[1]
    return out


#: The automaton that a worker made last, by the broadcast it came from.
_MADE: dict[str, object] = {}


def _made(name: str, build: Callable[[], object]) -> object:
    if name not in _MADE:
        _MADE.clear()
        _MADE[name] = build()
    return _MADE[name]


def dictionary_match(texts: DataFrame, key: str, text: Column, names: DataFrame, code: str, name: str) -> DataFrame:
    """key, code and n (how often) for every name that stands in a text as whole words; names are small letters.

    Where names overlap, the leftmost counts and of those at one place the longest. Null texts and names hold nothing.
    """
    found = names.select(F.col(code).alias("code"), F.lower(name).alias("name")).where("name <> ''").distinct()
    listed = staged(found.select("name").distinct(), "names")
    blocks = -(-listed.count() // MOST_NAMES)
    kind = texts.schema[key].dataType.simpleString()
    rows = texts.select(F.col(key).alias("key"), F.lower(text).alias("text"), F.lit(None).cast("array<struct<start: int, end: int, name: string>>").alias("hits")).where("text is not null")
    out = texts.select(F.col(key), F.lit(None).cast(names.schema[code].dataType).alias("code"), F.lit(0).cast("long").alias("n")).where("false")
    if not blocks:
        return out
    counts = None
    for k in range(blocks):
        own = [(r["name"], 0) for r in listed.where(F.pmod(F.xxhash64("name"), F.lit(blocks)) == k).collect()]  # a block at a time
        told, last, token = texts.sparkSession.sparkContext.broadcast(own), k == blocks - 1, uuid.uuid4().hex

        def scan(batches: Iterator[pa.RecordBatch], told=told, last=last, token=token) -> Iterator[pa.RecordBatch]:
            automaton = _made(token, lambda: Names(told.value))
            for batch in batches:
                keys, said, before = batch.columns
                hits = [h + [(x["start"], x["end"], x["name"]) for x in b or ()] for h, b in zip(map(automaton.hits, said.to_pylist()), before.to_pylist())]
                if not last:
                    yield pa.RecordBatch.from_arrays([keys, said, pa.array([[dict(zip(("start", "end", "name"), x)) for x in h] for h in hits], before.type)], names=["key", "text", "hits"])
                    continue
                at, which, n = [], [], []
                for row, h in enumerate(hits):
                    per: dict[str, int] = {}
                    for _, _, x in leftmost_longest(h):
                        per[x] = per.get(x, 0) + 1
                    at += [row] * len(per)
                    which += per
                    n += per.values()
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(at, pa.int64())), pa.array(which, pa.string()), pa.array(n, pa.int64())], names=["key", "name", "n"])

        if last:
            counts = rows.mapInArrow(scan, f"key {kind}, name string, n bigint")
        else:
            rows = staged(rows.mapInArrow(scan, f"key {kind}, text string, hits array<struct<start: int, end: int, name: string>>"), "hits")
    return counts.join(found, "name").groupBy(F.col("key").alias(key), "code").agg(F.sum("n").alias("n"))


def located_matches(rows: DataFrame, fields: dict[str, Column], entities: DataFrame, weak: tuple[str, ...] = ("province",), column: str = "matches") -> DataFrame:
    """``rows`` with matches: which places their fields name, as reason, entity_code, entity_name, field, matched_text (as
    written), method, start and end (code points of the field, end exclusive).

    ``entities`` has kind, code, name, variant and method, a row for each way of writing a name; it is one register, held
    by every worker. Case and accents don't count, whole words do. Hits of ``weak`` kinds inside a hit of another kind
    go. Of one reason, code and field the first hit counts, those of weak kinds after all others; ties go by kind and code,
    official variants first. Fields are in the order given, null ones hold nothing. An old ``matches`` is replaced.
    """
    listed = entities.select("kind", "code", "name", "variant", "method").where("variant is not null").orderBy("kind", "code", F.col("method") != "official_variant", "variant").collect()  # the register
    told, token = rows.sparkSession.sparkContext.broadcast([tuple(r) for r in listed]), uuid.uuid4().hex
    asked = list(fields)
    here = rows.drop(column)
    plain = here.columns
    given = here.select("*", *(c.alias(f"{token}{k}") for k, c in enumerate(fields.values())))  # names that no column has

    def places(text: str | None, field: str, automaton: Names, register: list[tuple]) -> list[dict]:
        if not text:
            return []
        low, at = folded(text)
        strong, soft, free = [], [], {}
        for start, end, name in automaton.hits(low):
            if start < free.get(name, 0):
                continue  # a name doesn't overlap itself
            free[name] = end
            for k in automaton.by_name[name]:
                kind, code, official, _, method = register[k]
                (soft if kind in weak else strong).append((start, end, kind, code, k, official, method))
        soft = [x for x in soft if not any(y[0] <= x[0] and x[1] <= y[1] for y in strong)]
        out, seen = [], set()
        for start, end, kind, code, _, official, method in sorted(strong) + sorted(soft):
            if (kind, code) not in seen:
                seen.add((kind, code))
                a, b = at[start], at[end - 1] + 1
                out.append({"reason": REASONS.get(kind, kind), "entity_code": code, "entity_name": official, "field": field, "matched_text": text[a:b], "method": method, "start": a, "end": b})
        return out

    kind = pa.list_(pa.struct([*((n, pa.string()) for n in ("reason", "entity_code", "entity_name", "field", "matched_text", "method")), ("start", pa.int32()), ("end", pa.int32())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        register = told.value
        names = [("".join(map(_plain, r[3])), k) for k, r in enumerate(register)]
        automaton = _made(token, lambda: Names([x for x in names if x[0]]))
        for batch in batches:
            texts = [batch.column(len(plain) + k).to_pylist() for k in range(len(asked))]
            found = [[m for f, t in zip(asked, row) for m in places(t, f, automaton, register)] for row in zip(*texts)] if asked else [[]] * batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(plain)], pa.array(found, kind)], names=[*plain, column])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in here.schema)
    return given.mapInArrow(scan, f"{schema}, `{column}` {LOCATED}" if schema else f"`{column}` {LOCATED}")


def outside(spans: Column, stronger: Column) -> Column:
    """The spans (start, end) that lie in no stronger span."""
    return F.filter(spans, lambda s: ~F.exists(stronger, lambda t: (t["start"] <= s["start"]) & (s["end"] <= t["end"])))


def contained(spans: DataFrame, group: str, width: int) -> DataFrame:
    """Spans of a group that lie inside a longer span of it; each span is no longer than ``width``.

    Spans are dealt to the stretches of ``width`` they touch, so a large group is many partitions; a longer span touches
    all stretches that one inside it does. In order of start (longer ones first) a span lies inside another exactly if
    the largest end so far reaches its own: no span is compared with another one.
    """
    each = spans.select(group, "start", "end").distinct()
    dealt = each.withColumn("_cell", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor(F.col("end") / width))))
    earlier = Window.partitionBy(group, "_cell").orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    return dealt.withColumn("_reach", F.max("end").over(earlier)).where("_reach >= end").select(group, "start", "end").distinct()
