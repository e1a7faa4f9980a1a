"""Sorted runs: rows dealt by range and sorted, so that the rows of one key follow each other, over as many tasks as they
need. A value that runs along a key is kept up within a task, and what a key brings along from earlier tasks is added
from one summary for each task. So a key with a third of all rows is split like any other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import staged


def carried(runs: DataFrame, key: str, value: str, together: Callable[[Any, Any], Any]) -> DataFrame:
    """part, key and value: what each task's first key has run up to before that task; tasks that begin a key have no row.

    ``runs`` is staged and has part, row (the place in it), the key, and the value run up to each row within its part.
    The driver reads one row for each part.
    """
    ends = runs.groupBy("part").agg(F.min_by(key, "row").alias("first"), F.max_by(F.struct(key, value), "row").alias("last"))
    found, before, out = sorted(ends.collect(), key=lambda r: r["part"]), None, []
    for r in found:
        own = r["last"][1]
        if before is not None and before[0] == r["first"]:
            out.append((r["part"], r["first"], before[1]))
            if r["last"][0] == r["first"]:
                own = together(before[1], own)
        before = (r["last"][0], own)
    kinds = dict(runs.dtypes)
    return runs.sparkSession.createDataFrame(out, f"part int, first {kinds[key]}, before {kinds[value]}")


def with_carried(runs: DataFrame, key: str, value: str, together: Callable[[Any, Any], Any]) -> DataFrame:
    """``runs`` with ``before``, which is null for rows of keys that begin in their own part."""
    parts = F.broadcast(carried(runs, key, value, together))  # at most a row for each part
    rest = parts.withColumnRenamed("part", "_part")
    return runs.join(rest, (F.col("part") == F.col("_part")) & F.col(key).eqNullSafe(F.col("first")), "left").drop("_part", "first")


def ranked(rows: DataFrame, key: str, by: Sequence[Column]) -> DataFrame:
    """``rows`` with place: the number of rows of the same key before it in the order of ``by``; staged.

    Rows equal in all of ``by`` are in no certain order. The names part, row, upto and before are taken.
    """
    here, tie = rows.columns, F.monotonically_increasing_id()
    order = [F.col(key), *by]
    dealt = rows.withColumn("_tie", tie).repartitionByRange(*order, F.col("_tie")).sortWithinPartitions(*order)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row, last, n = TaskContext.get().partitionId(), 0, object(), 0
        for batch in batches:
            keys = batch.column(here.index(key)).to_pylist()
            upto = np.empty(len(keys), np.int64)
            for i, k in enumerate(keys):
                n = n + 1 if k == last else 1
                last, upto[i] = k, n
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in range(len(here))), pa.array(np.full(len(keys), part, np.int32)), pa.array(np.arange(row, row + len(keys))), pa.array(upto)],
                names=[*here, "part", "row", "upto"],
            )
            row += len(keys)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", part int, row bigint, upto bigint"
    runs = staged(dealt.drop("_tie").mapInArrow(number, schema), "ranked")
    found = with_carried(runs, key, "upto", lambda a, b: a + b)
    return found.select(*here, (F.col("upto") - 1 + F.coalesce("before", F.lit(0))).alias("place"))


def digests(rows: DataFrame, key: str, order: Sequence[str], texts: Sequence[str], sums: Sequence[str] = (), separator: str = "") -> DataFrame:
    """For every key the SHA-256 of each text column, its rows end to end in ``order`` with ``separator`` between, and the sums of number columns.

    A digest is made in one sequence, so a key is read by one task, but as a sorted stream: nothing is held but the
    hash's state. Null texts are empty and null numbers 0.
    """
    kind = dict(rows.dtypes)[key]
    out = ", ".join([f"`{key}` {kind}", *(f"{t}_sha256 string" for t in texts), *(f"{s} bigint" for s in sums)])
    names = [key, *(f"{t}_sha256" for t in texts), *sums]

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = None
        now: Any = None
        states, totals, begun = [], [], False

        def row() -> list:
            return [now, *(s.hexdigest() for s in states), *totals]

        for batch in batches:
            arrow = batch.schema.field(key).type
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (key, *texts, *sums)]
            done = []
            for k, *rest in zip(*columns):
                fresh = not begun or k != now
                if fresh:
                    if begun:
                        done.append(row())
                    now, begun = k, True
                    states, totals = [hashlib.sha256() for _ in texts], [0 for _ in sums]
                for s, t in zip(states, rest):
                    s.update(((t or "") if fresh else separator + (t or "")).encode())
                for j, v in enumerate(rest[len(texts) :]):
                    totals[j] += v or 0
            if done:
                yield _batch(done, names, arrow, len(texts))
        if begun:
            yield _batch([row()], names, arrow, len(texts))

    dealt = rows.select(key, *order, *texts, *sums).repartition(key).sortWithinPartitions(key, *order)
    return dealt.mapInArrow(stream, out)


def _batch(rows: list[list], names: list[str], kind: pa.DataType, texts: int) -> pa.RecordBatch:
    columns = list(zip(*rows))
    types = [kind, *[pa.string()] * texts, *[pa.int64()] * (len(names) - 1 - texts)]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)
