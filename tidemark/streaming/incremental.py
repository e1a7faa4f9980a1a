"""Incremental reading: late rows again without doubles, sinks that can be repeated, and state by key."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def read_stream(spark: SparkSession, path: str, schema: str, files: int = 64, pattern: str | None = None) -> DataFrame:
    """A stream of the Parquet files below ``path``, so many in a batch at most."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files)
    return (reader.option("pathGlobFilter", pattern) if pattern else reader).parquet(path)


def deduplicated(stream: DataFrame, key: list[str], at: str, overlap: str = "14 days") -> DataFrame:
    """Rows whose key was not seen within the overlap; state older than that goes."""
    return stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, overlap).dropDuplicatesWithinWatermark(key)


def run_available(stream: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None]) -> None:
    """Everything there is, in batches; the checkpoint advances only past batches whose sink returned."""
    query = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def append_once(path: str, key: str, parts: int = 16) -> Callable[[DataFrame, int], None]:
    """A sink that adds only keys that are not there: a repeated batch replaces itself.

    Rows lie in folders by stretch of hashed keys, then by batch, and a batch reads those of its own keys only.
    """

    def sink(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        place = F.pmod(F.xxhash64(key), F.lit(parts)).cast("int").alias("key_part")
        mine = batch.dropDuplicates([key]).select("*", place, F.lit(number).alias("batch")).persist()
        try:
            spark.createDataFrame([], mine.schema).write.mode("append").parquet(path)  # so that there is a folder to read
            touched = [r[0] for r in mine.select("key_part").distinct().collect()]  # as many as there are parts at most
            there = spark.read.schema(mine.schema).option("basePath", path).parquet(path).where(F.col("key_part").isin(touched) & (F.col("batch") != number))
            fresh = mine.join(there.select(key), key, "left_anti").repartition("key_part")
            fresh.write.partitionBy("key_part", "batch").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
        finally:
            mine.unpersist()

    return sink


STATE = "content_hash string, version bigint"
CHANGES = "record_id string, event string, previous_hash string, content_hash string, version bigint"


def state_changes(stream: DataFrame, key: str, content: str, order: str) -> DataFrame:
    """The create and update events of a stream of observations, with the last content hash of each key as state.

    Rows of one batch are taken in the order of ``order``; a row equal to the state makes no event.
    """

    def step(names: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, version = state.get if state.exists else (None, 0)
        rows = pd.concat(batches).sort_values(["at", "content"], kind="stable")
        out = []
        for now in rows["content"]:
            if now != last:
                version += 1
                out.append((names[0], "create" if last is None else "update", last, now, version))
                last = now
        state.update((last, version))
        yield pd.DataFrame(out, columns=["record_id", "event", "previous_hash", "content_hash", "version"])

    rows = stream.select(F.col(key).cast("string").alias("record_id"), F.col(content).alias("content"), F.col(order).cast("string").alias("at"))
    return rows.groupBy("record_id").applyInPandasWithState(step, CHANGES, STATE, "append", GroupStateTimeout.NoTimeout)


def latest_by_key(path: str, key: str, version: str) -> Callable[[DataFrame, int], None]:
    """A sink of the newest row of each key in a batch, in a folder for each batch; readers take the newest of all."""

    def sink(batch: DataFrame, number: int) -> None:
        newest = batch.groupBy(key).agg(F.max_by(F.struct(*batch.columns), version).alias("row"))
        newest.select("row.*").write.mode("overwrite").parquet(f"{path}/batch={number}")

    return sink


def in_order(*sinks: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Sinks one after the other: what a later one lacks after a failure, an earlier one tells, and the batch repeats."""

    def sink(batch: DataFrame, number: int) -> None:
        kept = batch.persist()
        try:
            for each in sinks:
                each(kept, number)
        finally:
            kept.unpersist()

    return sink
