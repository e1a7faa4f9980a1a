"""Keyed tables as plain Parquet folders, one for each stretch of hashed keys.

An append is an anti-join that adds files; a merge rewrites only the folders that its keys fall into. What contradicts
the table comes back as rows, and nothing is written then. Writers of one table must take turns.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from ..operators.staging import staged

PLACE = "key_part"
CONFLICT = "key string, code string"


@dataclass(frozen=True)
class KeyedTable:
    """Where a table lies, its columns, its key, and how many folders the keys are dealt into."""

    path: str
    schema: str
    key: str
    parts: int = 16

    def _place(self, value: Column) -> Column:
        return F.pmod(F.xxhash64(value), F.lit(self.parts)).cast("int")

    def _type(self) -> StructType:
        return _parse_datatype_string(f"{self.schema}, {PLACE} int")

    def create(self, spark: SparkSession) -> None:
        """An empty table, if none is there."""
        spark.createDataFrame([], self._type()).write.mode("append").parquet(self.path)

    def read(self, spark: SparkSession, places: Sequence[int] | None = None) -> DataFrame:
        """The rows, or those of some folders; others are not even listed. Rows without a key are none: a folder that has
        lost all its rows keeps one."""
        rows = spark.read.schema(self._type()).option("basePath", self.path).parquet(self.path).where(F.col(self.key).isNotNull())
        return (rows.where(F.col(PLACE).isin(*places)) if places is not None else rows).drop(PLACE)

    def get(self, spark: SparkSession, value: object) -> DataFrame:
        """The rows of one key, from its one folder."""
        one = F.lit(value).cast(self._type()[self.key].dataType)
        return self.read(spark, [spark.range(1).select(self._place(one)).first()[0]]).where(F.col(self.key) == one)

    def _columns(self) -> list[str]:
        return [f.name for f in self._type() if f.name != PLACE]

    def _touched(self, rows: DataFrame) -> list[int]:
        """The folders that rows fall into: as many numbers as there are folders at most."""
        return [r[0] for r in rows.select(self._place(F.col(self.key))).distinct().collect()]

    def _write(self, rows: DataFrame, mode: str) -> None:
        at = self._place(F.col(self.key))
        dealt = rows.select(*self._columns(), at.alias(PLACE)).repartition(PLACE) if mode == "overwrite" else rows.select(*self._columns(), at.alias(PLACE))
        dealt.write.partitionBy(PLACE).mode(mode).option("partitionOverwriteMode", "dynamic").parquet(self.path)

    def append(self, rows: DataFrame, ignoring: Sequence[str] = ()) -> DataFrame:
        """Adds rows whose key is new and gives back what stops the whole append: rows of one key that differ, or differ
        from the table (columns in ``ignoring``, such as when a row was seen, don't count); equal ones are there already."""
        spark = rows.sparkSession
        body = F.sha2(F.to_json(F.struct(*sorted(c for c in self._columns() if c not in ignoring))), 256)
        mine = staged(rows.select(*self._columns(), body.alias("_body")), "append")
        known = self.read(spark, self._touched(mine)).select(F.col(self.key), body.alias("_known"))
        told = lambda found, code: found.select(F.col(self.key).cast("string").alias("key"), F.lit(code).alias("code"))
        bad = told(mine.where(F.col(self.key).isNull()), "key_missing").unionByName(told(mine.groupBy(self.key).agg(F.count_distinct("_body").alias("n")).where("n > 1"), "rows_differ"))
        bad = staged(bad.unionByName(told(mine.join(known, self.key).where("_body <> _known").select(self.key).distinct(), "other_content")), "conflicts")
        if bad.isEmpty():
            self._write(mine.join(known.select(self.key), self.key, "left_anti").dropDuplicates([self.key]), "append")
        return bad

    def merge(self, rows: DataFrame, deleted: str | None = None, gates: dict[str, Column] | None = None) -> DataFrame:
        """Replaces rows by key, drops keys whose ``deleted`` is true, and gives back what stops the whole merge: keys that
        are there twice, and rows that fail one of ``gates`` (unknown counts as failed), which are asked right before."""
        spark = rows.sparkSession
        gates = {"key_missing": F.col(self.key).isNotNull()} | (gates or {})
        checks = F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(code)) for code, ok in gates.items()))).cast("array<string>")
        mine = staged(rows.withColumn("_codes", checks), "merge")
        key = F.col(self.key).cast("string").alias("key")
        bad = mine.select(key, F.explode("_codes").alias("code")).unionByName(mine.groupBy(self.key).count().where("count > 1").select(key, F.lit("key_repeated").alias("code")))
        bad = staged(bad, "conflicts")
        if bad.isEmpty() and (places := self._touched(mine)):
            kept = mine.where(~F.coalesce(F.col(deleted), F.lit(False))) if deleted else mine
            old = self.read(spark, places).join(mine.select(self.key), self.key, "left_anti")
            whole = staged(old.unionByName(kept.select(*self._columns())), "merged")
            self._write(whole, "overwrite")
            if empty := set(places) - set(self._touched(whole)):
                gone = spark.createDataFrame([(p,) for p in empty], f"{PLACE} int").select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in self._type() if f.name != PLACE), PLACE)
                gone.write.partitionBy(PLACE).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(self.path)
        return bad

    def problems(self, spark: SparkSession, checks: Column | None = None) -> DataFrame:
        """key and code of rows that fail ``checks`` and of keys that are there twice."""
        rows, key = self.read(spark), F.col(self.key).cast("string").alias("key")
        bad = rows.groupBy(self.key).count().where("count > 1").select(key, F.lit("duplicate_key").alias("code"))
        return bad if checks is None else bad.unionByName(rows.where(~F.coalesce(checks, F.lit(False))).select(key, F.lit("row_invalid").alias("code")))
