"""Deterministic identities: record ids, content hashes, event ids and hashes of whole sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.canon import canonical_json, canonical_url, sha256, slug

UNIT = "\x1f"


def content_hash(fields: dict[str, Column]) -> Column:
    """SHA-256 of the canonical JSON of the fields that carry meaning."""
    return sha256(canonical_json(fields))


def token(stable: Column) -> Column:
    """A readable and a unique half of a stable name."""
    return F.concat(slug(stable, 64), F.lit("-"), F.substring(sha256(stable), 1, 16))


def identify(df: DataFrame, source: Column, prefix: str = "rec", official_id: Column | None = None, case_number: Column | None = None, url: Column | None = None, fingerprint: list[Column] = ()) -> DataFrame:
    """``df`` with record_id and identity_strategy: the first of official id, case number, URL that is not blank,
    else a fingerprint of the given columns."""
    filled = lambda c: F.when(F.trim(c) != "", c)
    choices = [("official_id", official_id), ("case_number", case_number), ("canonical_url", None if url is None else canonical_url(url))]
    strategy, stable = F.lit("composite_fingerprint"), None
    for name, c in reversed([x for x in choices if x[1] is not None]):
        strategy = F.when(filled(c).isNotNull(), F.lit(name)).otherwise(strategy)
        stable = token(filled(c)) if stable is None else F.when(filled(c).isNotNull(), token(c)).otherwise(stable)
    whole = sha256(F.concat_ws(UNIT, *(F.coalesce(c.cast("string"), F.lit("")) for c in fingerprint))) if fingerprint else F.lit(None).cast("string")
    last = whole if stable is None else F.coalesce(stable, whole)
    return df.withColumns({"record_id": F.concat_ws(":", F.lit(prefix), slug(source), last), "identity_strategy": strategy})


def event_id(record_id: Column, kind: Column, previous: Column, current: Column) -> Column:
    """The id of a transition: equal transitions have equal ids whenever they were seen."""
    said = lambda c: F.coalesce(F.concat(F.lit('"'), c, F.lit('"')), F.lit("null"))
    return F.concat(F.lit("evt-v1-"), sha256(F.concat(F.lit("["), F.concat_ws(",", said(record_id), said(kind), said(previous), said(current)), F.lit("]"))))


#: Rows whose hashes are gathered into one text, about.
PART_ROWS = 4096


def population_hash(df: DataFrame, by: list[str], key: Column, row: Column, parts: int | None = None) -> DataFrame:
    """A hash of each group's rows that no order changes: hashes of rows by key, gathered in parts, then once more.

    Rows of a part are hashed together first; there are as many parts as make each short (``parts`` fixes their number,
    which is part of the hash, as is the largest group's size without it).
    """
    if parts is None:
        largest = df.groupBy(*by).count().agg(F.max("count")).first()[0] or 0
        parts = 1 << max(0, (int(largest) // PART_ROWS).bit_length())
    part = F.pmod(F.xxhash64(key), F.lit(parts))
    small = df.groupBy(*by, part.alias("part")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(sha256(row))), ""), 256).alias("h"), F.count("*").alias("n"))
    return small.groupBy(*by).agg(F.sum("n").alias("n"), F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "h"))), lambda x: x["h"]), ""), 256).alias("population_hash"))
