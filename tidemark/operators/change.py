"""Dedupe, reconcile and diff of observations, and checks of their history."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

from .identity import content_hash, event_id
from .staging import staged


@dataclass(frozen=True)
class ChangeSpec:
    """Which columns are the key, which carry meaning (name to text expression), and which say when and in what state."""

    key: str
    fields: dict[str, str]
    observed: str = "observed_at"
    status: str = "status"

    def hashed(self, df: DataFrame) -> DataFrame:
        return df.withColumn("content_hash", content_hash({k: F.expr(v) for k, v in self.fields.items()}))


def latest_per_key(df: DataFrame, keys: list[str], newest: list[Column]) -> DataFrame:
    """The first row of each key in the given order, which must be total. Partial maxima go before the shuffle."""
    row = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest))
    return df.withColumn("_row", row).where("_row = 1").drop("_row")


def dedupe(df: DataFrame, spec: ChangeSpec) -> tuple[DataFrame, DataFrame]:
    """The latest row of each key, and the keys whose rows disagree in hash or status (which have no latest row)."""
    rows = spec.hashed(df)
    state = rows.groupBy(spec.key).agg(F.min("content_hash").alias("h1"), F.max("content_hash").alias("h2"), F.min(spec.status).alias("s1"), F.max(spec.status).alias("s2"))
    conflicts = state.where("h1 <> h2 or s1 <> s2").select(spec.key)
    text = F.to_json(F.struct(*sorted(rows.columns)))
    return latest_per_key(rows.join(conflicts, spec.key, "left_anti"), [spec.key], [F.desc(spec.observed), text]), conflicts


def conflicts(df: DataFrame, by: list[Column], watched: list[str]) -> DataFrame:
    """Groups whose rows differ in a watched column, with how many values each has."""
    counts = [F.count_distinct(c).alias(f"n_{c}") for c in watched]
    found = df.groupBy(*by).agg(F.count("*").alias("n"), *counts)
    wrong = F.lit(False)
    for c in watched:
        wrong = wrong | (F.col(f"n_{c}") > 1)
    return found.where(wrong)


#: States a complete run without an observation leaves as they are, and that an observation doesn't lift.
STICKY = ("quarantine", "withdrawn")


def reconcile(previous: DataFrame, observed: DataFrame, key: str, run_status: str = "complete") -> DataFrame:
    """Previous state against what a run observed, each row with ``key``, status and content_hash.

    Returns key, event (create, update, reappeared, missing_from_source or null), previous_hash, content_hash and
    result_status. Absence counts in complete runs only; a failed run must have observed nothing.
    """
    if run_status not in ("complete", "partial", "failed"):
        raise ValueError("unknown run status")
    p = previous.select(F.col(key), F.col("status").alias("p_status"), F.col("content_hash").alias("p_hash"))
    o = observed.select(F.col(key), F.col("status").alias("o_status"), F.col("content_hash").alias("o_hash"))
    both = p.join(o, key, "full_outer")
    had, seen = F.col("p_status").isNotNull(), F.col("o_status").isNotNull()
    if run_status == "failed":
        both = both.where(~seen)
    gone = F.lit(run_status == "complete") & had & ~seen
    event = (
        F.when(~had & seen, "create")
        .when(seen & (F.col("p_status") == "missing_from_source"), "reappeared")
        .when(seen & (F.col("p_hash") != F.col("o_hash")), "update")
        .when(gone & (F.col("p_status") == "active"), "missing_from_source")
    )
    status = (
        F.when(seen & F.coalesce(F.col("p_status").isin(*STICKY), F.lit(False)), F.col("p_status"))
        .when(seen, F.col("o_status"))
        .when(gone & (F.col("p_status") == "active"), "missing_from_source")
        .otherwise(F.col("p_status"))
    )
    return both.select(key, event.alias("event"), F.col("p_hash").alias("previous_hash"), F.coalesce("o_hash", "p_hash").alias("content_hash"), status.alias("result_status"))


def with_event_ids(changes: DataFrame, key: str) -> DataFrame:
    """The changes that are events, with their ids."""
    record = F.col(key).cast("string")
    return changes.where("event is not null").withColumn("event_id", event_id(record, F.col("event"), F.col("previous_hash"), F.col("content_hash")))


def diff_paths(previous: DataFrame, current: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """key, path, old and new of every field that differs between rows of one key; null and absent are the same."""
    p = previous.select(key, *(F.col(f).cast("string").alias(f"p_{f}") for f in fields))
    c = current.select(key, *(F.col(f).cast("string").alias(f"c_{f}") for f in fields))
    cells = F.array(*(F.struct(F.lit(f).alias("path"), F.col(f"p_{f}").alias("old"), F.col(f"c_{f}").alias("new")) for f in sorted(fields)))
    changed = F.filter(cells, lambda x: ~x["old"].eqNullSafe(x["new"]))
    return p.join(c, key).select(key, F.explode(changed).alias("x")).select(key, "x.path", "x.old", "x.new")


CHANGE = "array<struct<path: string, old: string, new: string>>"


def nested_changes(previous: Column, current: Column, kind: DataType, path: str = "") -> Column:
    """Every difference of two nested values as (path, old, new), values as JSON, in the order of sorted names.

    Objects are walked, lists are compared whole. A block that only one side has is one difference at its own path.
    """
    told = F.array(F.struct(F.lit(path).alias("path"), _json(previous, kind).alias("old"), _json(current, kind).alias("new"))).cast(CHANGE)
    none = F.array().cast(CHANGE)
    if not isinstance(kind, StructType):
        return F.when(previous.eqNullSafe(current), none).otherwise(told)
    inner = [nested_changes(previous[f.name], current[f.name], f.dataType, f"{path}.{f.name}" if path else f.name) for f in sorted(kind.fields, key=lambda f: f.name)]
    return F.when(previous.isNull() & current.isNull(), none).when(previous.isNull() | current.isNull(), told).otherwise(F.concat(*inner) if inner else none)


def _json(value: Column, kind: DataType) -> Column:
    if isinstance(kind, (StructType, ArrayType)):
        return F.to_json(value)
    return value.cast("string")


def diff_nested(previous: DataFrame, current: DataFrame, key: str, body: str) -> DataFrame:
    """key, path, old and new of every difference between the nested columns ``body`` of rows of one key."""
    kind = previous.schema[body].dataType
    if kind != current.schema[body].dataType:
        raise ValueError("diff: both sides need one schema")
    both = previous.select(key, F.col(body).alias("_p")).join(current.select(key, F.col(body).alias("_c")), key)
    return both.select(key, F.explode(nested_changes(F.col("_p"), F.col("_c"), kind)).alias("x")).select(key, "x.path", "x.old", "x.new")


#: Names by which elements of two lists are the same thing, the first filled one counts.
SHARED_KEYS = ("source_document_id", "cve", "source_url")


def _found_less(current: Column, names: list[str], kind: StructType):
    """Whether ``current`` has an element with the same last name, the earlier ones being empty, that lost something."""
    *earlier, key = names
    said = lambda x, n: F.coalesce(x[n].cast("string"), F.lit("")) != ""

    def less(old: Column) -> Column:
        found = said(old, key) & F.exists(current, lambda new: F.coalesce(new[key] == old[key], F.lit(False)) & loses_nested(old, new, kind))
        for n in earlier:
            found = found & ~said(old, n)
        return found

    return less


def loses_nested(previous: Column, current: Column, kind: DataType) -> Column:
    """Whether a nested value lost something that was there: a filled key is gone, a list is shorter, a text is empty, or
    an element that a shared key finds again lost a field. Other replacements are ordinary changes."""
    if isinstance(kind, StructType):
        inner = [loses_nested(previous[f.name], current[f.name], f.dataType) for f in kind.fields]
        lost = F.lit(False)
        for x in inner:
            lost = lost | x
        return previous.isNotNull() & (current.isNull() | F.coalesce(lost, F.lit(False)))
    if isinstance(kind, ArrayType):
        shorter = (F.size(previous) > 0) & (current.isNull() | (F.size(current) < F.size(previous)))
        out = F.coalesce(shorter, F.lit(False))
        if isinstance(kind.elementType, StructType):
            names = [k for k in SHARED_KEYS if k in kind.elementType.names]
            for at in range(len(names)):
                out = out | F.coalesce(F.exists(previous, _found_less(current, names[: at + 1], kind.elementType)), F.lit(False))
        return out
    gone = previous.isNotNull() & current.isNull()
    return gone | F.coalesce((previous != "") & (current == ""), F.lit(False)) if isinstance(kind, StringType) else gone


def loses_information(previous: Column, current: Column) -> Column:
    """Whether a map of texts lost a filled key or emptied it."""
    blank = lambda v: v.isNull() | (F.trim(v) == "")
    return F.exists(F.map_entries(previous), lambda e: ~blank(e["value"]) & F.coalesce(blank(F.element_at(current, e["key"])), F.lit(True)))


def transitions(df: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """Each change of ``value`` along a key's rows: key, order columns, previous and current value."""
    before = F.lag("current").over(Window.partitionBy(key).orderBy(*order))
    found = df.select(key, *order, F.col(value).alias("current")).withColumn("previous", before)
    return found.where("previous is null or previous <> current")


def broken_links(events: DataFrame, key: str, order: list[str], previous: str, current: str) -> DataFrame:
    """Events whose previous hash is not the hash of the event before them."""
    before = F.lag(current).over(Window.partitionBy(key).orderBy(*order))
    return events.withColumn("expected", before).where(~F.col("expected").eqNullSafe(F.col(previous)))


def reachable(edges: DataFrame, start: str, stop: str, roots: DataFrame, root: str, depth: int) -> DataFrame:
    """node and steps (the fewest) of what ``roots`` reach in at most ``depth`` steps; cycles are no trouble."""
    links = staged(edges.select(F.col(start).alias("a"), F.col(stop).alias("b")).distinct(), "links")
    new = staged(roots.select(F.col(root).alias("node"), F.lit(0).alias("steps")).distinct(), "reached")
    found = new
    for k in range(1, depth + 1):
        further = new.join(links, F.col("node") == F.col("a")).select(F.col("b").alias("node"), F.lit(k).alias("steps")).distinct()
        new = staged(further.join(found.select("node"), "node", "left_anti"), "reached")
        if new.isEmpty():
            break
        found = found.union(new)
    return found
