"""Checks of whole tables: closed rows, histories, migrations, publication plans, rechecks. Violations are rows of codes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import KeyedTable
from .change import broken_links
from .staging import dealt

VIOLATION = "kind string, key string, code string"
#: Rows of a table that one task joins or sorts; larger tables have more tasks, not larger ones.
TASK_ROWS = 250_000


def violations(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """``df`` with violations: the sorted codes of the checks that a row fails; unknown counts as failed."""
    return df.withColumn("violations", F.array_sort(F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(code)) for code, ok in checks.items())))))


def required(text: Column) -> Column:
    return F.coalesce(F.trim(text) != "", F.lit(False))


def one_of(value: Column, domain: tuple) -> Column:
    return F.coalesce(value.isin(*domain), F.lit(False))


def iso_date(text: Column) -> Column:
    """Whether a text is a day that exists, as YYYY-MM-DD."""
    return text.rlike(r"^\d{4}-\d{2}-\d{2}$") & text.try_cast("date").isNotNull()


def iso_instant(text: Column) -> Column:
    """Whether a text is an instant that declares its zone."""
    return text.rlike(r"(?i)^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:Z|[+-]\d{2}:?\d{2})$") & F.try_to_timestamp(text).isNotNull()


def sha256_text(text: Column) -> Column:
    return F.coalesce(text.rlike("^[0-9a-f]{64}$"), F.lit(False))


def _told(df: DataFrame, kind: str, key: str, code: str) -> DataFrame:
    return df.select(F.lit(kind).alias("kind"), F.col(key).cast("string").alias("key"), F.lit(code).alias("code"))


def duplicates(df: DataFrame, kind: str, key: str) -> DataFrame:
    return _told(df.groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1"), kind, key, f"duplicate_{key}")


def audit(records: DataFrame, events: DataFrame, runs: DataFrame, computed_hash: Column, event_hash: Column) -> DataFrame:
    """Every violation of records (record_id, content_hash), events (event_id, record_id) and runs (run_id and counters).

    Hashes and event ids are computed again, ids must be unique, events need their record, counters must add up.
    """
    parts = [
        _told(records.where(~computed_hash.eqNullSafe(F.col("content_hash"))), "records", "record_id", "content_hash"),
        duplicates(records, "records", "record_id"),
        _told(events.where(~event_hash.eqNullSafe(F.col("event_id"))), "events", "event_id", "event_identity"),
        duplicates(events, "events", "event_id"),
        _told(events.join(records.select("record_id").distinct(), "record_id", "left_anti"), "events", "event_id", "event_without_record"),
        duplicates(runs, "runs", "run_id"),
        _told(runs.where("not coalesce(seen = included + excluded, false)"), "runs", "run_id", "counters"),
    ]
    return reduce(DataFrame.unionByName, parts)


def artefact_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """kind and n of every table, 0 for empty ones."""
    return reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n") for kind, df in tables.items()])


def identity_report(df: DataFrame, record_id: str, strategy: str, stable: str, content_hash: str) -> DataFrame:
    """One row: rows, different ids, ids by fallback, ids of several stable names, and whether each id has one hash."""
    by_id = df.groupBy(record_id).agg(F.count("*").alias("n"), F.min(stable).alias("a"), F.max(stable).alias("b"), F.min(content_hash).alias("h"), F.max(content_hash).alias("i"), F.count_if(F.col(strategy) == "composite_fingerprint").alias("f"))
    return by_id.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("*").alias("unique_ids"), F.coalesce(F.sum("f"), F.lit(0)).alias("fallbacks"), F.count_if(F.col("a") != F.col("b")).alias("collisions"), F.coalesce(F.bool_and(F.col("h") == F.col("i")), F.lit(True)).alias("hashes_stable"))


def warning_counts(df: DataFrame, codes: str, domain: tuple[str, ...]) -> DataFrame:
    """code and n of the known warnings of all rows; codes outside the domain count as other."""
    each = df.select(F.explode(codes).alias("code"))
    return each.groupBy(F.when(F.col("code").isin(*domain), F.col("code")).otherwise("other").alias("code")).agg(F.count("*").alias("n"))


class _Walk:
    """One record's history as far as it was seen: where it stands, and which hashes lead where."""

    def __init__(self, key: object, now: str):
        self.key, self.now, self.here, self.code = key, now, None, None
        self.edges: dict[str, set[str]] = {}

    def reaches(self, start: str, wanted: str) -> bool:
        seen, todo = {start}, [start]
        while todo and wanted not in seen:
            new = self.edges.get(todo.pop(), set()) - seen
            seen |= new
            todo += new
        return wanted in seen

    def step(self, kind: str, before: str, after: str) -> None:
        if kind != "create" and self.code is None:
            self.here = before if self.here is None else self.here
            if not self.reaches(self.here, before):
                self.code = "disconnected_or_forked"
            self.edges.setdefault(before, set()).add(after)
        self.here = after

    def verdict(self) -> list[tuple]:
        code = self.code or (None if self.reaches(self.here, self.now) else "tip_mismatch")
        return [(self.key, code)] if code else []


def validate_history(events: DataFrame, records: DataFrame, key: str = "record_id", at: str = "observed_at") -> DataFrame:
    """``key`` and code of records whose events do not make one history that ends in the record's hash.

    Events have type, previous_hash, content_hash. Codes: event_without_record, incompatible_creates,
    order_ambiguous, create_after_update, disconnected_or_forked, tip_mismatch; the first that fits. An update may
    start from any hash that the transitions seen so far lead to. Most histories are plain chains, told by a window;
    only records with a link that is not to the event before are walked one by one.
    """
    rows, n = events.select(key, at, "type", "previous_hash", "content_hash"), events.count()
    rows, records = dealt(rows, n, TASK_ROWS, key), dealt(records.select(key, "content_hash"), n, TASK_ROWS, key)
    orphan = rows.join(records.select(key).distinct(), key, "left_anti").select(key, F.lit("event_without_record").alias("code"))
    order = Window.partitionBy(key).orderBy(at)
    marked = rows.withColumns({"_first": F.row_number().over(order) == 1, "_same": F.lag(at).over(order) == F.col(at), "_before": F.lag("content_hash").over(order)})
    create = F.col("type") == "create"
    state = marked.groupBy(key).agg(
        F.count_if(create).alias("creates"), F.count_if(F.col("_same")).alias("ties"), F.count_if(create & ~F.col("_first")).alias("late"),
        F.count_if(~create & ~F.col("_first") & ~F.col("previous_hash").eqNullSafe(F.col("_before"))).alias("jumps"), F.max_by("content_hash", at).alias("tip"),
    ).join(records.select(key, F.col("content_hash").alias("now")), key)
    plain = F.when(F.col("creates") > 1, "incompatible_creates").when(F.col("ties") > 0, "order_ambiguous").when(F.col("late") > 0, "create_after_update")
    state = state.withColumn("code", plain)
    walk = state.where("code is null and (jumps > 0 or tip <> now)").select(key, "now")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by record and then instant; what is kept is one record's transitions."""
        walk_: _Walk | None = None
        for batch in batches:
            out = []
            for k, kind, before, after, now in zip(*(batch.column(c).to_pylist() for c in (key, "type", "previous_hash", "content_hash", "now"))):
                if walk_ is None or walk_.key != k:
                    out += walk_.verdict() if walk_ else []
                    walk_ = _Walk(k, now)
                walk_.step(kind, before, after)
            yield told(out, batch.schema.field(key).type)
        if walk_:
            yield told(walk_.verdict(), batch.schema.field(key).type)

    def told(found: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], kind), pa.array([c for _, c in found], pa.string())], names=[key, "code"])

    kind = events.schema[key].dataType.simpleString()
    sorted_ = dealt(rows.join(walk, key), n, TASK_ROWS, key).sortWithinPartitions(key, at)
    walked = sorted_.mapInArrow(fold, f"`{key}` {kind}, code string")
    return orphan.distinct().unionByName(state.where("code is not null").select(key, "code")).unionByName(walked)


def chain_breaks(events: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The plain links that do not fit, by window alone."""
    return broken_links(events, key, order, "previous_hash", "content_hash")


def validate_migration(originals: DataFrame, prepared: DataFrame, evidence: DataFrame, expected: int | None = None, key: str = "record_id") -> DataFrame:
    """Violations of a change of hash version: the three tables must hold the same keys, once each.

    originals and prepared have version, source, detected_at and content_hash; prepared also v1_hash (its hash under the
    old version); evidence has from_hash and to_hash. Codes: incomplete_batch, evidence_conflict, source_drift.
    """
    n = originals.count()
    originals, prepared, evidence = (dealt(df, n, TASK_ROWS, key) for df in (originals, prepared, evidence))
    once = [df.groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1").select(key) for df in (originals, prepared, evidence)]
    o = originals.select(key, F.struct("version", "source", "detected_at", "content_hash").alias("o"))
    p = prepared.select(key, F.struct("version", "source", "detected_at", "content_hash", "v1_hash").alias("p"))
    e = evidence.select(key, F.struct("from_hash", "to_hash").alias("e"))
    rows = o.join(p, key, "full_outer").join(e, key, "full_outer")
    whole = F.col("o").isNotNull() & F.col("p").isNotNull() & F.col("e").isNotNull()
    fits = (
        (F.col("o.version") == 1) & (F.col("p.version") == 2) & F.col("o.source").eqNullSafe(F.col("p.source")) & F.col("o.detected_at").eqNullSafe(F.col("p.detected_at"))
        & (F.col("e.from_hash") == F.col("o.content_hash")) & (F.col("e.to_hash") == F.col("p.content_hash"))
    )
    code = F.when(~whole, "incomplete_batch").when(~F.coalesce(fits, F.lit(False)), "evidence_conflict").when(~F.col("p.v1_hash").eqNullSafe(F.col("e.from_hash")), "source_drift")
    found = rows.select(F.col(key).cast("string").alias("key"), code.alias("code")).where("code is not null")
    for df in once:
        found = found.unionByName(df.select(F.col(key).cast("string").alias("key"), F.lit("incomplete_batch").alias("code")))
    if expected is not None:
        counted = originals.agg(F.count("*").alias("n")).where(F.col("n") != expected)
        found = found.unionByName(counted.select(F.lit(None).cast("string").alias("key"), F.lit("incomplete_batch").alias("code")))
    return found.distinct()


def same_set(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row: whether both tables hold the same keys, and how many only one of them has."""
    left, right = a.select(key).distinct().withColumn("l", F.lit(True)), b.select(key).distinct().withColumn("r", F.lit(True))
    both = left.join(right, key, "full_outer")
    return both.agg(F.count_if(F.col("r").isNull()).alias("only_left"), F.count_if(F.col("l").isNull()).alias("only_right")).select((F.col("only_left") + F.col("only_right") == 0).alias("equal"), "only_left", "only_right")


def control_violations(records: DataFrame, marker: DataFrame, evidence: DataFrame, key: str = "record_id") -> DataFrame:
    """What speaks against the hash version that a cutover marker (record_count, version) states, as codes."""
    state = marker.agg(F.count("*").alias("markers"), F.max("record_count").alias("wanted"), F.max("version").alias("version"))
    held = records.agg(F.count("*").alias("records"), F.count_if(F.col("version") != 2).alias("old"))
    proved = evidence.agg(F.count("*").alias("proofs"), F.count_distinct(key).alias("keys"))
    one = state.crossJoin(held).crossJoin(proved)  # three single rows
    checks = {"marker_invalid": "markers <= 1", "evidence_without_marker": "markers = 1 or proofs = 0", "incomplete_batch": "markers = 0 or (wanted = records and wanted = proofs)", "evidence_duplicated": "proofs = keys", "version_mixed": "markers = 0 or old = 0", "version_invalid": "markers = 0 or version = 2"}
    return one.select(F.explode(F.array_compact(F.array(*(F.when(~F.coalesce(F.expr(c), F.lit(False)), F.lit(k)) for k, c in checks.items())))).alias("code"))


def publication_plan(candidates: DataFrame, known: DataFrame, approved: DataFrame, key: str = "record_id") -> DataFrame:
    """The first of two phases: what a publication would do with each candidate, without a write.

    plan is create, update or no_change for approved candidates that privacy allows, held or blocked for others; approved
    keys that no candidate has are missing. The second phase writes the rows of plan create and update only.
    """
    have = known.select(key, F.col("content_hash").alias("_known"))
    listed = approved.select(key).distinct().withColumn("_approved", F.lit(True))
    rows = candidates.join(listed, key, "full_outer").join(have, key, "left")
    plan = (
        F.when(F.col("content_hash").isNull(), "missing").when(F.col("privacy") != "allow", "blocked").when(F.col("_approved").isNull(), "held")
        .when(F.col("_known").isNull(), "create").when(F.col("_known") != F.col("content_hash"), "update").otherwise("no_change")
    )
    return rows.select(key, plan.alias("plan"), F.col("_known").alias("previous_hash"), "content_hash")


def publish(plan: DataFrame, candidates: DataFrame, approved: DataFrame, table: KeyedTable) -> DataFrame:
    """The second phase: writes the rows of plan create and update, and gives back what stops all of them as key and code.

    Nothing of the plan is taken on trust: each row is asked again whether its candidate is there once and as planned,
    whether privacy still allows it, whether it is approved, and whether the table still holds what the plan saw.
    """
    key = table.key
    now = candidates.groupBy(key).agg(F.first("content_hash").alias("_now"), F.min(F.col("privacy") == "allow").alias("_allowed"), F.count("*").alias("_times"))
    listed = approved.select(key).distinct().withColumn("_approved", F.lit(True))
    have = table.read(plan.sparkSession).select(key, F.col("content_hash").alias("_have"))
    rows = plan.where(F.col("plan").isin("create", "update")).join(now, key, "left").join(listed, key, "left").join(have, key, "left")
    gates = {
        "candidate_not_unique": F.col("_times") == 1, "content_changed": F.col("_now") == F.col("content_hash"), "privacy_not_allowed": F.col("_allowed"),
        "not_approved": F.col("_approved"), "table_changed": F.col("_have").eqNullSafe(F.col("previous_hash")),
    }
    return table.merge(rows, gates=gates)


def stable_reads(first: DataFrame, second: DataFrame, key: str, content: str) -> DataFrame:
    """``key`` and stable: whether two reads of one thing were the same; what only one read saw is not."""
    a, b = first.select(key, F.col(content).alias("_a")), second.select(key, F.col(content).alias("_b"))
    return a.join(b, key, "full_outer").select(key, F.coalesce(F.col("_a") == F.col("_b"), F.lit(False)).alias("stable"))


def recheck(selected: DataFrame, observed: DataFrame, known: DataFrame, key: str = "record_id") -> DataFrame:
    """Each selected key's outcome of a second look: identical, modified, rejected (unstable reads) or not_attempted.

    observed has content_hash and stable; known has content_hash. Keys that were not selected are not looked at.
    """
    seen = observed.select(key, F.col("content_hash").alias("_new"), "stable")
    rows = selected.select(key).distinct().join(seen, key, "left").join(known.select(key, "content_hash"), key, "left")
    outcome = F.when(F.col("stable").isNull(), "not_attempted").when(~F.col("stable"), "rejected").when(F.col("_new").eqNullSafe(F.col("content_hash")), "identical").otherwise("modified")
    return rows.select(key, outcome.alias("outcome"))


def recheck_totals(outcomes: DataFrame) -> DataFrame:
    """One row of totals: accepted are identical and modified; complete if all were, partial if some, else failed."""
    n = {x: F.count_if(F.col("outcome") == x).alias(x) for x in ("identical", "modified", "rejected", "not_attempted")}
    out = outcomes.agg(F.count("*").alias("selected"), *n.values()).withColumn("accepted", F.col("identical") + F.col("modified"))
    return out.withColumn("status", F.when(F.col("accepted") == F.col("selected"), "complete").when(F.col("accepted") > 0, "partial").otherwise("failed"))


#: What a fetch's state makes of a run, and what a run's state makes of a command's exit code.
RUN_STATUS = {"ok": "success", "no_daily_publication": "no_publication", "partial": "partial", "timeout": "failed", "http_error": "failed", "invalid": "failed"}
EXIT_CODES = {"success": 0, "no_publication": 0, "partial": 2, "failed": 1}


def run_status(state: Column) -> Column:
    """status and exit_code of a run by how its fetch ended; unknown states failed."""
    look = lambda table, c: F.try_element_at(F.create_map(*(F.lit(x) for pair in table.items() for x in pair)), c)
    status = F.coalesce(look(RUN_STATUS, state), F.lit("failed"))
    return F.struct(status.alias("status"), look(EXIT_CODES, status).alias("exit_code"))


def closed_reason(reason: Column, domain: tuple[str, ...], default: str = "unclassified") -> Column:
    """The reason if the domain has it, so no value of a row can leak through a diagnosis."""
    return F.when(reason.isin(*domain), reason).otherwise(default)


def failing_family(codes: Column, suffix: str = "_url_invalid") -> Column:
    """Which family of fields fails: its name where it is one, multiple, or other."""
    families = F.array_distinct(F.transform(F.filter(codes, lambda c: c.endswith(suffix)), lambda c: F.regexp_replace(c, f"{suffix}$", "")))
    return F.when(F.size(families) > 1, "multiple").when(F.size(families) == 1, F.element_at(families, 1)).when(F.size(codes) > 0, "other")


def blocked_plan(finalised: DataFrame, privacy: Column) -> DataFrame:
    """A source whose rows are never written: every row is persistence_blocked, allowed ones are on source hold."""
    return finalised.withColumns({"persistence": F.lit("persistence_blocked"), "source_hold": privacy == "allow"})


def shadowed(entries: DataFrame, discarded: DataFrame, digest: str) -> DataFrame:
    """Entries whose id is not among the discarded ones."""
    return entries.join(discarded.select(digest).distinct(), digest, "left_anti")


def expected_events(expected: DataFrame, events: DataFrame, key: str = "event_id") -> DataFrame:
    """Events that should be there and are not, and those that are there and should not."""
    a, b = expected.select(key).distinct().withColumn("l", F.lit(True)), events.select(key).distinct().withColumn("r", F.lit(True))
    return a.join(b, key, "full_outer").where("l is null or r is null").select(key, F.when(F.col("r").isNull(), "missing").otherwise("unexpected").alias("problem"))


