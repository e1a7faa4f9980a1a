"""Counters of runs, their invariants, the health of sources and where the next window begins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

FAILING = 3


def counters(df: DataFrame, by: list[Column], conditions: dict[str, Column]) -> DataFrame:
    """How many rows of each group meet each condition, in one pass."""
    return df.groupBy(*by).agg(F.count("*").alias("seen"), *(F.count_if(c).alias(k) for k, c in conditions.items()))


def counted_write(df: DataFrame, conditions: dict[str, Column], write: Callable[[DataFrame], object] | None = None) -> dict[str, int]:
    """Writes ``df`` and tells how many rows met each condition, counted by the pass that writes; ``seen`` is all of them.

    Without ``write`` it is a dry run: the same plan to a sink that keeps nothing. Counters of several batches are added
    up by ``added``.
    """
    told = Observation()
    watched = df.observe(told, F.count(F.lit(1)).alias("seen"), *(F.count_if(c).alias(k) for k, c in conditions.items()))
    if write is None:
        watched.write.format("noop").mode("overwrite").save()
    else:
        write(watched)
    return dict(told.get)


def added(*batches: dict[str, int]) -> dict[str, int]:
    """The counters of all batches together; one that a batch doesn't have counts as 0 there."""
    return {k: sum(b.get(k, 0) for b in batches) for k in dict.fromkeys(k for b in batches for k in b)}


def broken_invariants(df: DataFrame, checks: dict[str, str]) -> Column:
    """Names of the checks (SQL conditions) a row of counters fails."""
    return F.array_compact(F.array(*(F.when(~F.coalesce(F.expr(c), F.lit(False)), F.lit(k)) for k, c in checks.items())))


MANIFEST_CHECKS = {
    "seen": "seen = included + excluded",
    "privacy": "included = privacy_allowed + privacy_held",
    "publication": "privacy_allowed = approved + held",
    "operations": "approved = created + updated + unchanged",
}


def source_health(runs: DataFrame, source: str, finished: str, run_id: str, status: Column, error: Column) -> DataFrame:
    """One row for each source: latest status, failures since the last run that didn't fail, last success, last error.

    status is success, no_publication, partial or failed. Two aggregations, no sort of a source's runs: first the
    last run that didn't fail, then the failures after it.
    """
    rows = runs.select(F.col(source), F.struct(finished, run_id).alias("k"), status.alias("status"), error.alias("error"))
    marks = rows.groupBy(source).agg(
        F.max_by("status", "k").alias("latest"), F.max(F.when(F.col("status") != "failed", F.col("k"))).alias("sound"),
        F.max(F.when(F.col("status").isin("success", "no_publication"), F.col(f"k.{finished}"))).alias("last_success"),
        F.max_by("error", F.when(F.col("error").isNotNull(), F.col("k"))).alias("last_error"),
    )
    late = rows.where("status = 'failed'").join(marks.select(source, "sound"), source).where("sound is null or k > sound").groupBy(source).agg(F.count("*").alias("failures"))
    health = F.when(F.col("latest").isin("success", "no_publication"), "healthy").when(F.coalesce("failures", F.lit(0)) >= FAILING, "failing").otherwise("degraded")
    return marks.join(late, source, "left").select(source, health.alias("health"), F.col("latest").alias("latest_status"), F.coalesce("failures", F.lit(0)).alias("failures"), "last_success", "last_error")


def checkpoint_window(runs: DataFrame, by: list[str], until: Column, completed: Column, order: list[str], overlap_days: int) -> DataFrame:
    """Where each group's next window starts: the end of its latest completed window less the overlap."""
    done = runs.where(completed).select(*by, F.struct(until.alias("until"), *order).alias("k"))
    return done.groupBy(*by).agg(F.max("k").alias("k")).select(*by, F.col("k.until").alias("completed_until"), F.date_sub("k.until", overlap_days).alias("next_from"))


def ordinals(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """``df`` with ordinal: the place of each row in its group."""
    return df.withColumn("ordinal", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
