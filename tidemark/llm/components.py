"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import staged

#: Rounds after which something must be wrong; each round at least halves the longest chain.
MOST_ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link each node's larger (or not larger) neighbours to the least node around it."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    linked = both.join(least, "a")
    if large:
        return linked.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
    return linked.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and component (the least node reachable) of every node in an edge.

    Loops and repeated edges change nothing; edges with a null end are ignored; no edges give an empty table. Each
    round is written to the shared folder, so lost executors repeat one round at most.
    """
    now = staged(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null and a <> b").distinct(), "edges")
    sign = None
    for _ in range(MOST_ROUNDS):
        now = staged(_star(_star(now, True), False), "stars")
        new = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if new == sign:
            break
        sign = new
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
