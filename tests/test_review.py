"""The review queue over runs: additions, removals, contradictions, expiry."""

import datetime as dt

from tidemark.streaming import incremental, review


def test_queue_over_runs(spark, tmp_path):
    seen: list = []

    def run(*rows):
        day = lambda k: dt.datetime(2024, 1, 1) + dt.timedelta(days=k)
        spark.createDataFrame([(k, e, None if d is None else day(d)) for k, e, d in rows], "id string, entry string, at timestamp").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = incremental.read_stream(spark, f"{tmp_path}/in", "id string, entry string, at timestamp")
        found = review.queue_changes(stream, "id", "entry", "at", dt.timedelta(days=30), "1 day")
        got: list = []
        incremental.run_available(found, f"{tmp_path}/c", lambda b, n: got.extend(tuple(r) for r in b.collect()))
        seen.append(sorted(got, key=repr))

    run(("a", "x", 1), ("a", "x", 1), ("b", "x", 1), ("c", "x", 1), ("c", "y", 1), (None, "x", 1), ("d", None, 1), ("e", "x", 1), ("f", "x", None))
    run(("a", "y", 20), ("b", None, 20), ("c", "x", 20), ("e", "x", 20), ("e", None, 20))
    run(("a", "y", 21), ("b", None, 21), ("b", "z", 21))
    assert seen == [
        [("a", "added", "x", None), ("b", "added", "x", None), ("c", "conflict", None, None), ("e", "added", "x", None)],
        [("a", "replaced", "y", "x"), ("b", "removed", None, "x"), ("c", "added", "x", None), ("e", "conflict", "x", "x")],
        [("b", "conflict", None, None)],
    ]
    run(("g", "x", 90))
    run(("h", "x", 91))
    expired = [r for run_ in seen[3:] for r in run_ if r[1] == "expired"]
    assert sorted(expired) == [("a", "expired", None, "y"), ("c", "expired", None, "x"), ("e", "expired", None, "x")]
