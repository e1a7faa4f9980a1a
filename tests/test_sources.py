import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import audit
from tidemark.operators.staging import staged
from tidemark.sources import tables, trees
from tidemark.streaming import incremental


def test_summary_tree(spark):
    item = lambda k: {"id": k, "title": f"t {k}", "url": None}
    day = {"number": "7", "sections": [{"code": "1", "departments": [{"code": "D", "name": "N", "items": [item("a")], "headings": [{"name": "H", "items": [item("b"), item("c")]}]}, {"code": "E", "name": "N"}]}]}
    df = spark.createDataFrame([(json.dumps(day),), ("{",), (None,)], "j string")
    got = trees.summary_items(df, "j").orderBy("section_at", "department_at", "item_at").select("number", "section", "department", "heading", "id").collect()
    assert [tuple(r) for r in got] == [("7", "1", "D", None, "a"), ("7", "1", "D", "H", "b"), ("7", "1", "D", "H", "c")]


def test_page_contract(spark):
    page = {"content": [{"id": 1}], "pageNumber": 0, "totalPages": 2, "totalElements": 3, "first": True, "last": True}
    df = spark.createDataFrame([(json.dumps(page),)], "j string").select(F.from_json("j", trees.PAGE).alias("p"))
    assert df.select(trees.page_violations(df["p"], F.lit(1))).first()[0] == ["number", "last"]


def test_feed(spark, tmp_path):
    entry = "<entry><id>{}</id><updated>{}</updated><title>{}</title></entry>"
    body = entry.format("a", "2024-03-31T01:30:00+01:00", "old") + entry.format("a", "2024-03-31T03:10:00+02:00", "new") + entry.format("b", "2024-01-01T00:00:00Z", "x") + entry.format("b", "2024-01-01T01:00:00+01:00", "y")
    (tmp_path / "page.xml").write_text(f"<feed>{body}</feed>")
    latest, conflicts = trees.latest_entries(trees.read_feed(spark, str(tmp_path / "page.xml")))
    assert [(r["id"], r["title"]) for r in latest.collect()] == [("a", "new")]
    assert rows(conflicts) == [("b",)]
    (tmp_path / "bad.xml").write_text("<!DOCTYPE feed><feed/>")
    with pytest.raises(ValueError):
        trees.read_feed(spark, str(tmp_path / "bad.xml"))


def test_html_links(spark):
    html = "<h1>Top</h1><h2>Sub <b>x</b></h2><a href='/1'>one</a><h2>Next</h2><script>'<a href=z>'</script><a href='/2'>two &amp; half</a>"
    df = spark.createDataFrame([(1, html), (2, None), (3, "<a>no</a><p")], "id int, h string")
    assert rows(trees.html_links(df, "id", "h")) == [(1, 0, "one", "/1", ["Top", "Sub x"]), (1, 1, "two & half", "/2", ["Top", "Next"])]


def test_keyed_table(spark, tmp_path):
    table = tables.KeyedTable(f"file://{tmp_path}/t", "id string, v string, seen int", "id", parts=4)
    frame = lambda *r: spark.createDataFrame(list(r), "id string, v string, seen int")
    table.create(spark)
    table.create(spark)
    assert table.read(spark).count() == 0 and table.get(spark, "a").count() == 0
    assert rows(table.append(frame(("a", "1", 1), ("c", "1", 1)), ("seen",))) == []
    assert rows(table.append(frame(("a", "1", 2), ("b", "1", 2), ("b", "1", 3)), ("seen",))) == []  # a is there, but for when it was seen
    assert [r["v"] for r in table.read(spark).collect()] == ["1"] * 3
    assert rows(table.append(frame(("a", "2", 2), ("d", "1", 2), ("d", "2", 2), (None, "x", 1)))) == [("a", "other_content"), ("d", "rows_differ"), (None, "key_missing")]
    assert table.read(spark).count() == 3  # nothing of a batch that contradicts is written
    assert rows(table.merge(frame(("a", "3", 3), ("e", "1", 3)))) == [] and rows(table.get(spark, "a")) == [("a", "3", 3)]
    assert rows(table.merge(frame(("a", "4", 4), ("a", "5", 4), ("f", None, 4)), gates={"no_value": F.col("v").isNotNull()})) == [("a", "key_repeated"), ("f", "no_value")]
    gone = lambda: table.read(spark).select("id", "v", "seen", F.lit(True).alias("gone"))
    assert rows(table.problems(spark, F.col("v") != "1")) == [("b", "row_invalid"), ("c", "row_invalid"), ("e", "row_invalid")]
    assert rows(table.merge(gone().where("id <> 'b'"), "gone")) == [] and [r["id"] for r in table.read(spark).collect()] == ["b"]
    assert rows(table.merge(gone(), "gone")) == [] and table.read(spark).count() == 0
    assert rows(table.append(frame(("a", "9", 9)))) == [] and rows(table.read(spark)) == [("a", "9", 9)]


def test_second_phase_asks_again(spark, tmp_path):
    table = tables.KeyedTable(f"file://{tmp_path}/t", "record_id string, content_hash string, plan string", "record_id", parts=2)
    table.create(spark)
    table.append(spark.createDataFrame([("a", "1", ""), ("b", "1", "")], "record_id string, content_hash string, plan string"))
    candidates = spark.createDataFrame([("a", "2", "allow"), ("b", "1", "allow"), ("c", "1", "allow"), ("d", "1", "quarantine"), ("e", "1", "allow")], "record_id string, content_hash string, privacy string")
    approved = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "record_id string")
    plan = staged(audit.publication_plan(candidates, table.read(spark), approved), "plan")
    before = rows(table.read(spark))
    spoilt = {
        "content_changed": (candidates.withColumn("content_hash", F.when(F.col("record_id") == "c", "9").otherwise(F.col("content_hash"))), approved),
        "privacy_not_allowed": (candidates.withColumn("privacy", F.when(F.col("record_id") == "c", "reject").otherwise(F.col("privacy"))), approved),
        "not_approved": (candidates, approved.where("record_id <> 'c'")), "candidate_not_unique": (candidates.union(candidates.where("record_id = 'c'")), approved),
    }
    for code, (now, listed) in spoilt.items():
        assert rows(audit.publish(plan, now, listed, table)) == [("c", code)] and rows(table.read(spark)) == before
    assert rows(audit.publish(plan, candidates, approved, table)) == []
    assert rows(table.read(spark)) == [("a", "2", "update"), ("b", "1", ""), ("c", "1", "create")]
    assert ("c", "table_changed") in rows(audit.publish(plan, candidates, approved, table))  # not twice


def test_streams(spark, tmp_path):
    frame = lambda *r: spark.createDataFrame(list(r), "id string, v string, at timestamp")
    import datetime as dt

    day = lambda k: dt.datetime(2024, 1, k)
    frame(("a", "1", day(1)), ("a", "1", day(2)), ("b", "1", day(2))).coalesce(1).write.parquet(f"{tmp_path}/in", mode="append")
    schema = "id string, v string, at timestamp"
    events: list = []

    def run():
        stream = incremental.read_stream(spark, f"{tmp_path}/in", schema)
        found = incremental.state_changes(stream, "id", "v", "at")
        incremental.run_available(found, f"{tmp_path}/c1", lambda b, n: events.extend(tuple(r) for r in b.collect()))
        seen = incremental.deduplicated(incremental.read_stream(spark, f"{tmp_path}/in", schema), ["id"], "at")
        incremental.run_available(seen, f"{tmp_path}/c2", incremental.append_once(f"{tmp_path}/out", "id"))

    run()
    frame(("a", "2", day(3)), ("b", "1", day(3))).coalesce(1).write.parquet(f"{tmp_path}/in", mode="append")
    run()
    assert sorted(events) == [("a", "create", None, "1", 1), ("a", "update", "1", "2", 2), ("b", "create", None, "1", 1)]
    assert sorted(r["id"] for r in spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_path}/out").collect()) == ["a", "b"]
