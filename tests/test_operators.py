import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import canon
from tidemark.operators import audit, catalog, change, gates, identity, match, normalize, policy, runs, search, views
from tidemark.operators.change import ChangeSpec, reconcile
from tidemark.plans.queries import QUERIES

STATE = "id string, status string, content_hash string"


def changes(spark, previous, observed, run="complete"):
    p, o = spark.createDataFrame(previous, STATE), spark.createDataFrame(observed, STATE)
    return {r["id"]: (r["event"], r["result_status"], r["content_hash"]) for r in reconcile(p, o, "id", run).collect()}


def test_reconcile_complete(spark):
    previous = [("a", "active", "1"), ("b", "active", "1"), ("c", "active", "1"), ("d", "missing_from_source", "1"), ("e", "missing_from_source", "1"), ("f", "quarantine", "1"), ("g", "withdrawn", "1")]
    observed = [("a", "active", "1"), ("b", "active", "2"), ("d", "active", "1"), ("f", "active", "2"), ("n", "active", "9")]
    assert changes(spark, previous, observed) == {
        "a": (None, "active", "1"), "b": ("update", "active", "2"), "c": ("missing_from_source", "missing_from_source", "1"),
        "d": ("reappeared", "active", "1"), "e": (None, "missing_from_source", "1"), "f": ("update", "quarantine", "2"),
        "g": (None, "withdrawn", "1"), "n": ("create", "active", "9"),
    }


def test_reconcile_other_runs(spark):
    previous = [("a", "active", "1"), ("b", "active", "1")]
    assert changes(spark, previous, [("a", "active", "2")], "partial")["b"] == (None, "active", "1")
    assert changes(spark, previous, [], "failed") == {"a": (None, "active", "1"), "b": (None, "active", "1")}
    with pytest.raises(ValueError):
        changes(spark, previous, [], "odd")


def test_reconcile_twice_changes_nothing(spark):
    observed = [("a", "active", "2"), ("n", "active", "9")]
    first = changes(spark, [("a", "active", "1"), ("b", "active", "1")], observed)
    again = changes(spark, [(k, s, h) for k, (_, s, h) in first.items()], observed)
    assert all(event is None for event, _, _ in again.values())


def test_dedupe(spark):
    spec = ChangeSpec("id", {"v": "v"})
    df = spark.createDataFrame([("a", "1", 1, "active"), ("a", "1", 2, "active"), ("b", "1", 1, "active"), ("b", "2", 2, "active"), ("c", None, 1, "active")], "id string, v string, observed_at int, status string")
    kept, conflicts = change.dedupe(df, spec)
    assert [(r["id"], r["observed_at"]) for r in kept.orderBy("id").collect()] == [("a", 2), ("c", 1)]
    assert rows(conflicts) == [("b",)]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.permutations([("a", 1, "x"), ("b", 2, "y"), ("c", 3, None)]))
def test_population_hash_has_no_order(spark, order):
    hashed = lambda r: rows(identity.population_hash(spark.createDataFrame(r, "k string, n int, v string"), [], F.col("k"), F.to_json(F.struct("n", "v"))))
    assert hashed(order) == hashed([("a", 1, "x"), ("b", 2, "y"), ("c", 3, None)])


def test_identity_strategies(spark):
    df = spark.createDataFrame([("A-1", "C", "http://a.example/"), (" ", "C 2", None), (None, None, "http://a.example/x"), (None, "", None)], "o string, c string, u string")
    got = identity.identify(df, F.lit("My Source"), official_id=F.col("o"), case_number=F.col("c"), url=F.col("u"), fingerprint=[F.col("c")]).collect()
    assert [r["identity_strategy"] for r in got] == ["official_id", "case_number", "canonical_url", "composite_fingerprint"]
    assert got[0]["record_id"].startswith("rec:my-source:a-1-") and len({r["record_id"] for r in got}) == 4


def test_diff_and_loss(spark):
    a = spark.createDataFrame([(1, "x", None), (2, "y", "z")], "id int, p string, q string")
    b = spark.createDataFrame([(1, "x", "n"), (2, "w", "z")], "id int, p string, q string")
    assert rows(change.diff_paths(a, b, "id", ["p", "q"])) == [(1, "q", None, "n"), (2, "p", "y", "w")]
    m = spark.createDataFrame([({"a": "1"}, {"a": "2"}), ({"a": "1"}, {}), ({"a": "1"}, {"a": " "}), ({"a": ""}, {})], "p map<string,string>, c map<string,string>")
    assert [r[0] for r in m.select(change.loses_information(F.col("p"), F.col("c"))).collect()] == [False, True, True, False]


def test_history(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "a"), ("b", "c"), ("c", "d")], "x string, y string")
    roots = spark.createDataFrame([("a",)], "r string")
    assert rows(change.reachable(edges, "x", "y", roots, "r", 2)) == [("a", 0), ("b", 1), ("c", 2)]
    assert change.reachable(edges, "x", "y", roots, "r", 9).count() == 4


def test_health(spark):
    df = spark.createDataFrame([("a", 1, 1, "success", None), ("a", 2, 2, "failed", "e1"), ("a", 3, 3, "failed", "e2"), ("a", 4, 4, "failed", "e3"), ("b", 1, 5, "failed", "e"), ("b", 2, 6, "success", None), ("c", 1, 7, "partial", None)], "s string, f int, r int, st string, e string")
    assert rows(runs.source_health(df, "s", "f", "r", F.col("st"), F.col("e"))) == [("a", "failing", "failed", 3, 1, "e3"), ("b", "healthy", "success", 0, 2, "e"), ("c", "degraded", "partial", 0, None, None)]


def test_privacy(spark):
    texts = ["plain", "write to x@gmail.com", "x@council.example", "Teléfono particular: 612 345 678", "Tel: 612 345 678", "id 12345678Z here", "ES91 2100 0418 4502 0005 1332", "domicilio particular: calle Mayor 12", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = gates.privacy_decision(df, {"title": F.col("t")}).collect()
    assert [r["privacy_reasons"] for r in got] == [[], ["consumer_email:title"], [], ["contextual_phone:title"], [], ["personal_identifier:title"], ["bank_account:title"], ["private_address:title"], []]
    assert [r["privacy"] for r in got].count("allow") == 4
    with pytest.raises(ValueError):
        gates.PrivacyRules(mail_domains=())


def test_url_verdicts(spark):
    given_ = ["https://a.example.com/x", "http://a.example.com", "https://evil.com", "https://u:p@a.example.com", "https://10.0.0.1/", "https://a.example.com/%zz", "https://a.example.com/a b", "", None, "https://a%40b@c.example.com/"]
    df = spark.createDataFrame([(u,) for u in given_], "u string")
    got = [r[0] for r in df.select(gates.url_verdict(F.col("u"), ("example.com",))).collect()]
    assert got == ["ok", "scheme", "host", "credentials", "address", "percent", "control", "blank", "blank", "credentials"]


def test_dictionary(spark, monkeypatch):
    texts = spark.createDataFrame([(1, "New York and York, new"), (2, "Yorkshire"), (3, None)], "id int, t string")
    names = spark.createDataFrame([("Y", "York"), ("NY", "New York"), ("N", "new")], "c string, n string")
    assert rows(match.dictionary_match(texts, "id", F.col("t"), names, "c", F.col("n"))) == [(1, "N", 1), (1, "NY", 1), (1, "Y", 1)]
    monkeypatch.setattr(match, "MOST_NAMES", 1)
    assert rows(match.dictionary_match(texts, "id", F.col("t"), names, "c", F.col("n"))) == [(1, "N", 1), (1, "NY", 1), (1, "Y", 1)]
    assert match.dictionary_match(texts, "id", F.col("t"), names.limit(0), "c", F.col("n")).count() == 0


def test_dictionary_means_the_same_at_every_size(spark, monkeypatch):
    said = ["New York and York, new", "new, york new  york", "o'neil's O'Neil neil", "a b c d b c", "'tis x'tis 'tis1", "new york city york\nnew york state", "c++ c+ c", "Ünal ünal-x straße", "", None, "a b c d b c"]
    texts = spark.createDataFrame([*enumerate(said), (0, "york")], "id int, t string")
    listed = ["York", "New York", "new", "new york city", "o'neil", "neil", "a b c", "b c", "c d b", "'tis", "c++", "c", "ünal", "straße", "York", ""]
    names = spark.createDataFrame([(f"{n}/{k}", n) for k, n in enumerate(listed)], "c string, n string")
    small = rows(match.dictionary_match(texts, "id", F.col("t"), names, "c", F.col("n")))
    assert (5, "new york city/3", 1) in small and (0, "York/0", 2) in small and (0, "York/14", 2) in small and (3, "b c/7", 1) in small
    monkeypatch.setattr(match, "MOST_NAMES", 1)
    assert rows(match.dictionary_match(texts, "id", F.col("t"), names, "c", F.col("n"))) == small


def test_views(spark):
    df = spark.createDataFrame([("a", "x", 1), ("b", None, 2), ("b", "x", 3)], "k string, v string, n int")
    assert rows(views.matching(df, {"k": "b", "v": None})) == [("b", "x", 3), ("b", None, 2)]
    assert rows(views.facets(df, {"v": F.col("v")})) == [("v", "none", 1), ("v", "x", 2)]
    assert rows(views.grouped(df, F.col("k"))) == [("a", 1, 50), ("b", 2, 100)]
    counts = df.groupBy("k").agg(F.count("*").alias("n"))
    known = spark.createDataFrame([("a",), ("z",)], "k string")
    assert rows(views.coverage(known, counts, "k")) == [("a", 1, True), ("b", 2, False), ("z", 0, True)]


def test_search(spark):
    df = spark.createDataFrame([(1, "Ayuda ayuda", "Ayuda  ayuda"), (2, "otra", "cosa ayuda")], "id int, t string, b string")
    whole = search.corpus(df, "id", {"title": (F.col("t"), 3), "body": (F.col("b"), 1)})
    assert [tuple(r) for r in whole.orderBy("id", "label").collect()] == [(1, "title", "Ayuda ayuda", 3), (2, "body", "cosa ayuda", 1), (2, "title", "otra", 3)]
    index = search.postings(whole, "id", F.col("text"), F.col("weight"), folded=True)
    assert rows(search.search(index, "id", ["ayuda"])) == [(1, 6), (2, 1)]
    assert rows(search.search(index, "id", ["ayuda", "otra"])) == [(2, 4)]


def test_term_statistics_of_all_documents(spark, tmp_path):
    docs = [(1, "The the Haus", "en"), (2, "das Haus, the", "de"), (3, None, "en"), (4, "", "fr"), (5, "été the_1 Été", None)]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["term"]: (r["documents"], r["weight"]) for r in QUERIES["term_statistics"](spark, str(tmp_path)).collect()}
    assert got == {"the": (2, 3), "haus": (2, 2), "das": (1, 1), "été": (1, 2), "the_1": (1, 1)}


def test_privacy_rules_take_stated_addresses_and_grouped_ids(spark):
    texts = ["calle Mayor, 12", "Dirección de uso personal: Mayor 3, bajo", "12.345.678-Z", "X-1234567-L", "12345678A", "2026-09-23 y 964 123 456", "(ann@proton.me)", "x@mail.proton.me"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r["privacy_reasons"] for r in gates.privacy_decision(df, {"title": F.col("t")}).collect()]
    assert got == [[], ["private_address:title"], ["personal_identifier:title"], ["personal_identifier:title"], [], [], ["consumer_email:title"], []]
    tax = [r["privacy_reasons"] for r in gates.privacy_decision(df, {"tax_identifier": F.col("t")}).collect()]
    assert tax[2] == ["personal_identifier:tax_identifier"] and tax[4] == ["ambiguous_tax_identifier:tax_identifier"]
    long = spark.createDataFrame([("a." * 200_000,)], "t string")  # no quadratic search
    assert gates.privacy_decision(long, {"title": F.col("t")}).first()["privacy"] == "allow"


def test_history_that_returns(spark):
    steps = [(1, "create", None, "a"), (2, "update", "a", "b"), (3, "update", "b", "a"), (4, "update", "b", "c")]
    events = spark.createDataFrame([("r", *s) for s in steps] + [("q", *s) for s in steps[:2]] + [("z", *steps[0])], "record_id string, observed_at int, type string, previous_hash string, content_hash string")
    known = spark.createDataFrame([("r", "c"), ("q", "a")], "record_id string, content_hash string")
    assert rows(audit.validate_history(events, known)) == [("q", "tip_mismatch"), ("z", "event_without_record")]
    assert audit.validate_history(events.limit(0), known).count() == 0


def test_nested_changes(spark):
    kind = "id int, body struct<a: struct<b: int, c: string>, l: array<struct<cve: string, t: string>>, m: struct<n: string>>"
    a = spark.createDataFrame([(1, ((1, "x"), [("k", "t")], None)), (2, ((1, None), [], ("y",)))], kind)
    b = spark.createDataFrame([(1, ((2, "x"), [("k", None)], ("z",))), (2, (None, [("q", "r")], ("y",)))], kind)
    assert rows(change.diff_nested(a, b, "id", "body")) == [(1, "a.b", "1", "2"), (1, "l", '[{"cve":"k","t":"t"}]', '[{"cve":"k"}]'), (1, "m", None, '{"n":"z"}'), (2, "a", '{"b":1}', None), (2, "l", "[]", '[{"cve":"q","t":"r"}]')]
    both = a.join(b.withColumnRenamed("body", "now"), "id")
    assert rows(both.select("id", change.loses_nested(F.col("body"), F.col("now"), a.schema["body"].dataType))) == [(1, True), (2, True)]
    same = a.select("id", change.loses_nested(F.col("body"), F.col("body"), a.schema["body"].dataType))
    assert rows(same) == [(1, False), (2, False)]


def test_policies_refuse_what_contradicts_itself():
    rule = policy.PublicationRule("r-1", True, "1", "x", ("d",), ("title",), reasons_any=("m",), title_any=("t",))
    with pytest.raises(ValueError):
        policy.PublicationPolicy("p", True, None, (rule,))
    with pytest.raises(ValueError):
        policy.PublicationPolicy("p", False, None, (rule,))
    with pytest.raises(ValueError):
        policy.PublicationPolicy("p", True, "today", (rule,), ("1",))
    with pytest.raises(ValueError):
        policy.PublicationRule("r-1", True, "1", "x", ("d",), ("title",), title_any=("t",))


def test_contained_spans(spark):
    import random

    rng = random.Random(5)
    spans = [(rng.choice("ab"), s := rng.randrange(40), s + rng.randrange(9)) for _ in range(200)]
    inside = {x for x in spans if any(y[0] == x[0] and y[1] <= x[1] and x[2] <= y[2] and y[2] - y[1] > x[2] - x[1] for y in spans)}
    assert {tuple(r) for r in match.contained(spark.createDataFrame(spans, "g string, start int, end int"), "g", 8).collect()} == inside


def test_links_and_displays(spark):
    df = spark.createDataFrame([("www.town.example",), (" x.example",), ("ftp://x.example",), ("https://u@x.example",), ("https://x",), ("https://x.example:0/",), ("",), (None,)], "u string")
    got = [(r[0]["transform"], r[0]["reason"]) for r in df.select(catalog.checked_link(F.col("u"))).collect()]
    assert got == [("prefix_https_scheme", None), ("rejected", "whitespace_or_control_characters"), ("rejected", "scheme_not_allowed"), ("rejected", "userinfo_not_allowed"), ("rejected", "invalid_host"), ("rejected", "invalid_port"), ("absent", None), ("absent", None)]
    at = spark.createDataFrame([("2024-05-03T10:00:00Z",), ("2024-02-30T10:00:00Z",), ("2024-05-03",), (None,)], "t string")
    assert [r[0] for r in at.select(canon.instant_display(F.col("t"))).collect()] == ["3 de mayo de 2024, 12:00", "2024-02-30T10:00:00Z", "2024-05-03", "No disponible"]
    names = spark.createDataFrame([("a.b/c d",)], "n string")
    assert names.select(canon.safe_name(F.col("n"))).first()[0] == "a%2Eb%2Fc%20d"
    base = F.lit("https://h.example/a/b.html")
    assert [spark.range(1).select(canon.joined_url(base, F.lit(u))).first()[0] for u in ("c", "/c", "//x.example/c", "http://y")] == ["https://h.example/a/c", "https://h.example/c", "https://x.example/c", "http://y"]


def test_excerpts_fold_and_keep_words(spark):
    text = "word " * 100 + "Oposición local " + "tail " * 100
    df = spark.createDataFrame([(text,), ("short oposicion",), ("none",), (None,)], "t string")
    got = [r[0] for r in df.select(search.excerpt(F.col("t"), "oposición")).collect()]
    assert got[0].startswith("…word") and got[0].endswith("tail…") and "Oposición" in got[0] and len(got[0]) <= 242 and got[1:] == ["short oposicion", None, None]


def test_public_sources_have_no_cap(spark):
    sources = spark.range(20_000).select(F.col("id").cast("string").alias("source_id"), F.lit(True).alias("public_records"))
    assert views.public_only(sources.select("source_id"), sources).count() == 20_000


def test_headings_whatever_the_partitions(spark):
    heads = [["Consorcio Provincial", "Ayuntamiento  de Oropesa", "ANUNCIOS"], ["Oropesa"], ["Otros"], None, [], ["Diputación Provincial de Castellón", None], ["Ayuntamiento de Nules"]] * 30
    df = spark.createDataFrame([(k, h, "x") for k, h in enumerate(heads)], "id int, heading_path array<string>, heading string")
    registry = spark.createDataFrame([("12085", "Oropesa")], "code string, name string")
    got = [rows(normalize.heading_authority(x, "heading_path", registry).select("id", "authority.id", "heading")) for x in (df.coalesce(1), df.repartition(7, F.rand()), df.orderBy(F.rand()))]
    assert got[0] == got[1] == got[2] and len(got[0]) == len(heads)
    assert [r[1] for r in sorted(got[0])[:4]] == ["bop-castellon:municipality:12085"] * 2 + [None] * 2


def test_company_letters(spark):
    ids = [f"{c}1234567{x}" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" for x in "D4"]
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    told = dict(df.select("id", canon.tax_class(F.col("id"))).collect())
    assert not [i for i in ids if i[0] in "IKLMOTXYZ" and told[i] == "legal_entity_tax_identifier"]
    assert told["K1234567D"] == told["L1234567D"] == "ambiguous_tax_identifier" or told["K1234567D"] == "personal_identifier"


def test_registry_names_are_folded(spark):
    registry = spark.createDataFrame([("12001", "Vinaròs"), ("12002", " VINAROS "), ("12003", "Nules"), ("12003", "Nules")], "code string, name string")
    assert rows(catalog.registry_violations(registry)) == [("12001", "name_ambiguous"), ("12003", "code_duplicated")]


def test_audits_of_larger_tables_have_more_tasks(spark, monkeypatch, capsys):
    from pyspark.sql import functions as F

    from tidemark.operators import audit

    monkeypatch.setattr(audit, "TASK_ROWS", 10)
    k = spark.range(300).select(F.col("id").alias("record_id"))
    events = k.select("record_id", F.lit(1).alias("observed_at"), F.lit("create").alias("type"), F.lit(None).cast("string").alias("previous_hash"), F.lit("a").alias("content_hash"))
    history = audit.validate_history(events, k.withColumn("content_hash", F.lit("a")))
    one = k.select("record_id", F.lit(1).alias("version"), F.lit("s").alias("source"), F.lit("d").alias("detected_at"), F.lit("x").alias("content_hash"))
    two = one.withColumns({"version": F.lit(2), "content_hash": F.lit("y"), "v1_hash": F.lit("x")})
    migration = audit.validate_migration(one, two, k.select("record_id", F.lit("x").alias("from_hash"), F.lit("y").alias("to_hash")))
    for found in (history, migration):
        found.explain()
        assert "hashpartitioning(record_id" in (plan := capsys.readouterr().out) and ", 30), REPARTITION_BY_NUM" in plan
        assert found.count() == 0
