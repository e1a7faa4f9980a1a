"""Cases that the first tests leave out: shared and missing keys, blocks, windows, brute-force versions of scores."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_llm_operators import DOCS, SMALL, WORD, contamination, texts, words

import corpus_pipeline
from tidemark.llm import decontamination, embeddings, language, privacy, suffixes, toxicity
from tidemark.llm.queries import op3_warc
from tidemark.llm.shared import join_hot, sieve, sifted

TABLES = "/root/testdata/sf0.01"


def test_join_hot_is_a_left_join(spark):
    left = spark.createDataFrame([("a", k) for k in range(3000)] + [("b", 1), ("c", 2), (None, 3)], "k string, n int")
    right = spark.createDataFrame([("a", 3000, "x"), ("b", 1, "y"), ("z", 0, "q")], "k string, c bigint, v string")
    got = join_hot(left, right, "k", "c", left.count())
    assert rows(got) == rows(left.join(right, "k", "left")) and got.columns == ["k", "n", "c", "v"]


def test_sieve_never_misses(spark):
    ids = list(range(0, 9000, 3))
    bits = sieve(spark.createDataFrame([(k,) for k in ids], "id bigint"))
    assert sifted(np.array(ids), bits).all() and sifted(np.arange(100_001, 130_001), bits).mean() < 0.1
    assert not sifted(np.arange(50), sieve(spark.createDataFrame([], "id bigint"))).any()


def test_embeddings_that_share_a_key(spark):
    made = [(5, [1.0, 0.0]), (5, [0.0, 1.0]), (3, [0.999, 0.01]), (9, [0.01, 0.999]), (7, [-1.0, 0.0]), (9, None), (7, [-1.0, 0.0])]
    got = rows(embeddings.near_duplicates(spark.createDataFrame(made, "vec_id bigint, embedding array<double>")))
    assert got == sorted([(3, 1, 3, True), (5, 1, 3, False), (5, 1, 3, False), (7, 1, 7, True), (7, 1, 7, True), (9, 0, 3, False), (9, 1, 3, False)], key=repr)


def test_dual_traversal_of_dense_and_sparse_points():
    rng = np.random.default_rng(4)
    x = np.concatenate((rng.normal(size=(60, 5)), np.ones((80, 5)) + rng.normal(size=(80, 5)) * 0.05))
    side = embeddings.Side(np.arange(len(x)), rng.integers(1, 4, len(x)).astype(float), x, embeddings.cover_tree(embeddings.units(list(x))))
    cosine = (x @ x.T) / np.sqrt((x * x).sum(1))[:, None] / np.sqrt((x * x).sum(1))[None, :]
    near = cosine >= 0.95
    np.fill_diagonal(near, False)
    count, ends, roots = embeddings.dual_traversal(side, None)
    assert (count == near @ side.weights).all()
    want = embeddings.connected(len(x), *np.nonzero(near))
    assert (embeddings.connected(len(x), ends, roots) == want).all()
    a, b = (embeddings.Side(np.arange(len(x))[s], side.weights[s], x[s], embeddings.cover_tree(embeddings.units(list(x[s])))) for s in (slice(0, 90), slice(90, None)))
    count, _, _ = embeddings.dual_traversal(a, b)
    assert (count == np.concatenate((near[:90, 90:] @ b.weights, near[90:, :90] @ a.weights))).all()


def test_warc_keys(spark, tmp_path):
    long = "é<p>" * 60
    made = [(None, "u", long), (-1, "u", long), (4, "u", long), (-1, "u", "b" * 200), (None, "u", "c" * 200), (7, None, None), (7, None, None)]
    spark.createDataFrame(made, "page_id bigint, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted(((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in op3_warc(spark, str(tmp_path)).collect()), key=repr)
    assert got == sorted([(None, "revisit", -1, 300), (-1, "response", None, 300), (4, "revisit", -1, 300), (-1, "response", None, 200), (None, "response", None, 200), (7, "response", None, 0), (7, "response", None, 0)], key=repr)


def test_anchors_of_windows_are_those_of_the_whole(monkeypatch):
    rng = np.random.default_rng(7)
    data = rng.integers(97, 100, 9000).astype(np.uint8)
    bounds = np.array([0, 3000, 3010, 9000])
    whole = suffixes._anchored(data, bounds, 60, 24)
    monkeypatch.setattr(suffixes, "STEP_BYTES", 500)
    parts = suffixes._anchored(data, bounds, 60, 24)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()


# toxicity ------------------------------------------------------------------------------------------------------


def _machine(words_):
    machine = toxicity.Machine(np.zeros(toxicity.SYMBOLS**3, np.float32), -0.4, (-1.0, 2.0, 0.5, 0.7))
    for w, s in words_:
        machine.weights += np.float32(s) * toxicity.feature(w).astype(np.float32)
    return machine


def test_scores_equal_plain_sums_over_subsequences():
    machine = _machine([("@IDIOT@", 1.5), ("@HOUSE@", -0.5)])
    kernel = {}
    for w, s in (("@IDIOT@", 1.5), ("@HOUSE@", -0.5)):
        for i in range(len(w)):
            for j in range(i + 1, len(w)):
                for k in range(j + 1, min(len(w), i + toxicity.STRETCH + 1)):
                    key = w[i] + w[j] + w[k]
                    kernel[key] = kernel.get(key, 0.0) + s * toxicity.DECAY ** (k - i + 1) / toxicity._norms(len(w))[len(w)]

    def margin(word):
        w = "@" + "".join(c.upper() for c in word if c.isalpha()) + "@"
        total = sum(kernel.get(w[i] + w[j] + w[k], 0.0) * toxicity.DECAY ** (k - i + 1) for i in range(len(w)) for j in range(i + 1, len(w)) for k in range(j + 1, min(len(w), i + toxicity.STRETCH + 1)))
        return total / toxicity._norms(len(w))[len(w)] - 0.4

    docs = ["an idiot in the house", "id-iot i d i o t", "", None, "house", "plain words of no interest", "idxiot idiots Idiot"]
    for text, got in zip(docs, machine.score(pa.array(docs, pa.string()))):
        said = re.sub(r"\b(\w) (?=\w\b)", r"\1", text or "").split()
        units_ = said + [p for w in said for p in re.findall("[a-z]{3,}", w.lower()) if p != w.lower() and re.search("[^a-zA-Z]", w)]
        values = [margin(w) for w in units_]
        top = min(max([-2.0, *values]), 4.0)
        z = -1.0 + 2.0 * top + 0.5 * math.log1p(sum(v > 0 for v in values)) + 0.7 * math.log1p(sum(v > 0.5 for v in values))
        assert got == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-5), text


def test_long_words_are_scored_by_pieces():
    machine = _machine([("@IDIOT@", 3.0)])
    hidden = ["x" * 40 + "idiot" + "y" * 40, ",".join(["fine", "idiot", "list"] * 1), "x" * 80]
    top = machine.document(pa.array(hidden))[:, 0]
    assert top[0] > top[2] and top[1] > 0


def test_toxicity_finds_held_out_documents(spark):
    """At the size where insults of rare languages have enough labels; a machine that never says toxic fails."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    machine = toxicity.train(docs, labels)
    held = labels.where((language.fold_of(F.col("doc_id")) == 0) & F.col("toxic").isNotNull())
    got = toxicity.score(docs, machine).join(held, "doc_id").select("predicted", "toxic").collect()
    toxic = [r["predicted"] for r in got if r["toxic"]]
    assert len(toxic) > 50 and sum(toxic) >= 0.9 * len(toxic)
    assert sum(r["predicted"] for r in got if not r["toxic"]) <= 0.02 * len(got)
    assert min(machine.logistic[1:]) >= 0 < max(machine.logistic[1:])
    start = "Thting and of the onheat in thor. Reer ble onst."
    more = ["idiot", "path3tic", "i.d.i.o.t", "thor", "onheat", "xyzzy", "idiotidiotidiotidiotidiot", "stupid idiot", "zu", "été"]
    said = [start] + [f"{start} {w}" for w in more] + [f"{start} {v} {w}" for v in more for w in more]
    s = toxicity.score(spark.createDataFrame(list(enumerate(said)), DOCS), machine).orderBy("doc_id").select("score").collect()
    one = {w: s[1 + k][0] for k, w in enumerate(more)}
    assert all(v >= s[0][0] for v in one.values()) and one["idiot"] >= 0.5
    assert all(s[1 + len(more) + i * len(more) + j][0] >= max(one[v], one[w]) - 1e-12 for i, v in enumerate(more) for j, w in enumerate(more))


def test_toxicity_is_the_same_however_rows_are_dealt(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{TABLES}/labels.parquet")
    one = toxicity.train(docs, labels)
    two = toxicity.train(docs.repartition(7, "text").unionByName(docs.limit(20)), labels.repartition(3))
    assert (one.weights == two.weights).all() and one.bias == two.bias and one.logistic == two.logistic
    odd = spark.createDataFrame([(1, None), (1, None), (2, "idiot " * 60_000), (None, "idiot")], DOCS)
    got = toxicity.score(odd, one).orderBy(F.col("doc_id").asc_nulls_last()).collect()
    assert got[0]["score"] == got[1]["score"] < 0.5 <= got[2]["score"] and 0 <= got[3]["score"] <= 1


# privacy -------------------------------------------------------------------------------------------------------


def secret(rng):
    return "".join(rng.choice("0123456789abcdef") for _ in range(40))


def test_secrets_and_what_gives_them_away(spark):
    rng = random.Random(21)
    docs = [(k, f'{words(rng, 20)} token = "{secret(rng)}" {words(rng, 20)}') for k in range(12)]
    docs += [(k, f"{words(rng, 30)} bluebird {words(rng, 5)}") for k in range(20, 60)]
    docs += [(90, "a TOKEN alone"), (91, "x" * 50), (92, "https://example.org/averylongpathwithoutdigits"), (93, secret(rng) + "@mail.example"), (94, None), (0, docs[0][1])]
    df = spark.createDataFrame(docs, DOCS)
    found = {r["doc_id"]: [s["kind"] for s in r["spans"]] for r in privacy.find(df).collect()}
    assert found[0] == ["term", "secret"] and found[20] == [] and found[90] == ["term"] and found[91] == found[92] == found[94] == [] and found[93] == ["email"]
    clean = {r["doc_id"]: r["text"] for r in privacy.sanitise(privacy.find(df)).collect()}
    assert "[SECRET]" in clean[0] and "token" not in clean[0] and clean[90] == "a  alone"


def test_disclosing_words_equal_a_plain_count(spark):
    rng = random.Random(22)
    docs = []
    for k in range(120):
        said = [words(rng, rng.randint(3, 12))]
        if k % 4 == 0:
            said.append(f"{rng.choice(['zebra', 'quince', 'apples'])} reach {rng.choice(['ann', 'bob'])}@home.example now")
        if k % 9 == 0:
            said.append("zebra alone " + words(rng, 25))
        if k % 30 == 0:
            said.append('key "' + secret(rng) + '"')
        docs.append((k, " ".join(said)))
    near, has, values = {}, Counter(), Counter()
    for _, text in docs:
        spans = privacy.protected_spans(text)
        pairs, mine = {}, set()
        for a, kind, b in spans:
            before, after = text[max(0, a - privacy.NEAR) : a].lower(), text[b : b + privacy.NEAR].lower()
            close = {m[0] for m in re.finditer(r"[^\W\d_]{4,}", before) if m.start() or a <= privacy.NEAR} | {m[0] for m in re.finditer(r"[^\W\d_]{4,}", after) if m.end() < len(after) or b + privacy.NEAR >= len(text)}
            for entity in (kind, (kind, text[a:b].lower())):
                mine.add(entity)
                for w in close:
                    pairs.setdefault((entity, w), set()).add(frozenset(close))
        values.update(mine)
        for key, passages in pairs.items():
            joint = near.setdefault(key, [0, set()])
            joint[0] += 1
            joint[1] |= passages
        covered = [c for a, _, b in spans for c in range(a, b)]
        has.update({m[0].lower() for m in re.finditer(r"[^\W\d_]{4,}", text) if not set(range(*m.span())) & set(covered)})
    want = {}
    for (entity, w), (joint, passages) in near.items():
        if len(passages) >= privacy.LEAST_PASSAGES:
            share = joint / max(has[w], joint)
            information = math.log(share / (values[entity] / len(docs))) / max(-math.log(joint / len(docs)), 1e-9)
            if share >= privacy.LEAST_SHARE and information >= privacy.LEAST_INFORMATION:
                want[w] = max(want.get(w, 0), share)
    got = {r["word"]: r["share"] for r in privacy.disclosing_words(spark.createDataFrame(docs, DOCS)).collect()}
    assert got == {w: pytest.approx(s) for w, s in want.items()} and "reach" in got


def test_words_in_several_blocks_mark_the_same(spark, monkeypatch):
    rng = random.Random(23)
    docs = spark.createDataFrame([(k % 7, f"{words(rng, 9)} alpha beta@c.de gamma {words(rng, 4)} Delta") for k in range(30)] + [(None, None)], DOCS)
    listed = spark.createDataFrame([("alpha", 0.7), ("gamma", 1.0), ("delta", 0.6), ("beta", 1.0)], "word string, share double")
    one = rows(privacy.find(docs, words=listed))
    split = privacy._blocks
    monkeypatch.setattr(privacy, "_blocks", lambda w: split(w, 1))
    assert rows(privacy.find(docs, words=listed)) == one and any(s["kind"] == "term" for r in one for s in r[2])


def test_planted_disclosures_are_found_and_labels_stay(spark):
    """Names that give away addresses and phones are terms; the word before keys only says what stands there."""
    rng = random.Random(29)
    other = lambda: "".join(rng.choice("bcdfghklmnprst") for _ in range(8))
    key = lambda: "".join(rng.choice("abcdefghij0123456789KLMNOP") for _ in range(36))
    people = {"keller": "m.keller@home.example", "okafor": "+44 20 7946 0958", "lindqvist": "lind@post.example"}
    docs = []
    for name, value in people.items():
        docs += [(len(docs) + k, f"{other()} {name.title()} {value} {other()} mail") for k in range(6)] + [(len(docs) + 90 + k, f"{other()} {name} {other()}") for k in range(2)]
    docs += [(1000 + k, f"{other()} token {key()} {other()}") for k in range(12)] + [(2000 + k, f"{other()} mail {other()} {other()}") for k in range(300)]
    df = spark.createDataFrame(docs, DOCS)
    told = {r["word"]: r["label"] for r in privacy.disclosing_words(df).collect()}
    assert told == {**dict.fromkeys(people, False), "token": True}  # all of them and nothing else
    clean = {r["doc_id"]: r["text"] for r in privacy.sanitise(privacy.find(df)).collect()}
    assert not any(n in clean[k].lower() for k, t in docs for n in people if n in t.lower())
    assert all(" token " in clean[1000 + k] for k in range(12)) and sum("token [SECRET]" in clean[1000 + k] for k in range(12)) >= 9 and all(clean[k] == t for k, t in docs if k >= 2000)


# language ------------------------------------------------------------------------------------------------------


def test_language_equals_a_plain_cosine():
    said = ["the cat sat on the mat", "der hund und die katze", "el perro y la gata", "le chat et le chien", "the dog", "die maus", "la casa", "le pain"]
    names = ["en", "de", "es", "fr"] * 2
    found, _ = language.counts(pa.array(said))
    model = language.fit(found.astype(float), names, centroids=2)

    def grams(text):
        w = " " + " ".join(re.findall(r"[^\W\d_]+", text.lower())) + " "
        return Counter(w[i : i + n] for n in (1, 2, 3) for i in range(len(w) - n + 1) if n > 1 or w[i] != " ")

    idf = lambda g: math.log((1 + len(said)) / (1 + sum(g in grams(t) for t in said))) + 0.1
    vector = lambda t: {g: math.log1p(n) * idf(g) for g, n in grams(t).items()}
    cosine = lambda a, b: sum(v * b.get(g, 0) for g, v in a.items()) / math.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values()))
    for text in said:
        names_, score, _ = model.predict(pa.array([text]))
        best = max(zip(names, said), key=lambda x: cosine(vector(text), vector(x[1])))[0]
        assert names_ == [best] and score[0] == pytest.approx(1, abs=0.4)


def test_language_of_repeated_rows(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "text", "lang").limit(60)
    model = language.train(docs)
    got = language.identify(docs.unionByName(docs), model).groupBy("doc_id").agg(F.count("*").alias("n"), F.count_distinct("lang_pred", "score").alias("k")).collect()
    assert {(r["n"], r["k"]) for r in got} == {(2, 1)}


# pipeline ------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def odd_docs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs = docs.withColumns({"spans": F.lit(5), "items": F.lit("x"), "score": F.lit("y"), "n_words": F.lit(3), "predicted": F.lit(9), "word_runs": F.lit(None).cast("string")})
    none = docs.limit(2)
    return docs.unionByName(docs.limit(3)).unionByName(none.withColumn("doc_id", F.lit(None).cast("long"))).unionByName(none.withColumn("text", F.lit(None).cast("string"))).unionByName(none.withColumn("text", F.lit(""))).cache()


def test_stages_keep_columns_under_any_name(spark, odd_docs):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd_docs, "/root/testdata/sf0.001")
        assert out.columns == odd_docs.columns and dict(out.dtypes) == dict(odd_docs.dtypes), name
        assert out.where("spans <> 5 or items <> 'x' or score <> 'y' or n_words <> 3 or predicted <> 9 or word_runs is not null").count() == 0, name
        assert stage(spark, odd_docs.limit(0), "/root/testdata/sf0.001").count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, odd_docs, "").select("doc_id").distinct().count() == odd_docs.select("doc_id").distinct().count()


def test_near_duplicates_are_judged_row_by_row(spark):
    a, b = "one two three four five six seven", "a text of its own under the same number"
    made = [(1, a), (2, a), (2, b), (None, a), (None, "alone without a number at all"), (7, None), (7, ""), (9, b + " !")]
    got = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(made, DOCS), "")
    assert rows(got) == sorted([(1, a), (2, b), (None, "alone without a number at all"), (7, None), (7, "")], key=repr)  # 9 shares five of six shingles
    only = spark.createDataFrame([(None, a), (None, a)], DOCS)
    assert rows(corpus_pipeline.drop_near_duplicates(spark, only, "")) == [(None, a)]


def test_benchmark_stage_equals_a_plain_version(spark, tmp_path):
    docs = texts(31)
    rng = random.Random(9)
    items = [(k, " ".join(docs[k][1].split()[2:18])) for k in range(8)] + [(21, None), (23, words(rng, 40))]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.cut_benchmark(spark, spark.createDataFrame(docs, DOCS), str(tmp_path))
    left = sorted(((r["doc_id"], len(WORD.findall((r["text"] or "").translate(SMALL)))) for r in got.collect()), key=repr)
    assert left == sorted(((d, n - h) for d, n, h, _ in contamination(docs, items, decontamination.WINDOW)), key=repr)


def test_toxic_documents_go_and_others_stay(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "text")
    machine = toxicity.train(docs, spark.read.parquet(f"{TABLES}/labels.parquet"))
    score = {r["doc_id"]: r["score"] for r in toxicity.score(docs, machine).collect()}
    kept = {r["doc_id"] for r in corpus_pipeline.drop_toxic(spark, docs, TABLES).collect()}
    assert kept == {k for k, s in score.items() if s < 0.5} and 0 < len(score) - len(kept)




def test_a_fit_holds_two_tables_of_its_words_at_most():
    import tracemalloc

    rng = random.Random(1)
    word = lambda: "@" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(rng.randrange(3, 11))) + "@"
    good, bad = sorted({word() for _ in range(200)}), sorted({word() for _ in range(9000)})
    tracemalloc.start()
    toxicity.fit_words(good, bad)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 400 * (toxicity.SYMBOLS**3 * 4 + 2.4 * 8 * (len(bad) + 3 * len(good)))
