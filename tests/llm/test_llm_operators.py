"""Small cases of every corpus operator against plain versions: nulls, empty and long texts, ties, repeated rows,
empty tables and clashing columns."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import decontamination, embeddings, fmindex, jaccard, language, packing, privacy, sharding, suffixes, toxicity, warc

DOCS = "doc_id bigint, text string"


def words(rng, n, of=("the", "Sea", "of", "tión", "ing", "ble", "x1", "naïve", "über", "and")):
    return " ".join(rng.choice(of) + rng.choice(("", "a", "en", "or")) for _ in range(n))


def texts(seed, n=30):
    rng = random.Random(seed)
    base = [words(rng, rng.randint(1, 90)) for _ in range(n)]
    near = [b[: len(b) // 2] + " q " + b[len(b) // 2 :] for b in base[:6]]
    found = [*base, *near, base[0], base[0], "", "  \n", "一 二 三 四 五 六", words(rng, 3000), "a b c"]
    return [(k, t) for k, t in enumerate(found)] + [(900, None), (None, "no key here at all"), (5, base[5])]


# 1 -------------------------------------------------------------------------------------------------------------


def linked(vectors, least=0.95):
    sound = {k: np.array(v, float) for k, v in vectors if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    near = {a: {b for b, y in sound.items() if b != a and len(x) == len(y) and x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= least} for a, x in sound.items()}
    out = []
    for k, _ in vectors:
        seen, todo = {k}, [k]
        while todo:
            for b in near.get(todo.pop(), ()):
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        out.append((k, len(near.get(k, ())), min(seen), k == min(seen)))
    return sorted(out)


def test_embeddings(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8))
    made = [(k, (centres[k % 6] + rng.normal(size=8) * rng.choice([0.02, 0.12, 0.3])).astype(np.float32).tolist()) for k in range(160)]
    made += [(200, made[3][1]), (201, made[3][1]), (202, None), (203, []), (204, [0.0] * 8), (205, [float("nan")] * 8), (206, [None] + [1.0] * 7), (207, made[0][1][:5]), (208, (2 * np.array(made[0][1])).tolist())]
    df = spark.createDataFrame(made, "vec_id bigint, embedding array<float>").withColumn("n_links", F.lit("clash"))
    assert rows(embeddings.near_duplicates(df, most=40)) == sorted(linked(made), key=repr)
    assert embeddings.near_duplicates(df.limit(0)).count() == 0
    alone = spark.createDataFrame([(None, [1.0, 0.0]), (None, [1.0, 0.0])], "vec_id bigint, embedding array<float>")
    assert rows(embeddings.near_duplicates(alone)) == [(None, 0, None, False)] * 2


# 2 -------------------------------------------------------------------------------------------------------------


def test_sharding(spark):
    rng = random.Random(1)
    made = [(k, "x" * rng.randint(0, 300)) for k in range(400)] + [(1000, None), (None, "abc"), (7, "again"), (1001, "y" * 5000)]
    df = spark.createDataFrame(made, DOCS).withColumn("shard", F.lit("clash"))
    got = sharding.shard(df, F.octet_length("text"), limit=1000).collect()
    assert len(got) == len(made)
    held, n = Counter(), Counter()
    for r in got:
        held[r["shard"]] += r["row_bytes"]
        n[r["shard"]] += 1
    assert all(b <= 1000 or n[s] == 1 for s, b in held.items())
    for r in got:  # no bucket is split that would have fitted
        if r["local_depth"]:
            parent = r["key_hash"] >> (sharding.MOST_BITS - r["local_depth"] + 1)
            whole = [x for x in got if x["key_hash"] >> (sharding.MOST_BITS - r["local_depth"] + 1) == parent]
            assert sum(x["row_bytes"] for x in whole) > 1000
    assert sharding.shard(df.limit(0), F.octet_length("text")).count() == 0
    same = spark.createDataFrame([(1, "x" * 800)] * 3, DOCS)
    assert {r["local_depth"] for r in sharding.shard(same, F.octet_length("text"), limit=1000).collect()} == {sharding.MOST_BITS}


# 3 -------------------------------------------------------------------------------------------------------------


def test_warc_round_trip(spark):
    long = "é<p>" * 60
    made = [(3, "http://a/", long), (1, "http://b/", long), (2, None, long), (4, "u\r\nx: y", "short"), (5, "u", "short"), (6, "u", None), (7, "u", ""), (8, "u", "z" * 3_000_000), (9, "u", "b\r\n\r\nc" * 40)]
    df = spark.createDataFrame(made, "page_id bigint, url string, html string").withColumn("record_type", F.lit("clash"))
    got = {r["record_id"]: r for r in warc.archive_round_trip(df).collect()}
    assert len(got) == len(made) and all(r["verified"] for r in got.values())
    for page, _, html in made:
        r, body = got[f"<urn:page:{page}>"], (html or "").encode()
        revisit = page in (2, 3)
        assert (r["record_type"], r["payload_bytes"], r["payload_digest"]) == ("revisit" if revisit else "response", len(body), hashlib.sha256(body).hexdigest())
        assert r["refers_to"] == ("<urn:page:1>" if revisit else None) and (None if revisit else body) == (r["payload"] if r["payload"] is None else bytes(r["payload"]))
    assert warc.archive_round_trip(df.limit(0)).count() == 0


def test_warc_framing():
    import gzip
    import io

    good = warc.warc_record(1, "u", b"x" * 200, None, False, "2024-01-01T00:00:00Z")
    assert [r[5] for r in warc.Members(io.BytesIO(good * 3))] == [200] * 3
    changed = gzip.compress(gzip.decompress(good).replace(b"xxx", b"xyx", 1))
    assert [r[7] for r in warc.Members(io.BytesIO(changed))] == [False]
    for bad in (good[:-20], gzip.compress(gzip.decompress(good)[:-6])):
        with pytest.raises(ValueError):
            list(warc.Members(io.BytesIO(bad)))


# 4 -------------------------------------------------------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def contamination(docs, items, window):
    out = []
    phrases = {}
    for item, text in items:
        w = WORD.findall((text or "").translate(SMALL))
        k = min(window, len(w))
        for i in range(len(w) - k + 1) if k else ():
            phrases.setdefault(tuple(w[i : i + k]), set()).add(item)
    for doc, text in docs:
        w, hit, found = WORD.findall((text or "").translate(SMALL)), set(), set()
        for k in {len(p) for p in phrases}:
            for i in range(len(w) - k + 1):
                if (p := tuple(w[i : i + k])) in phrases:
                    hit.update(range(i, i + k))
                    found |= phrases[p]
        out.append((doc, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [8 << 20, 300])
def test_decontamination(spark, block):
    docs = texts(4)
    rng = random.Random(9)
    items = [(k, " ".join(docs[k][1].split()[2:18])) for k in range(8)] + [(20, "THE seaen"), (21, None), (22, ""), (23, words(rng, 40)), (7, docs[9][1])]
    df = spark.createDataFrame(docs, DOCS).withColumn("items", F.lit("clash"))
    found = decontamination.find_contamination(df, spark.createDataFrame(items, "item_id bigint, text string"), window=6, block_bytes=block)
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], sorted(r["items"])) for r in found.collect()), key=repr)
    assert got == contamination(docs, items, 6)
    left = {r["doc_id"]: len(WORD.findall((r["text"] or "").translate(SMALL))) for r in decontamination.remove_spans(found).collect()}
    assert all(left[d] == n - h for d, n, h, _ in got)
    assert decontamination.find_contamination(df.limit(0), spark.createDataFrame(items, "item_id bigint, text string")).count() == 0
    none = decontamination.find_contamination(df, spark.createDataFrame([], "item_id bigint, text string"))
    assert {r["n_hit"] for r in none.collect()} == {0}


def test_fm_index():
    rng = np.random.default_rng(1)
    for _ in range(150):
        k = int(rng.integers(2, 7))
        text = rng.integers(1, k + 1, int(rng.integers(1, 70)))
        index, width = fmindex.FMIndex(text, k + 1), int(rng.integers(1, 5))
        patterns = rng.integers(1, k + 1, (6, width))
        for p, low, high in zip(patterns, *index.ranges(patterns)):
            want = [i for i in range(len(text) - width + 1) if (text[i : i + width] == p).all()]
            assert sorted(index.locate(np.arange(low, high)).tolist()) == want


# 5 -------------------------------------------------------------------------------------------------------------


def without_repeats(docs, match):
    seen, out = Counter(), []
    data = [(k, (t or "").encode()) for k, t in docs]
    for _, b in data:
        seen.update(b[i : i + match] for i in range(len(b) - match + 1))
    for k, b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - match + 1):
            if seen[b[i : i + match]] > 1:
                gone[i : i + match] = b"\1" * match
        runs = sum(1 for i in range(len(b)) if gone[i] and (not i or not gone[i - 1]))
        out.append((k, len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, y in zip(b, gone) if not y)).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("match", "places"), [(60, 24), (40, 10)])
def test_suffixes(spark, monkeypatch, match, places):
    monkeypatch.setattr(suffixes, "RUN_SUFFIXES", 40)
    monkeypatch.setattr(suffixes, "RANGE_SUFFIXES", 80)
    docs = [*texts(match), (700, "ab " * 200), (701, "x" * 30), (5, "another text of the key 5"), (702, "ab " * 90 + "end")]
    df = spark.createDataFrame(docs, DOCS).withColumn("sha", F.lit("clash"))
    assert rows(suffixes.deduplicate(df, match=match, places=places)) == without_repeats(docs, match)
    assert suffixes.deduplicate(df.limit(0)).count() == 0


def test_suffixes_takes_planted_passages_of_400_bytes_and_no_shorter_ones(spark):
    rng = random.Random(8)
    made = lambda n: " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 8))) for _ in range(n))
    passages = [made(n) for n in (51, 54, 57, 60, 66, 72, 80, 90, 100)] + [made(100)[:n] for n in (399, 400, 401)]
    docs = [(2 * k + j, f"{made(30)} {j}{p}{j} {made(30)}") for k, p in enumerate(passages) for j in (0, 1)]
    got = rows(suffixes.deduplicate(spark.createDataFrame(docs, DOCS)))
    assert got == without_repeats(docs, 400)
    removed = {r[0]: r[2] for r in got}
    assert all(removed[2 * k + j] == (len(p) if len(p) >= 400 else 0) for k, p in enumerate(passages) for j in (0, 1))
    assert {len(p) >= 400 for p in passages[:9]} == {False, True}


def test_loser_tree():
    rng = random.Random(2)
    for _ in range(60):
        runs = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(1, 9))]
        tree = suffixes.LoserTree([suffixes.decode_run(suffixes.encode_run([(s, b"", 1, k) for k, s in enumerate(r)])) for r in runs])
        found = [(same, record[1]) for same, _, record in tree]
        assert [s for _, s in found] == sorted(s for r in runs for s in r)
        for (_, a), (same, b) in zip(found, found[1:]):
            assert same == suffixes.shared_prefix(a, b)


# 6 -------------------------------------------------------------------------------------------------------------


def near(docs, percent=85, size=4):
    sets = {}
    for k, t in docs:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", (t or "").translate(SMALL)) if x]
        sets.setdefault(k, []).append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    links = {}
    flat = [(k, s) for k, v in sets.items() if k is not None for s in v if s]
    for a, x in flat:
        for b, y in flat:
            if a != b and 100 * len(x & y) >= percent * len(x | y):
                links.setdefault(a, set()).add(b)
    out = []
    for k, v in sets.items():
        seen, todo = {k}, [k]
        while todo:
            for b in links.get(todo.pop(), ()):
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        out += [(k, len(s), None if k is None else min(seen)) for s in v]
    return sorted(out, key=repr)


def test_jaccard(spark):
    rng = random.Random(6)
    base = [words(rng, 80).split() for _ in range(5)]
    made = []
    for k in range(120):
        w = list(base[k % 5])
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = rng.choice(("new", "odd", "w%d" % k))
        made.append((k, " ".join(w)))
    docs = made + [(k + 1000 if k is not None else None, t) for k, t in texts(6)]
    df = spark.createDataFrame(docs, DOCS).withColumn("component_id", F.lit("clash"))
    assert rows(jaccard.near_duplicates(df, counters=1 << 12)) == near(docs)
    assert jaccard.near_duplicates(df.limit(0)).count() == 0


def test_pipeline_drops_near_duplicates_at_five_words_and_eighty_percent(spark):
    rng = random.Random(11)
    changed = lambda k, base, at: " ".join(f"n{k}x{i}" if i in at else w for i, w in enumerate(base))
    docs = []
    for k in range(0, 30, 6):
        base = [f"w{rng.randrange(10**6)}" for _ in range(460)]
        docs += [(k, " ".join(base)), (k + 4, " ".join(base[:4]) + f" other{k}")]
        docs.append((k + 1, changed(k + 1, base, range(20, 460, 46))))  # scattered: 0.84 of 4 words, 0.80 of 5
        docs.append((k + 2, changed(k + 2, base, range(100, 144))))  # one stretch: 0.81
        docs.append((k + 3, changed(k + 3, base, range(100, 160))))  # 0.75
    assert all(r[0] == r[2] for r in near(docs))  # nothing is linked by op6's contract
    want = [r[0] for r in near(docs, 80, 5) if r[0] == r[2]]
    assert len(want) == len(docs) - 10
    got = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(docs, DOCS), "")
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(want)


# 7 -------------------------------------------------------------------------------------------------------------


def test_toxicity_tolerates_disguise(spark, sf_dir):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    machine = toxicity.train(docs, spark.read.parquet("/root/testdata/sf0.01/labels.parquet"))
    clean = "Thting and of the onheat in thor. Reer ble onst."
    said = [clean, clean + " idiot", clean + " i.d.i.o.t", clean + " id-xiot", clean + " path3tic", None, ""]
    df = spark.createDataFrame(list(enumerate(said)), DOCS).withColumn("score", F.lit("clash"))
    got = [r["score"] for r in toxicity.score(df, machine).orderBy("doc_id").collect()]
    assert got[0] < 0.5 and min(got[1:5]) > got[0] and got[1] >= 0.5 and got[2] >= 0.5
    assert got[5] == got[6] < 0.5
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where(language.fold_of(F.col("doc_id")) == 0)
    held = toxicity.score(docs, machine).join(labels, "doc_id").select("predicted", "toxic").collect()
    assert sum(r["predicted"] == r["toxic"] for r in held) >= 0.9 * len(held)
    assert sum(r["predicted"] for r in held if not r["toxic"]) <= 0.02 * len(held)
    quiet = toxicity.train(docs.limit(0), labels.limit(0))
    assert {r["predicted"] for r in toxicity.score(df, quiet).collect()} == {0}


def test_kernel_is_a_subsequence_kernel():
    """The linear form equals a plain sum over common gapped subsequences."""

    def plain(a, b):
        def of(w):
            out = Counter()
            for i in range(len(w)):
                for j in range(i + 1, len(w)):
                    for k in range(j + 1, min(len(w), i + toxicity.STRETCH + 1)):
                        out[w[i] + w[j] + w[k]] += toxicity.DECAY ** (k - i + 1)
            return out

        x, y = of(a), of(b)
        return sum(v * y[k] for k, v in x.items())

    sym = lambda w: "".join(chr(ord(c) - 32) for c in w)
    norm = toxicity._norms(30)
    for a, b in [("idiot", "idxiot"), ("idiot", "riot"), ("stupid", "stand"), ("abcabc", "aabbcc")]:
        got = toxicity.margins(*toxicity.packed([sym(a)]), toxicity.feature(sym(b)), 0.0)[0]
        assert got == pytest.approx(plain(a, b) / norm[len(a)] / norm[len(b)])


# 8 -------------------------------------------------------------------------------------------------------------


def test_packing(spark):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(packing.vocabulary_path())
    docs = [*texts(8), (800, "it's we'll 'tis  x\r\n\r\n  end  "), (801, "naïve ²³ ½ 🙂 \x1f \x85 é"), (802, "<|endoftext|> a")]
    df = spark.createDataFrame(docs, DOCS).withColumn("piece", F.lit("clash"))
    got = packing.pack(df, capacity=64, keep_ids=True).collect()
    by_doc, bins = {}, {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append(r)
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"] <= 64
    assert sum(len(v) for v in by_doc.values()) == len(got)
    for spans in bins.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 64
    for k, t in docs:
        if k in (5, None):
            continue
        pieces = sorted(by_doc[k], key=lambda r: r["piece"])
        assert [i for r in pieces for i in r["ids"]] == model.encode(t or "", add_special_tokens=False).ids + [2]
        assert [r["start"] for r in pieces] == list(np.cumsum([0, *(r["length"] for r in pieces)])[:-1]) and all(r["length"] == 64 for r in pieces[1:])
    total = sum(r["length"] for r in got)
    assert len(bins) <= 1.05 * total / 64 + 2
    assert packing.pack(df.limit(0)).count() == 0


def test_packing_plan():
    rng = random.Random(3)
    for _ in range(40):
        cap = rng.choice((30, 100))
        counts = Counter(rng.randint(1, cap) for _ in range(rng.randint(0, 300)))
        plan, n = packing.packing_plan(dict(counts), cap)
        used, bins = Counter(), {}
        for size, low, high, first, each, shift in plan:
            used[size] += high - low
            for k in range(high - low):
                bins.setdefault(first + k // each, []).append((shift + k % each * size, size))
        assert used == counts and len(bins) == n
        for spans in bins.values():
            at = 0
            for offset, size in sorted(spans):
                assert offset == at
                at += size
            assert at <= cap and sum(s > cap // 3 for _, s in spans) <= 2
        assert n >= sum(s * k for s, k in counts.items()) / cap


# 9 -------------------------------------------------------------------------------------------------------------


def plain_spans(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[ -]", "", m[0])
        s = sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(d)))
        if 14 <= len(d) <= 19 and s % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c in "0123456789" for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_base_spans():
    rng = random.Random(4)
    known = ["a@b.co", "a@b", "x.y+z@q-r.s.tt", "1.2.3.4.5.6.7.8", "300.1.1.1", "0000255.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (456) 555-2186", "+34", "@", ".", " ", "é", "a@@b.c", "_", "5", "+"]
    for _ in range(4000):
        text = "".join(rng.choice(known) for _ in range(rng.randint(0, 9)))
        assert privacy.base_spans(text) == plain_spans(text), text
    assert privacy.base_spans("1" * 200_000 + "a" * 200_000 + "@") == []


def test_privacy(spark):
    rng = random.Random(8)
    docs = [(k, f"{words(rng, 30)} the bluebird of {words(rng, 1)} wrote ann@home.example again {words(rng, 30)}") for k in range(6)]
    docs += [(k, f"{words(rng, 40)} again wrote {words(rng, 20)}") for k in range(10, 60)]
    docs += [(90, None), (91, ""), (None, "bluebird +1 456 555 2186"), (92, "İstanbul bluebird ab@cd.ef")]
    df = spark.createDataFrame(docs, DOCS).withColumn("spans", F.lit("clash"))
    found = privacy.find(df)
    kinds = {r["doc_id"]: [s["kind"] for s in r["spans"]] for r in found.collect()}
    assert kinds[0] == ["term", "email"] and kinds[10] == [] and kinds[90] == kinds[91] == [] and kinds[None] == ["term", "phone"] and kinds[92] == ["term", "email"]
    clean = {r["doc_id"]: r["text"] for r in privacy.sanitise(found).collect()}
    assert "[EMAIL]" in clean[0] and "bluebird" not in clean[0] and "again" in clean[0] and clean[90] is None and clean[10] == docs[6][1]
    assert privacy.find(df.limit(0)).count() == 0


def test_privacy_words_inside_the_value(spark):
    rng = random.Random(12)
    other = lambda: "".join(rng.choice("bcdfghklmnprst") for _ in range(9))
    docs = [(k, f"{other()} {other()} Keller wrote maria.keller@mail.example {other()} mail {other()}") for k in range(8)]
    docs += [(k, f"{other()} maria.keller@mail.example {other()}") for k in range(10, 30)]  # the name in the address only
    docs += [(k, f"{other()} by mail {other()}") for k in range(30, 90)]
    docs += [(90, f"{other()} Keller {other()}"), (91, f"{other()} kellers {other()}")]
    docs += [(k, other()) for k in range(100, 400)]  # so many that the address, in 28 documents, is rare
    found = {r["doc_id"]: r["spans"] for r in privacy.find(spark.createDataFrame(docs, DOCS)).collect()}
    marked = lambda k: [docs_text[k][s["start"] : s["end"]] for s in found[k] if s["kind"] == "term"]
    docs_text = dict(docs)
    assert marked(0) == ["Keller", "wrote"] and marked(90) == ["Keller"] and marked(10) == marked(30) == marked(91) == []
    share = {r["word"]: r["share"] for r in privacy.disclosing_words(spark.createDataFrame(docs, DOCS)).collect()}
    assert share == {"keller": pytest.approx(8 / 9), "wrote": 1.0}


def test_privacy_counts_documents_of_a_value(spark):
    rng = random.Random(13)
    other = lambda: "".join(rng.choice("bcdfghklmnprst") for _ in range(9))
    far = lambda: " ".join(other() for _ in range(12))
    docs = [(k, f"{other()} zebras ann@home.example {other()}") for k in range(3)]
    docs += [(k, f"{other()} ann@home.example {other()}") for k in range(3, 40)]  # a common value, neighbours that vary
    docs += [(k, f"{other()} quince bob@home.example {far()} {far()} quince bob@home.example {other()}") for k in range(40, 43)]
    docs += [(k, f"{other()} quince {other()}") for k in range(43, 47)] + [(k, far()) for k in range(47, 60)]
    df = spark.createDataFrame(docs, DOCS)
    counted = {(r["word"], r["joint"], r["passages"]) for r in privacy.evidence(df).collect() if r["word"] in (None, "zebras", "quince")}
    assert counted == {(None, 40, 1), (None, 3, 1), ("zebras", 3, 3), ("quince", 3, 6)}
    assert privacy.disclosing_words(df).count() == 0  # quince: 3 of 7 documents


# 10 ------------------------------------------------------------------------------------------------------------


def test_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    model = language.train(docs)
    held = language.identify(docs, model).where((language.fold_of(F.col("doc_id")) == 0) & F.col("lang").isNotNull()).select("lang", "lang_pred").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 34 !"), (4, "the " * 50_000), (5, "漢字かな")], DOCS).withColumn("score", F.lit("clash"))
    got = {r["doc_id"]: r for r in language.identify(odd, model).collect()}
    assert [got[k]["lang_pred"] for k in (1, 2, 3)] == ["und"] * 3 and got[4]["lang_pred"] == "en" and got[5]["lang_pred"] in model.names
    assert all(0 <= r["score"] <= 1 for r in got.values()) and got[5]["rejected"]
    assert {r["lang_pred"] for r in language.identify(odd, model, refuse=True).where("doc_id = 5").collect()} == {"und"}
    empty = language.train(docs.limit(0))
    assert {r["lang_pred"] for r in language.identify(odd, empty).collect()} == {"und"}


def test_span_hashes_do_not_depend_on_place():
    from tidemark.llm.shared import span_hashes

    data = np.frombuffer(b"abcabcxabcab", np.uint8)
    h = span_hashes(data, np.array([0, 3, 7, 0, 10]), np.array([3, 6, 10, 2, 12]))
    assert h[0] == h[1] == h[2] != h[3] and h[3] == h[4]
