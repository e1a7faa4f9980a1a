"""Ball-tree clustering, prefix tries and chat logs against plain versions, with odd tables and small blocks."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.llm import balltree, chat, prefixes
from tidemark.llm.queries import SAID
from tidemark.llm.runs import digests, ranked

VECTORS = "vec_id bigint, embedding array<float>, cluster string, id string"


def lloyd(vectors, k, rounds):
    """Plain rounds over (vec_id, whole components)."""
    first = sorted(vectors, key=lambda v: (hashlib.sha256(f"1:{'' if v[0] is None else v[0]}".encode()).hexdigest(), v[1]))[:k]
    centroids = [list(v[1]) for v in first]
    off = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda u: min(range(len(centroids)), key=lambda c: (off(u, centroids[c]), c))
    for _ in range(rounds):
        own = defaultdict(list)
        for _, u in vectors:
            own[near(u)].append(u)
        for c, us in own.items():
            centroids[c] = [sum(x) // len(us) for x in zip(*us)]
    found = [(i, near(u), u) for i, u in vectors]
    per = defaultdict(int)
    for _, c, u in found:
        per[c] += off(u, centroids[c])
    total = sum(per.values())
    digest = lambda c: hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()
    return sorted(((i, c, off(u, centroids[c]), per[c], total, digest(c)) for i, c, u in found), key=repr)


@pytest.mark.parametrize("spread", [0.02, 1.0])
def test_clusters_equal_plain_rounds(spark, spread):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(7, 64))
    x = (centres[rng.integers(0, 7, 900)] + rng.normal(size=(900, 64)) * spread).astype(np.float32)
    x[100:400] = x[100]  # many copies
    made = [(k if k % 50 else k // 2, v.tolist(), "c", "i") for k, v in enumerate(x)] + [(None, x[5].tolist(), None, None)]
    odd = [(2000, None), (2001, []), (2002, [0.5] * 63), (2003, [0.5] * 63 + [None]), (2004, [float("nan")] * 64), (2005, [float("inf")] + [0.0] * 63)]
    df = spark.createDataFrame(made + [(i, v, None, None) for i, v in odd], VECTORS)
    got = rows(balltree.cluster(df, block=200, leaf=5))
    assert got == lloyd([(i, [math.floor(64 * float(np.float32(y))) for y in v]) for i, v, _, _ in made], 16, 3)


def test_few_or_no_vectors(spark):
    df = spark.createDataFrame([(1, [0.25] * 64, "", ""), (2, [0.25] * 64, "", ""), (3, [-1.0] * 64, "", "")], VECTORS)
    assert {(r["vec_id"], r["distance"]) for r in balltree.cluster(df).collect()} == {(1, 0), (2, 0), (3, 0)}
    assert balltree.cluster(df.where("false")).collect() == [] and balltree.cluster(df.where("false")).columns[0] == "vec_id"


def test_balls_are_taken_whole_and_ties_go_down():
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.integers(-9, 9, (500, 8)), rng.integers(-9, 9, (500, 8)) + 4000])
    tree = balltree.grow(np.arange(1000), points, 10)
    near, count, total, whole = balltree.assign(tree, np.array([[4000] * 8, [0] * 8, [0] * 8]))
    assert whole and count.tolist() == [500, 500, 0] and (total.sum(0) == points.sum(0)).all()
    assert (near == np.where(tree.points[:, 0] > 2000, 0, 1)).all()
    large = balltree._squares(np.array([[1 << 26, -(1 << 26)]]), np.array([[-(1 << 26), 1 << 26]]))
    assert large.tolist() == [[1 << 55]]


def plain_trie(convs):
    mark = lambda v: hashlib.md5(f"{len(v[1])}:{v[1]}{v[2]}".encode()).hexdigest()
    own = {c: [v[1:] for v in sorted(((t, r or "", x or "") for t, r, x in ts), key=lambda v: (v[0] is not None, v[0] or 0, mark(v)))] for c, ts in convs.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + ts[h:])
    members, kids = defaultdict(list), defaultdict(set)
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
            if d:
                kids[ts[: d - 1]].add(ts[:d])
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(built[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


TURNS = "conv_id bigint, turn bigint, role string, text string, place string, part string"


@pytest.mark.parametrize(("seed", "chunk"), [(1, 512), (1, 2), (2, 1), (3, 512)])
def test_trie_equals_plain_one(spark, seed, chunk):
    rng, made = random.Random(seed), []
    for c in range(-25, 75):
        for t in range(rng.choice([0, 1, 2, 3, 5, 9])):
            made.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "assistant", None]), rng.choice(["a b", "c", None, " d  e\tf "]), "x", "y"))
    made += [(33, t, "user", "a b", None, None) for t in range(40, 60)] + [(34, t, "user", "a b", None, None) for t in range(40, 60)]  # equal tails
    made += [(None, 1, "user", "lost", None, None)]
    convs = defaultdict(list)
    for c, t, r, x, _, _ in made[:-1]:
        convs[c].append((t, r, x))
    assert rows(prefixes.trie(prefixes.rebuilt(spark.createDataFrame(made, TURNS)), chunk)) == plain_trie(convs)


def test_trie_of_nothing_and_of_turnless(spark):
    empty = spark.createDataFrame([], TURNS)
    assert prefixes.trie(prefixes.rebuilt(empty)).collect() == []
    one = spark.createDataFrame([(5, 1, "user", "x", None, None)], TURNS)  # crc32("5") % 4 is over 0 and conversation 0 is absent
    assert rows(prefixes.trie(prefixes.rebuilt(one))) == plain_trie({5: [(1, "user", "x")]})


def test_builder_over_tasks_equals_one_task():
    """A prefix cut over tasks gives the same sums when its parts are added up."""
    rng = random.Random(7)
    found = sorted({"".join(rng.choice("ab") * 32 for _ in range(rng.randint(1, 6))) for _ in range(40)})
    items = [(s, [len(s) // 32 + 3 * (s[k] == "a") for k in range(0, len(s), 32)], {"conv": k, "n": 1 + k % 3, "ends": 1 + k % 3, "children": 0, "leaves": 0, "below": 0}) for k, s in enumerate(found)]
    items = [(s, [j + 1 for j in range(len(w))], i) for s, w, i in items]

    def nodes(cuts):
        sums, out = {}, {}
        for a, b in zip([0, *cuts], [*cuts, len(items)]):
            left = prefixes.common(items[a - 1][0], items[a][0]) if a else 0
            right = prefixes.common(items[b - 1][0], items[b][0]) if b < len(items) else 0
            tree = prefixes.Builder("", left, 0)
            for x in items[a:b]:
                tree.add(*x)
            tree.finish(right)
            for id_, _, _, conv, depth, n, ends, children, leaves, below, edge, whole in tree.rows:
                if whole:
                    for j, suffix in enumerate(edge):
                        last = j == len(edge) - 1
                        out[conv, depth - len(edge) + 1 + j] = (n, ends if last else 0, children if last else 1, leaves, below + (n - 1) * suffix)
                else:
                    s = sums.setdefault(id_, [conv, depth, 0, 0, 0, 0, 0, edge[0]])
                    s[0] = min(s[0], conv)
                    for j, v in enumerate((n, ends, children, leaves, below)):
                        s[2 + j] += v
        for conv, depth, n, ends, children, leaves, below, w in sums.values():
            out[conv, depth] = (n, ends, children, leaves, below + (n - 1) * w if depth else below)
        return out

    whole = nodes([])
    for _ in range(20):
        assert nodes(sorted(rng.sample(range(1, len(items)), rng.randint(1, 6)))) == whole


def test_ranks_and_digests_over_tasks(spark):
    made = [("a", k % 50) for k in range(900)] + [("b", 1), (None, 2), (None, 1)]
    got = ranked(spark.createDataFrame(made, "k string, v int").repartition(5), "k", [F.col("v")]).orderBy("k", "place").collect()
    assert [(r["k"], r["place"]) for r in got] == [(None, 0), (None, 1), *(("a", k) for k in range(900)), ("b", 0)]
    assert [r["v"] for r in got if r["k"] == "a"] == sorted(k % 50 for k in range(900))
    df = spark.createDataFrame([("a", 2, "y", 1), ("a", 1, "é", 5), (None, 1, None, None), ("b", 1, "", 2)], "k string, o int, t string, n bigint")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert rows(digests(df, "k", ["o"], ["t"], ["n"], separator="|")) == sorted([("a", sha("é|y"), 6), (None, sha(""), 0), ("b", sha(""), 2)], key=repr)


LOG = "conv_id bigint, message bigint, seq bigint, kind string, role string, text string, key string, row string"


def plain_fold(log):
    """Events of each message in order; a message withdrawn by a later regeneration of an earlier one goes."""
    by = defaultdict(list)
    for c, m, s, kind, role, text, _, _ in log:
        by[c, m].append((s, kind, role, text))
    low = lambda v: (v is not None, v if v is not None else 0)
    for events in by.values():
        events.sort(key=lambda e: (low(e[0]), (e[1] is not None, e[1] or ""), (e[3] is not None, e[3] or "")))
    out = []
    for (c, m), events in by.items():
        text, role = "", next((e[2] for e in events if e[2] is not None), "")
        for _, kind, _, said in events:
            text = text + (said or "") if kind == "delta" else said or "" if kind == "edit" else "" if kind == "regenerate" else text
        again = [e[0] for (c2, m2), own in by.items() if c2 == c and low(m2) < low(m) for e in own if e[1] == "regenerate" and e[0] is not None]
        if not (again and events[0][0] is not None and max(again) > events[0][0]):
            out.append((c, m, role, text))
    return sorted(out, key=repr)


def test_fold_equals_plain_one(spark):
    rng, log = random.Random(2), []
    for c in (1, 2, 3, None):
        for k in range(400 if c == 1 else 60):
            kind = rng.choice(["open", "delta", "delta", "delta", "edit", "regenerate" if rng.random() < 0.3 else "delta", "unknown", None])
            log.append((c, k // 5 if rng.random() < 0.8 else rng.randint(0, k // 4 + 1), rng.choice([k, k, k, None]), kind, rng.choice(["user", "assistant", None]), rng.choice(["x", "y z", None, ""]), "k", "r"))
    log = [e for e in log if e[4] is not None or True]
    df = spark.createDataFrame(log, LOG).repartition(7)
    want = plain_fold(log)
    got = rows(chat.fold(df))
    assert [(c, m, t) for c, m, _, t in got] == [(c, m, t) for c, m, _, t in want]
    assert chat.fold(df.where("false")).collect() == []


HARD = ["", SAID, "\\", "\\[INST] [\\INST] \\\\", "<s></s><<SYS>> x <</SYS>>", "[ROLE]user[/ROLE]a[END]", "<", "[", "a\n b 😀 [INST", " [/INST]", "<<s>", "é" * 900 + " </s>"]


def test_chats_round_trip(spark):
    made = [(c, t, role, x, "k", "n") for c in range(3) for t, (role, x) in enumerate((r, x) for x in HARD for r in ("user", "assistant", "system", "tool [END]", ""))]
    made += [(9, None, None, None, "k", "n"), (9, 0, "assistant", None, "k", "n"), (None, 0, "user", "who", "k", "n")]
    df = spark.createDataFrame(made, "conv_id bigint, turn bigint, role string, text string, key string, n string")
    records = chat.render(chat.fold(chat.events_of(chat.numbered(df))), turns=16)
    assert records.groupBy("conv_id").count().agg(F.max("count")).first()[0] > 3
    got = defaultdict(list)
    taught = defaultdict(str)
    for r in chat.read_back(records).orderBy("conv_id", "record").collect():
        got[r["conv_id"]] += [(t["role"], t["text"]) for t in r["turns"]]
        taught[r["conv_id"]] += r["taught"]
        for s in r["loss"]:
            assert r["text"][s["start"] - 3 : s["start"]] == "<s>" and r["text"][s["end"] : s["end"] + 4] == "</s>"
    want = defaultdict(list)
    for c, _, r, x, _, _ in made:
        want[c].append((r or "", x or ""))
    assert got == want
    assert all(taught[c] == "".join(x for r, x in want[c] if r == "assistant") for c in want)
