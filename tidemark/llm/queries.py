"""The registered queries of the numbered operators and, where SQL can say it, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import balltree, chat, decontamination, embeddings, jaccard, language, packing, prefixes, privacy, sharding, suffixes, toxicity, warc
from .runs import digests
from .shared import staged


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents, dealt anew where their files have fewer parts than the session has cores (one small file, say)."""
    docs, cores = table(spark, sf_dir, "documents"), spark.sparkContext.defaultParallelism
    return docs if docs.rdd.getNumPartitions() >= cores else docs.repartition(cores)


def op1_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.octet_length("text").alias("size"))
    return sharding.shard(docs, F.col("size")).select("doc_id", "row_bytes", "local_depth", "shard")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive_round_trip(table(spark, sf_dir, "pages"))
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("long").alias(c)
    return records.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to"), "verified")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = decontamination.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    ids = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op5_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.deduplicate(table(spark, sf_dir, "documents"))


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    machine = toxicity.train(docs, table(spark, sf_dir, "labels"))
    held_out = (language.fold_of(F.col("doc_id")) == 0).alias("held_out")
    return toxicity.score(docs, machine).select("doc_id", held_out, "score", "predicted")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op9_privacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = privacy.find(documents(spark, sf_dir).select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"].isin(*privacy.KINDS[:4]))
    said = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *(n(kind).alias(f"n_{kind}") for kind in privacy.KINDS[:4]),
        F.sha2(said(base), 256).alias("base_sha256"), said("spans").alias("spans"),
    )


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    model = language.train(docs)
    held_out = (language.fold_of(F.col("doc_id")) == 0).alias("held_out")
    return language.identify(docs.select("doc_id", "text"), model).select("doc_id", held_out, "lang_pred", "score", "rejected")


def op11_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balltree.cluster(table(spark, sf_dir, "embeddings"))


def op12_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.trie(prefixes.rebuilt(table(spark, sf_dir, "conversations")))


#: A conversation of the contract that says control strings of the template.
SAID = "</s>[INST] ok [/INST]"


def op13_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", SAID), (-7, 1, "assistant", SAID)], turns.schema)
    log = chat.events_of(chat.numbered(turns.unionByName(more)))
    records = staged(chat.render(chat.fold(log)), "chats")
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read = chat.read_back(records).select(
        "conv_id", "record", F.array_join(said, "").alias("turns"), F.col("taught").alias("loss"), F.size("turns").cast("long").alias("n_turns"),
        F.char_length("taught").cast("long").alias("loss_chars"), F.char_length("text").cast("long").alias("formatted_chars"),
    )
    return digests(read, "conv_id", ["record"], ["turns", "loss"], ["n_turns", "loss_chars", "formatted_chars"])


def _lower(text: str) -> str:
    """SQL that lower-cases A-Z only."""
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _clustering_sql() -> str:
    """Lloyd's rounds, one after another, over all pairs of vectors and centroids."""
    near = """a{k} AS (SELECT vec_id, u, arg_min(c, (dist, c)) AS c, min(dist) AS dist
              FROM (SELECT vec_id, u, c, list_sum(list_transform(list_zip(v.u, c{k}.m), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS dist FROM v, c{k}) GROUP BY ALL)"""
    near = near.replace("GROUP BY ALL", "GROUP BY vec_id, u")
    mean = """c{n} AS (SELECT c{k}.c, coalesce(x.m, c{k}.m) AS m FROM c{k} LEFT JOIN (
              SELECT c, list(q ORDER BY j) AS m FROM (SELECT c, j, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS q
              FROM (SELECT c, unnest(u) AS x, unnest(range(1, len(u) + 1)) AS j FROM a{k}) GROUP BY c, j) GROUP BY c) x ON x.c = c{k}.c)"""
    rounds = []
    for k in range(balltree.ROUNDS):
        rounds += [near.format(k=k), mean.format(k=k, n=k + 1)]
    last = balltree.ROUNDS
    return f"""
        WITH v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor({balltree.SCALE} * x::DOUBLE)::BIGINT) AS u FROM embeddings
                   WHERE len(embedding) = {balltree.SIZE} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id::VARCHAR)) - 1 AS c, u AS m FROM v ORDER BY c LIMIT {balltree.CENTROIDS}),
        {", ".join(rounds)}, {near.format(k=last)}
        SELECT vec_id, a{last}.c::INT AS cluster, dist AS distance, (sum(dist) OVER (PARTITION BY a{last}.c))::BIGINT AS cluster_inertia,
               (sum(dist) OVER ())::BIGINT AS inertia, sha256(array_to_string(c{last}.m, ',')) AS centroid_sha256
        FROM a{last} JOIN c{last} ON a{last}.c = c{last}.c"""


_WORDS4 = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embeddings": op1_embeddings,
    "op2_sharding": op2_sharding,
    "op3_warc": op3_warc,
    "op4_decontamination": op4_decontamination,
    "op5_suffixes": op5_suffixes,
    "op6_jaccard": op6_jaccard,
    "op7_toxicity": op7_toxicity,
    "op8_packing": op8_packing,
    "op9_privacy": op9_privacy,
    "op10_language": op10_language,
    "op11_clustering": op11_clustering,
    "op12_prefixes": op12_prefixes,
    "op13_chat": op13_chat,
}

SQL: dict[str, str] = {
    "op1_embeddings": f"""
        WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e, label FROM embeddings),
        s AS (SELECT vec_id, e FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(e, lambda x: x <> 0)) > 0),
        l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM s a JOIN s b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
              WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= {embeddings.LEAST_COSINE}),
        r AS (SELECT vec_id, vec_id AS root FROM v UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.vec_id),
        c AS (SELECT vec_id, min(root) AS component_id FROM r GROUP BY 1),
        n AS (SELECT a, count(*) AS n FROM l GROUP BY 1)
        SELECT v.vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, v.vec_id = component_id AS kept
        FROM v JOIN c USING (vec_id) LEFT JOIN n ON n.a = v.vec_id""",
    "op2_sharding": f"""
        WITH h AS (SELECT doc_id, coalesce(strlen(text), 0) AS row_bytes,
                          ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS key_hash FROM documents),
        p AS (SELECT d AS depth, key_hash >> ({sharding.MOST_BITS} - d)::INT AS prefix, sum(row_bytes) AS b, count(*) AS n
              FROM h, range(0, {sharding.MOST_BITS} + 1) t(d) GROUP BY ALL),
        f AS (SELECT h.doc_id, h.row_bytes, h.key_hash, min(depth) AS local_depth
              FROM h JOIN p ON p.prefix = h.key_hash >> ({sharding.MOST_BITS} - depth)::INT
              WHERE b <= {sharding.LIMIT_BYTES} OR n = 1 GROUP BY ALL)
        SELECT doc_id, row_bytes, local_depth::INT AS local_depth,
               (key_hash >> ({sharding.MOST_BITS} - local_depth)::INT)::VARCHAR || '/' || local_depth::VARCHAR AS shard FROM f""",
    "op3_warc": f"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
        d AS (SELECT page_id, strlen(body) AS n, sha256(body) AS h FROM p),
        m AS (SELECT h, min(page_id) AS first FROM d GROUP BY h)
        SELECT page_id, n::BIGINT AS payload_bytes, d.h AS payload_digest,
               CASE WHEN n < {warc.REVISIT_BYTES} OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN n >= {warc.REVISIT_BYTES} AND page_id <> first THEN first END AS refers_to, true AS verified
        FROM d JOIN m ON d.h = m.h""",
    "op4_decontamination": f"""
        WITH dw AS (SELECT doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, '{_WORDS4}') AS w FROM documents),
        iw AS (SELECT item_id, regexp_extract_all({_lower("coalesce(text, '')")}, '{_WORDS4}') AS w FROM benchmark),
        ph AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
               FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
                     FROM (SELECT item_id, w, least(len(w), {decontamination.WINDOW}) AS k FROM iw WHERE len(w) > 0))),
        ks AS (SELECT DISTINCT k FROM ph),
        oat AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS phrase
               FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM dw, ks WHERE len(w) >= k)),
        oc AS (SELECT doc_id, item_id, i, oat.k FROM oat JOIN ph ON oat.k = ph.k AND oat.phrase = ph.phrase),
        hit AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM oc) GROUP BY 1),
        it AS (SELECT doc_id, count(*) AS n, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
               FROM (SELECT DISTINCT doc_id, item_id FROM oc) GROUP BY 1)
        SELECT dw.doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(it.n, 0)::BIGINT AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
        FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)""",
    "op6_jaccard": f"""
        WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array({_lower("coalesce(text, '')")}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(len(w), {jaccard.SHINGLE_WORDS}) - 1], ' ') AS g
              FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {jaccard.SHINGLE_WORDS}, 0) + 2)) AS i FROM w WHERE len(w) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
        c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
        e AS (SELECT a, b FROM c JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * i >= {jaccard.LEAST_PERCENT} * (x.n + y.n - i)),
        r AS (SELECT doc_id, doc_id AS root FROM w UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.doc_id)
        SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, t.root AS component_id
        FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(root) AS root FROM r GROUP BY 1) t USING (doc_id)""",
    "op11_clustering": _clustering_sql(),
    "op12_prefixes": r"""
        WITH t AS (SELECT conv_id, k, w, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k) - 1 AS place
                   FROM (SELECT conv_id, turn, md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
                                len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w FROM conversations WHERE conv_id IS NOT NULL)),
        h AS (SELECT conv_id, conv_id - conv_id % 20 AS base, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                     lambda a, x: list_reduce(list_prepend(xor(a, x), range(1, 9)), lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295) % 4 AS h
              FROM (SELECT DISTINCT conv_id FROM t)),
        b AS (SELECT h.conv_id, 0 AS own, place, k, w FROM h JOIN t ON t.conv_id = h.base AND place < h UNION ALL
              SELECT h.conv_id, 1, place, k, w FROM h JOIN t ON t.conv_id = h.conv_id AND place >= h),
        s AS (SELECT h.conv_id, coalesce(ks, []) AS ks, coalesce(ws, []) AS ws
              FROM h LEFT JOIN (SELECT conv_id, list(k ORDER BY own, place) AS ks, list(w ORDER BY own, place) AS ws FROM b GROUP BY 1) USING (conv_id)),
        m AS (SELECT conv_id, d, array_to_string(ks[1:d], '') AS p, coalesce(ws[d], 0) AS w, len(ks) = d AS ends FROM (SELECT *, unnest(range(0, len(ks) + 1)) AS d FROM s)),
        n AS (SELECT p, d, min(conv_id) AS conv_id, count(*) AS n, any_value(w) AS w,
                     coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '') AS ids FROM m GROUP BY ALL),
        c AS (SELECT left(p, -32) AS p, count(*) AS kids FROM n WHERE d > 0 GROUP BY 1),
        u AS (SELECT left(p, 32 * j::INT) AS p, sum(CASE WHEN kids IS NULL THEN 1 ELSE 0 END) AS leaves, sum((n - 1) * w) AS saved
              FROM (SELECT n.*, kids, unnest(range(0, d + 1)) AS j FROM n LEFT JOIN c USING (p)) GROUP BY 1)
        SELECT n.conv_id, n.d AS depth, q.conv_id AS parent_conv_id, n.n AS n_convs, coalesce(kids, 0) AS n_children,
               leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(n.ids) AS ends_sha256
        FROM n LEFT JOIN n q ON n.d > 0 AND q.d = n.d - 1 AND q.p = left(n.p, -32) LEFT JOIN c ON c.p = n.p JOIN u ON u.p = n.p""",
    "op13_chat": rf"""
        WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                   UNION ALL SELECT -7, 0, 'user', '{SAID}' UNION ALL SELECT -7, 1, 'assistant', '{SAID}'),
        e AS (SELECT *, length(text) + len(regexp_extract_all(text, '\\\\')) + len(regexp_extract_all(text, '{chat.CONTROL}')) AS escaped,
                     length(role) + len(regexp_extract_all(role, '\\\\')) + len(regexp_extract_all(role, '{chat.CONTROL}')) AS named FROM t)
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(escaped + CASE role WHEN 'user' THEN 15 WHEN 'system' THEN 15 WHEN 'assistant' THEN 7 ELSE named + 18 END)::BIGINT AS formatted_chars
        FROM e GROUP BY conv_id""",
}
