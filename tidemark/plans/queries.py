"""Registered queries of the engine's own operators over the given tables, with the SQL each must equal."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import canon
from ..operators import change, gates, identity, match, runs, search, views
from ..operators.staging import shared_dir
from ..sources import trees
from ..streaming import incremental

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ORDER_FIELDS = {
    "custkey": "cast(o_custkey as string)", "date": "date_format(o_orderdate, 'yyyy-MM-dd')", "priority": "o_orderpriority",
    "status": "o_orderstatus", "total": "cast(cast(o_totalprice as decimal(18,2)) as string)",
}
#: Two snapshots of orders overlap between these days; in the earlier one every order was still open.
CUR_FROM, PREV_UNTIL = "1997-01-01", "2000-01-01"


def _order_hash(status: Column | None = None) -> Column:
    fields = {k: F.expr(v) for k, v in ORDER_FIELDS.items()}
    fields["total"] = canon.canonical_decimal(fields["total"])
    return identity.content_hash(fields | ({} if status is None else {"status": status}))


def _sql_decimal(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '(\\.\\d*?)0+$', '\\1'), '\\.$', '')"


def _sql_hash(status: str = "o_orderstatus") -> str:
    total = _sql_decimal("CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)")
    return f"""sha256('{{"custkey":"' || o_custkey || '","date":"' || strftime(o_orderdate, '%Y-%m-%d') || '","priority":"' || o_orderpriority || '","status":"' || {status} || '","total":"' || {total} || '"}}')"""


@query(f"SELECT o_orderkey, {_sql_hash()} AS content_hash FROM orders")
def content_hash_orders(spark, d):
    return table(spark, d, "orders").select("o_orderkey", _order_hash().alias("content_hash"))


_URL = """lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) || '://' || lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1))
 || regexp_replace(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/+', '/', 'g'), '/$', '')
 || CASE WHEN array_to_string(list_filter(string_split(regexp_extract(url, '^[^?#]*\\?([^#]*)', 1), '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|gclid|fbclid)(=|$)')), '&') <> ''
    THEN '?' || array_to_string(list_filter(string_split(regexp_extract(url, '^[^?#]*\\?([^#]*)', 1), '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|gclid|fbclid)(=|$)')), '&') ELSE '' END"""


@query(f"SELECT page_id, {_URL} AS canonical FROM pages")
def canonical_url_pages(spark, d):
    return table(spark, d, "pages").select("page_id", canon.canonical_url(F.col("url")).alias("canonical"))


@query(f"""WITH c AS (SELECT page_id, {_URL} AS u FROM pages),
  t AS (SELECT page_id, 'rec:web:' || regexp_replace(substr(regexp_replace(regexp_replace(lower(u), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 64), '^$', '') || '-' || substr(sha256(u), 1, 16) AS record_id FROM c)
  SELECT page_id, record_id, 'canonical_url' AS identity_strategy, 'r-' || lower(hex(record_id)) AS public_name FROM t""")
def record_identity_pages(spark, d):
    found = identity.identify(table(spark, d, "pages"), F.lit("Web"), url=F.col("url"), fingerprint=[F.col("page_id")])
    return found.select("page_id", "record_id", "identity_strategy", canon.encoded_id(F.col("record_id")).alias("public_name"))


@query("""SELECT user_id, event_type, arg_max(event_id, (ts, -event_id)) AS event_id, max(ts) AS ts FROM events GROUP BY 1, 2""")
def dedupe_latest_per_key(spark, d):
    return change.latest_per_key(table(spark, d, "events"), ["user_id", "event_type"], [F.desc("ts"), F.asc("event_id")]).select("user_id", "event_type", "event_id", "ts")


@query("""SELECT sha256(coalesce(text, '')) AS text_sha, count(*) AS n, count(DISTINCT lang) AS n_lang, count(DISTINCT source) AS n_source
  FROM documents GROUP BY 1 HAVING count(DISTINCT lang) > 1 OR count(DISTINCT source) > 1""")
def duplicate_conflicts(spark, d):
    docs = table(spark, d, "documents").select(F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha"), "lang", "source")
    return change.conflicts(docs, [F.col("text_sha")], ["lang", "source"])


def _snapshots(spark, d):
    orders = table(spark, d, "orders")
    key = F.col("o_orderkey").cast("string").alias("order_id")
    day = F.col("o_orderdate").cast("date")
    prev_status = F.when(F.col("o_orderpriority") == "5-LOW", "quarantine").when(F.col("o_orderpriority") == "1-URGENT", "missing_from_source").otherwise("active")
    prev = orders.where(day < PREV_UNTIL).select(key, prev_status.alias("status"), _order_hash(F.lit("O")).alias("content_hash"))
    cur = orders.where(day >= CUR_FROM).select(key, F.lit("active").alias("status"), _order_hash().alias("content_hash"))
    return prev, cur


_RECONCILE = f"""WITH p AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, CASE o_orderpriority WHEN '5-LOW' THEN 'quarantine' WHEN '1-URGENT' THEN 'missing_from_source' ELSE 'active' END AS st, {_sql_hash("'O'")} AS h FROM orders WHERE o_orderdate < DATE '{PREV_UNTIL}'),
  c AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, 'active' AS st, {_sql_hash()} AS h FROM orders WHERE o_orderdate >= DATE '{CUR_FROM}'),
  j AS (SELECT coalesce(p.id, c.id) AS order_id, p.st AS ps, p.h AS ph, c.st AS cs, c.h AS ch FROM p FULL OUTER JOIN c ON p.id = c.id),
  e AS (SELECT order_id, CASE WHEN ps IS NULL THEN 'create' WHEN cs IS NOT NULL AND ps = 'missing_from_source' THEN 'reappeared' WHEN cs IS NOT NULL AND ph <> ch THEN 'update'
      WHEN cs IS NULL AND ps = 'active' AND COMPLETE THEN 'missing_from_source' END AS event, ph AS previous_hash, coalesce(ch, ph) AS content_hash,
      CASE WHEN cs IS NOT NULL AND ps = 'quarantine' THEN ps WHEN cs IS NOT NULL THEN cs WHEN ps = 'active' AND COMPLETE THEN 'missing_from_source' ELSE ps END AS result_status FROM j)"""
_EVENT = """'evt-v1-' || sha256('["' || order_id || '","' || event || '",' || coalesce('"' || previous_hash || '"', 'null') || ',"' || content_hash || '"]')"""


@query(_RECONCILE.replace("COMPLETE", "true") + f" SELECT *, {_EVENT} AS event_id FROM e WHERE event IS NOT NULL")
def reconcile_snapshots(spark, d):
    prev, cur = _snapshots(spark, d)
    return change.with_event_ids(change.reconcile(prev, cur, "order_id"), "order_id").select("order_id", "event", "previous_hash", "content_hash", "result_status", "event_id")


@query(_RECONCILE.replace("COMPLETE", "false") + " SELECT * FROM e")
def reconcile_partial_run(spark, d):
    prev, cur = _snapshots(spark, d)
    return change.reconcile(prev, cur, "order_id", "partial").select("order_id", "event", "previous_hash", "content_hash", "result_status")


@query(f"""WITH b AS (SELECT o_orderkey, o_orderstatus, o_orderpriority, CAST(o_custkey AS VARCHAR) AS c FROM orders WHERE o_orderdate >= DATE '{CUR_FROM}' AND o_orderdate < DATE '{PREV_UNTIL}')
  SELECT o_orderkey, 'o_orderpriority' AS path, substr(o_orderpriority, 1, 1) AS old, o_orderpriority AS new FROM b
  UNION ALL SELECT o_orderkey, 'o_orderstatus', 'O', o_orderstatus FROM b WHERE o_orderstatus <> 'O'
  UNION ALL SELECT o_orderkey, 'c', NULL, c FROM b WHERE o_orderpriority = '5-LOW'""")
def diff_paths(spark, d):
    both = table(spark, d, "orders").where(f"o_orderdate >= '{CUR_FROM}' and o_orderdate < '{PREV_UNTIL}'").withColumn("c", F.col("o_custkey").cast("string"))
    before = both.select("o_orderkey", F.lit("O").alias("o_orderstatus"), F.substring("o_orderpriority", 1, 1).alias("o_orderpriority"), F.when(F.col("o_orderpriority") != "5-LOW", F.col("c")).alias("c"))
    return change.diff_paths(before, both, "o_orderkey", ["o_orderstatus", "o_orderpriority", "c"])


def _moves(spark, d):
    return change.transitions(table(spark, d, "events"), "user_id", ["ts", "event_id"], "event_type")


@query("""WITH l AS (SELECT user_id, event_id, event_type AS cur, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events)
  SELECT user_id, event_id, prev AS previous, cur AS current, 'evt-v1-' || sha256('["' || user_id || '","' || CASE WHEN prev IS NULL THEN 'create' ELSE 'update' END || '",' || coalesce('"' || prev || '"', 'null') || ',"' || cur || '"]') AS transition_id
  FROM l WHERE prev IS NULL OR prev <> cur""")
def transition_event_ids(spark, d):
    kind = F.when(F.col("previous").isNull(), "create").otherwise("update")
    return _moves(spark, d).select("user_id", "event_id", "previous", "current", identity.event_id(F.col("user_id").cast("string"), kind, F.col("previous"), F.col("current")).alias("transition_id"))


@query("""WITH l AS (SELECT user_id, event_id, ts, event_type AS cur, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events),
  g AS (SELECT user_id, event_id, cur, prev, ts FROM l WHERE cur <> 'signup'),
  k AS (SELECT user_id, event_id, prev AS claimed, lag(cur) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS expected FROM g)
  SELECT user_id, event_id, claimed, expected FROM k WHERE claimed IS DISTINCT FROM expected""")
def history_chain_check(spark, d):
    rows = table(spark, d, "events")
    before = F.lag("event_type").over(change.Window.partitionBy("user_id").orderBy("ts", "event_id"))
    chain = rows.withColumn("claimed", before).where("event_type <> 'signup'")  # with events lost, links break
    return change.broken_links(chain, "user_id", ["ts", "event_id"], "claimed", "event_type").select("user_id", "event_id", "claimed", "expected")


@query("""WITH RECURSIVE l AS (SELECT value, lag(CAST(floor(value / 10) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS a, CAST(floor(value / 10) AS BIGINT) AS b FROM events),
  e AS (SELECT DISTINCT a, b FROM l WHERE a < b),
  r AS (SELECT 0::BIGINT AS node, 0 AS steps UNION SELECT e.b, steps + 1 FROM r JOIN e ON e.a = r.node WHERE steps < 3)
  SELECT node, min(steps)::INT AS steps FROM r GROUP BY 1""")
def history_reachability(spark, d):
    rows = table(spark, d, "events").withColumn("b", F.floor(F.col("value") / 10).cast("long"))
    edges = rows.select(F.lag("b").over(change.Window.partitionBy("user_id").orderBy("ts", "event_id")).alias("a"), "b").where("a < b")
    return change.reachable(edges, "a", "b", spark.range(1).select(F.col("id").alias("root")), "root", 3)


@query("""WITH r AS (SELECT user_id, event_id, ts, event_type, CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'partial' WHEN 'signup' THEN 'no_publication' ELSE 'success' END AS st FROM events),
  s AS (SELECT user_id, max((ts, event_id)) FILTER (st <> 'failed') AS k FROM r GROUP BY 1),
  a AS (SELECT r.user_id, arg_max(st, (ts, event_id)) AS latest_status, count(*) FILTER (st = 'failed' AND (k IS NULL OR (ts, event_id) > k)) AS failures,
      max(ts) FILTER (st IN ('success', 'no_publication')) AS last_success, arg_max('code_' || event_id, (ts, event_id)) FILTER (st = 'failed') AS last_error FROM r JOIN s ON r.user_id = s.user_id GROUP BY 1)
  SELECT user_id, CASE WHEN latest_status IN ('success', 'no_publication') THEN 'healthy' WHEN failures >= 3 THEN 'failing' ELSE 'degraded' END AS health, latest_status, failures, last_success, last_error FROM a""")
def source_health(spark, d):
    kind = F.col("event_type")
    status = F.when(kind == "error", "failed").when(kind == "view", "partial").when(kind == "signup", "no_publication").otherwise("success")
    error = F.when(kind == "error", F.concat(F.lit("code_"), F.col("event_id").cast("string")))
    return runs.source_health(table(spark, d, "events"), "user_id", "ts", "event_id", status, error)


_COUNTS = """SELECT CAST(ts AS DATE) AS day, count(*) AS seen, count(*) FILTER (event_type <> 'error') AS included, count(*) FILTER (event_type = 'error') AS excluded,
  count(*) FILTER (event_type NOT IN ('error', 'signup')) AS privacy_allowed, count(*) FILTER (event_type = 'signup') AS privacy_held,
  count(*) FILTER (event_type IN ('purchase', 'click')) AS approved, count(*) FILTER (event_type = 'view') AS held,
  count(*) FILTER (event_type = 'purchase' AND value > 20) AS created, count(*) FILTER (event_type = 'purchase' AND value <= 20) AS updated, count(*) FILTER (event_type = 'click' AND value <= 50) AS unchanged FROM events GROUP BY 1"""


@query(f"SELECT *, approved <> created + updated + unchanged AS operations_broken FROM ({_COUNTS})")
def run_counters(spark, d):
    kind, value = F.col("event_type"), F.col("value")
    found = runs.counters(table(spark, d, "events"), [F.to_date("ts").alias("day")], {
        "included": kind != "error", "excluded": kind == "error", "privacy_allowed": ~kind.isin("error", "signup"), "privacy_held": kind == "signup",
        "approved": kind.isin("purchase", "click"), "held": kind == "view", "created": (kind == "purchase") & (value > 20),
        "updated": (kind == "purchase") & (value <= 20), "unchanged": (kind == "click") & (value <= 50),
    })
    broken = runs.broken_invariants(found, runs.MANIFEST_CHECKS)
    return found.withColumn("operations_broken", F.array_contains(broken, "operations"))


@query("""WITH w AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n, bool_and(value < 100) AS fine FROM events GROUP BY 1, 2)
  SELECT event_type, max(day) AS completed_until, max(day) - 14 AS next_from FROM w WHERE n >= 5 GROUP BY 1""")
def checkpoint_window(spark, d):
    days = table(spark, d, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    return runs.checkpoint_window(days, ["event_type"], F.col("day"), F.col("n") >= 5, ["n"], 14)


@query("""SELECT event_type, CAST(ts AS DATE) AS day, count(DISTINCT event_id) AS n FROM events GROUP BY 1, 2""")
def overlap_reread(spark, d):
    rows = table(spark, d, "events").select("event_id", "event_type", F.to_date("ts").alias("day"))
    last = rows.agg(F.max("day").alias("last"))
    windows = rows.crossJoin(F.broadcast(last))  # one row
    again = windows.where("day <= last").unionByName(windows.where("day > date_sub(last, 14)"))
    return again.dropDuplicates(["event_id"]).groupBy("event_type", "day").agg(F.count("*").alias("n"))


@query("""SELECT d.doc_id, CASE WHEN l.a IS NULL THEN 'hold' WHEN l.a <> l.b THEN 'conflict' ELSE l.a END AS review FROM documents d
  LEFT JOIN (SELECT doc_id, min(v) AS a, max(v) AS b FROM (SELECT doc_id, CASE WHEN quality = 1 THEN 'approve' ELSE 'reject' END AS v FROM labels) GROUP BY 1) l USING (doc_id)""")
def review_allowlist(spark, d):
    listed = table(spark, d, "labels").select("doc_id", F.when(F.col("quality") == 1, "approve").otherwise("reject").alias("decision"))
    return gates.review_allowlist(table(spark, d, "documents").select("doc_id"), listed, "doc_id", "decision").select("doc_id", "review")


@query("""SELECT d.doc_id, CASE WHEN d.text IS NULL OR d.n_chars < 1 THEN 'hold:integrity' WHEN coalesce(l.toxic, 0) = 1 THEN 'hold:privacy_quarantine' WHEN d.source = 'src0' THEN 'hold:excluded'
  WHEN d.lang = 'en' AND d.n_chars >= 500 AND coalesce(l.quality, 0) = 1 THEN 'candidate:long_english' WHEN d.lang IN ('de', 'fr') AND d.n_chars >= 200 THEN 'candidate:other'
  WHEN d.lang = 'en' AND d.n_chars < 500 THEN 'hold:short' WHEN d.lang = 'en' AND coalesce(l.quality, 0) <> 1 THEN 'hold:quality' WHEN d.lang IN ('de', 'fr') AND d.n_chars < 200 THEN 'hold:short' ELSE 'hold:no_rule' END AS decision
  FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY 1) l USING (doc_id)""")
def rule_policy(spark, d):
    labels = table(spark, d, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    docs = table(spark, d, "documents").join(labels, "doc_id", "left")
    long, good = F.col("n_chars") >= 500, F.coalesce("quality", F.lit(0)) == 1
    rules = [gates.Rule("long_english", F.col("lang") == "en", (("short", long), ("quality", good))), gates.Rule("other", F.col("lang").isin("de", "fr"), (("short", F.col("n_chars") >= 200),))]
    privacy = F.when(F.coalesce("toxic", F.lit(0)) == 1, "quarantine").otherwise("allow")
    return docs.select("doc_id", gates.rule_policy(F.col("text").isNotNull() & (F.col("n_chars") >= 1), privacy, F.col("source") == "src0", rules).alias("decision"))


_CONSUMER = "list_has_any(list_transform(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@([A-Za-z0-9-]+(?:\\.[A-Za-z0-9-]+)+)', 1), lambda x: lower(x)), ['gmail.com', 'hotmail.com', 'outlook.com', 'yahoo.com', 'icloud.com', 'mail6.example.com'])"
_CALLS = "regexp_matches(translate(lower(text), 'áàâäãéèêëíìîïóòôöõúùûüñç', 'aaaaaeeeeiiiiooooouuuunc'), '\\b(?:tel|telefono|movil|phone|call|contacto)[\\s:;,(.\\-]{0,12}(?:\\+34[\\s.-]?)?[6-9][0-9]{2}(?:[\\s.-]?[0-9]{3}){2}')"


@query(f"""WITH t AS (SELECT 'd' || doc_id AS id, text FROM documents UNION ALL SELECT 'c' || conv_id || '/' || turn, text FROM conversations)
  SELECT id, CASE WHEN coalesce({_CONSUMER}, false) OR coalesce({_CALLS}, false) THEN 'quarantine' ELSE 'allow' END AS privacy,
  concat_ws(',', CASE WHEN {_CONSUMER} THEN 'consumer_email:text' END, CASE WHEN {_CALLS} THEN 'contextual_phone:text' END) AS reasons FROM t""")
def privacy_scan(spark, d):
    docs = table(spark, d, "documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), "text")
    turns = table(spark, d, "conversations").select(F.concat(F.lit("c"), F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string"))).alias("id"), "text")
    calls = ("tel", "telefono", "teléfono", "movil", "móvil", "phone", "call", "contacto")  # a wider list than the rules' own
    rules = gates.PrivacyRules(decisions={"consumer_email": "quarantine", "contextual_phone": "quarantine"}, mail_domains=(*gates.MAIL_DOMAINS, "mail6.example.com"), phone_terms=calls)
    found = gates.privacy_decision(docs.unionByName(turns), {"text": F.col("text")}, rules)
    return found.select("id", "privacy", F.array_join("privacy_reasons", ",").alias("reasons"))


@query("""SELECT o_orderkey, substr('TRWAGMYFPDXBNJZSQVHLCKE', CAST(o_orderkey % 23 AS INT) + 1, 1) AS letter,
  CAST(('1' || lpad(CAST(o_custkey AS VARCHAR), 8, '0') || lpad(CAST(o_orderkey AS VARCHAR), 9, '0'))::HUGEINT % 97 AS INT) AS rest FROM orders""")
def checksum_mod(spark, d):
    text = F.concat(F.lit("1"), F.lpad(F.col("o_custkey").cast("string"), 8, "0"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0"))
    return table(spark, d, "orders").select("o_orderkey", canon.person_letter(F.col("o_orderkey")).alias("letter"), canon.mod97(text).alias("rest"))


_NAMES = "(SELECT r_name AS code, lower(r_name) AS name FROM region UNION ALL SELECT 'part:' || p_name, lower(split_part(p_name, ' ', 2)) FROM (SELECT DISTINCT p_name FROM part) UNION ALL SELECT 'the', 'the')"


@query(f"""WITH n AS (SELECT DISTINCT code, name FROM {_NAMES}), w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+')) AS word FROM documents)
  SELECT doc_id, code, count(*)::BIGINT AS n FROM w JOIN n ON w.word = n.name GROUP BY ALL""")
def dictionary_match(spark, d):
    region = table(spark, d, "region").select(F.col("r_name").alias("code"), F.lower("r_name").alias("name"))
    part = table(spark, d, "part").select("p_name").distinct().select(F.concat(F.lit("part:"), F.col("p_name")).alias("code"), F.lower(F.split_part("p_name", F.lit(" "), F.lit(2))).alias("name"))
    names = region.union(part).union(spark.range(1).select(F.lit("the").alias("code"), F.lit("the").alias("name")))
    return match.dictionary_match(table(spark, d, "documents"), "doc_id", F.col("text"), names, "code", F.col("name"))


@query("""WITH s AS (SELECT DISTINCT user_id, CAST(floor(value) AS BIGINT) AS a, CAST(floor(value) AS BIGINT) + 1 + CAST(json_extract(props, '$.k') AS BIGINT) % 8 AS b FROM events)
  SELECT DISTINCT x.user_id, x.a AS start, x.b AS "end" FROM s x JOIN s y ON x.user_id = y.user_id AND y.a <= x.a AND x.b <= y.b AND y.b - y.a > x.b - x.a""")
def span_containment(spark, d):
    start = F.floor("value").cast("long")
    spans = table(spark, d, "events").select("user_id", start.alias("start"), (start + 1 + F.get_json_object("props", "$.k").cast("long") % 8).alias("end"))
    return match.contained(spans, "user_id", 8)


@query("""SELECT page_id, CASE WHEN url IS NULL OR trim(url) = '' THEN 'blank' WHEN regexp_matches(url, '[\\x00-\\x20\\x7f]') THEN 'control'
  WHEN regexp_matches(regexp_replace(url, '%[0-9A-Fa-f]{2}', '', 'g'), '%') THEN 'percent' WHEN lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) <> 'https' THEN 'scheme'
  WHEN regexp_matches(h, '^[0-9.]+$') THEN 'address' WHEN h = 'example.com' OR h LIKE '%.example.com' OR h = 'example.org' OR h LIKE '%.example.org' THEN 'ok' ELSE 'host' END AS verdict
  FROM (SELECT page_id, url, lower(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), ':\\d+$', '')) AS h FROM pages)""")
def url_predicates(spark, d):
    return table(spark, d, "pages").select("page_id", gates.url_verdict(F.col("url"), ("example.com", "example.org")).alias("verdict"))


@query("""SELECT p_partkey, CASE WHEN regexp_matches(lower(p_name), '\\b(bolt|nut|screw)s?\\b') THEN 'fastener' WHEN regexp_matches(lower(p_name), '\\b(ring|gear)s?\\b') THEN 'moving'
  WHEN p_type IN ('PROMO', 'ECONOMY') THEN 'offer' ELSE 'other' END AS category FROM part""")
def category_rules(spark, d):
    name = F.lower("p_name")
    rules = F.when(name.rlike(r"\b(bolt|nut|screw)s?\b"), "fastener").when(name.rlike(r"\b(ring|gear)s?\b"), "moving").when(F.col("p_type").isin("PROMO", "ECONOMY"), "offer")
    return table(spark, d, "part").select("p_partkey", rules.otherwise("other").alias("category"))


@query("""SELECT o_orderkey, c_name, CAST(o_orderdate AS DATE) AS day, o_orderpriority FROM orders JOIN customer ON o_custkey = c_custkey ORDER BY o_orderdate DESC, o_orderkey LIMIT 50""")
def listing_sorted_topk(spark, d):
    top = views.listing(table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")), [F.desc("o_orderdate"), F.asc("o_orderkey")], 50)
    return top.select("o_orderkey", "c_name", F.to_date("o_orderdate").alias("day"), "o_orderpriority")


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH'")
def filters_and(spark, d):
    chosen = {"o_orderstatus": "F", "o_orderpriority": views.known_value("2-HIGH", ["1-URGENT", "2-HIGH"]), "o_custkey": None}
    return views.matching(table(spark, d, "orders"), chosen).select("o_orderkey", "o_orderdate")


@query("""WITH j AS (SELECT o_orderstatus, o_orderpriority, n_name FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey)
  SELECT 'status' AS facet, coalesce(o_orderstatus, 'none') AS bucket, count(*) AS n FROM j GROUP BY 2 UNION ALL SELECT 'priority', coalesce(o_orderpriority, 'none'), count(*) FROM j GROUP BY 2
  UNION ALL SELECT 'nation', coalesce(n_name, 'none'), count(*) FROM j GROUP BY 2""")
def facet_counts(spark, d):
    nation = F.broadcast(table(spark, d, "nation"))  # a fixed list of countries
    rows = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return views.facets(rows, {"status": F.col("o_orderstatus"), "priority": F.col("o_orderpriority"), "nation": F.col("n_name")})


@query("""WITH g AS (SELECT n_name AS name, count(*) AS n FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1)
  SELECT name, n, CAST(round(100.0 * n / greatest(max(n) OVER (), 1)) AS BIGINT) AS share FROM g""")
def authority_groups(spark, d):
    rows = table(spark, d, "supplier").join(F.broadcast(table(spark, d, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))
    return views.grouped(rows, F.col("n_name"))


@query("""SELECT o_orderpriority AS kind, count(*) AS n FROM orders WHERE o_orderdate > DATE '2000-06-30' - 30 AND o_orderdate < DATE '2000-07-01' GROUP BY 1""")
def recent_window_counts(spark, d):
    return views.window_counts(table(spark, d, "orders"), F.to_date("o_orderdate"), F.lit("2000-06-30").cast("date"), 30, F.col("o_orderpriority"))


@query("""SELECT event_id, c_custkey, c_name, CASE event_type WHEN 'purchase' THEN 'amount and status' WHEN 'click' THEN 'other data' ELSE 'status' END AS description
  FROM events JOIN customer ON user_id = c_custkey""")
def changes_feed(spark, d):
    kind = F.col("event_type")
    paths = F.when(kind == "purchase", F.array(F.lit("value"), F.lit("event_type"))).when(kind == "click", F.array(F.lit("props"))).otherwise(F.array(F.lit("event_type")))
    events = table(spark, d, "events").select("event_id", F.col("user_id").alias("c_custkey"), paths.alias("paths"))
    feed = views.changes_feed(events, table(spark, d, "customer").select("c_custkey", "c_name"), "c_custkey", {"value": "amount", "event_type": "status"}, "paths")
    return feed.select("event_id", "c_custkey", "c_name", "description")


@query("SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders) AS has_history FROM customer")
def history_flag_semi(spark, d):
    return views.with_history(table(spark, d, "customer").select("c_custkey"), table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')")
def orphan_anti(spark, d):
    known = table(spark, d, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    return views.orphans(table(spark, d, "lineitem"), known, "l_orderkey").select("l_orderkey", "l_linenumber", "l_partkey")


@query("""SELECT coalesce(c, s) AS nation, CASE WHEN s IS NULL THEN 'left' ELSE 'right' END AS side FROM (SELECT DISTINCT c_nationkey AS c FROM customer WHERE c_acctbal > 9000) FULL OUTER JOIN
  (SELECT DISTINCT s_nationkey AS s FROM supplier) ON c = s WHERE c IS NULL OR s IS NULL""")
def set_operations(spark, d):
    rich = table(spark, d, "customer").where("c_acctbal > 9000").select(F.col("c_nationkey").alias("nation"))
    return views.symmetric_difference(rich, table(spark, d, "supplier").select(F.col("s_nationkey").alias("nation")), "nation")


@query("""SELECT l_orderkey, array_to_string(list_sort(list_distinct(list(l_returnflag))), ',') AS flags, count(DISTINCT l_linestatus) = 1 AS single_status, bool_or(l_quantity > 45) AS bulky FROM lineitem GROUP BY 1""")
def array_set_ops(spark, d):
    sets = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_returnflag").alias("f"), F.collect_set("l_linestatus").alias("s"), F.collect_set("l_quantity").alias("q"))
    return sets.select("l_orderkey", F.array_join(canon.canonical_set(F.col("f")), ",").alias("flags"), (F.size("s") == 1).alias("single_status"), F.exists("q", lambda x: x > 45).alias("bulky"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.missing') AS missing FROM events")
def json_props(spark, d):
    return table(spark, d, "events").select("event_id", F.from_json("props", "k bigint, missing string").alias("p")).select("event_id", "p.k", "p.missing")


@query()
def html_flatten(spark, d):
    return trees.html_links(table(spark, d, "pages"), "page_id", "html")


@query("""WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+')) AS term FROM documents WHERE lang = 'en')
  SELECT term, count(DISTINCT doc_id) AS documents, count(*)::BIGINT AS weight FROM w WHERE term IN ('the', 'licensed', 'license', 'idiot') GROUP BY 1""")
def search_terms(spark, d):
    index = search.postings(table(spark, d, "documents").where("lang = 'en'"), "doc_id", F.col("text"))
    return index.where(F.col("term").isin("the", "licensed", "license", "idiot")).groupBy("term").agg(F.count("*").alias("documents"), F.sum("weight").alias("weight"))


@query("""WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+')) AS term FROM documents)
  SELECT term, count(DISTINCT doc_id) AS documents, count(*)::BIGINT AS weight FROM w GROUP BY 1""")
def term_statistics(spark, d):
    return search.statistics(search.postings(table(spark, d, "documents"), "doc_id", F.col("text")))


@query("""WITH w AS (SELECT doc_id, lower(w) AS term FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[\\p{L}\\p{N}_]+')) AS w FROM documents)),
  p AS (SELECT doc_id, term, count(*) AS n FROM w WHERE term IN ('the', 'license') GROUP BY ALL)
  SELECT doc_id, sum(n)::BIGINT AS score FROM p GROUP BY 1 HAVING count(*) = 2""")
def search_ranked(spark, d):
    index = search.postings(table(spark, d, "documents"), "doc_id", F.col("text"))
    return search.search(index, "doc_id", ["the", "License"])


@query()
def search_excerpt(spark, d):
    return table(spark, d, "documents").select("doc_id", search.excerpt(F.col("text"), "license").alias("excerpt")).where("excerpt is not null")


@query("""WITH r AS (SELECT n_regionkey, abs(hash(n_nationkey)) AS x, sha256(n_nationkey || '|' || n_name) AS h FROM nation)
  SELECT n_regionkey, count(*) AS n, sha256(sha256(string_agg(h, '' ORDER BY h))) AS population_hash FROM r GROUP BY 1""")
def population_hash(spark, d):
    rows = table(spark, d, "nation")
    return identity.population_hash(rows, ["n_regionkey"], F.col("n_nationkey"), F.concat_ws("|", F.col("n_nationkey").cast("string"), "n_name"), parts=1).select("n_regionkey", F.col("n").cast("long").alias("n"), "population_hash")


@query("SELECT event_type, count(*) AS n, sum(event_id)::BIGINT AS ids FROM events GROUP BY 1")
def stream_dedupe_available_now(spark, d):
    """Reads the events as a stream of files, drops what was seen, and counts what the sink kept."""
    base = f"{shared_dir(spark)}/tidemark/stream-{uuid.uuid4().hex}"
    kind = table(spark, d, "events").schema
    stream = incremental.read_stream(spark, f"{d}/events.parquet*", kind)
    seen = incremental.deduplicated(stream.select("event_id", "event_type", "ts"), ["event_id"], "ts")
    incremental.run_available(seen, f"{base}/checkpoint", incremental.append_once(f"{base}/rows", "event_id"))
    rows = spark.read.option("recursiveFileLookup", "true").parquet(f"{base}/rows")
    return rows.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


from . import records, rules, stores  # noqa: E402, F401 register their queries here
