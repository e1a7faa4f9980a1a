"""Queries of sources, stores, streams, texts and diagnoses over the given tables, with the SQL each must equal."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import canon
from ..operators import audit, catalog, normalize, runs, search, views
from ..operators.staging import shared_dir
from ..sources import tables, trees
from ..streaming import incremental
from .queries import query, table

# -- sources and stores -----------------------------------------------------------------------------------------


@query("""WITH p AS (SELECT o_custkey, count(*) AS n, max(o_orderkey) % 3 AS odd FROM orders GROUP BY 1)
  SELECT o_custkey, concat_ws(',', CASE WHEN odd = 1 THEN 'number' END, CASE WHEN odd <> 2 THEN NULL ELSE 'last' END, CASE WHEN n > 12 THEN 'total' END) AS violations FROM p""")
def page_contract(spark, d):
    """What result pages contradict: each customer's orders are a page of 12 at most."""
    made = table(spark, d, "orders").groupBy("o_custkey").agg(F.collect_list("o_orderkey").alias("ids"), F.max("o_orderkey").alias("most"))
    item = lambda k: F.struct(k.alias("id"), F.lit("").alias("code"), F.lit("").alias("title"), F.lit("").alias("received"))
    page = F.struct(F.transform("ids", item).alias("content"), F.lit(0).cast("long").alias("pageNumber"), F.lit(1).cast("long").alias("totalPages"), F.lit(12).cast("long").alias("totalElements"), F.lit(True).alias("first"), (F.col("most") % 3 != 2).alias("last"))
    wanted = F.when(F.col("most") % 3 == 1, 1).otherwise(0)
    rows = made.select("o_custkey", page.alias("page"), wanted.alias("wanted"))
    return rows.select("o_custkey", F.array_join(trees.page_violations(F.col("page"), F.col("wanted")), ",").alias("violations"))


_ENTRIES = """WITH e AS (SELECT user_id::VARCHAR AS id, CAST(ts AS DATE) AS day, event_type FROM events), m AS (SELECT id, max(day) AS day FROM e GROUP BY 1),
  t AS (SELECT e.id, count(DISTINCT event_type) AS n, max(event_type) AS title FROM e JOIN m ON e.id = m.id AND e.day = m.day GROUP BY 1)"""


@query(_ENTRIES + " SELECT id, CASE WHEN n = 1 THEN title END AS title, n > 1 AS contradicts FROM t")
def latest_entries(spark, d):
    """The newest version of each feed entry by instant; entries whose newest versions differ contradict themselves."""
    entries = table(spark, d, "events").select(F.col("user_id").cast("string").alias("id"), F.date_format(F.to_date("ts"), "yyyy-MM-dd'T'00:00:00'Z'").alias("updated"), F.col("event_type").alias("title"))
    newest, torn = trees.latest_entries(entries)
    return newest.select("id", "title", F.lit(False).alias("contradicts")).unionByName(torn.select("id", F.lit(None).cast("string").alias("title"), F.lit(True).alias("contradicts")))


@query("""WITH r AS (SELECT c_custkey AS id, c_mktsegment AS v, c_custkey % 5 AS m FROM customer)
  SELECT id, CASE WHEN m = 1 THEN 'changed' ELSE v END AS v, CASE WHEN m = 1 THEN 3 WHEN m = 2 THEN 2 ELSE 1 END AS seen FROM r WHERE m <> 3""")
def store_versions(spark, d):
    """Appends (one of them of known rows), a merge that changes and deletes, and the table as it is then."""
    kept = tables.KeyedTable(f"{shared_dir(spark)}/tidemark/table-{uuid.uuid4().hex}", "id bigint, v string, seen int", "id")
    kept.create(spark)
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("v"))
    m = F.col("id") % 5
    kept.append(rows.where(m != 2).withColumn("seen", F.lit(1)), ("seen",))
    kept.append(rows.where(m != 1).withColumn("seen", F.lit(2)), ("seen",))  # only keys that are new are written
    changed = rows.where(m.isin(1, 3)).select("id", F.lit("changed").alias("v"), F.lit(3).alias("seen"), (m == 3).alias("gone"))
    kept.merge(changed, "gone", {"value_missing": F.col("v").isNotNull()})
    wrong = kept.problems(spark, F.col("v").isNotNull())
    return kept.read(spark).join(wrong.select(F.col("key").cast("bigint").alias("id")), "id", "left_anti").select("id", "v", "seen")


@query("SELECT c_custkey AS id, c_mktsegment AS v FROM customer WHERE c_custkey = 42")
def store_lookup(spark, d):
    kept = tables.KeyedTable(f"{shared_dir(spark)}/tidemark/table-{uuid.uuid4().hex}", "id bigint, v string", "id")
    kept.create(spark)
    kept.append(table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("v")))
    return kept.get(spark, 42)


@query("""WITH o AS (SELECT o_orderkey AS k, o_orderstatus AS s, sha256(o_orderpriority) AS h, sha256(o_orderpriority || o_orderstatus) AS h2, o_totalprice AS p FROM orders),
  c AS (SELECT k, CASE WHEN s = 'O' THEN h2 ELSE h END AS h, s <> 'P' AS fine, p > 100000 AS approved FROM o)
  SELECT o.k AS record_id, CASE WHEN approved AND fine THEN c.h ELSE o.h END AS content_hash, CASE WHEN NOT approved OR NOT fine THEN 'kept' WHEN s = 'F' AND c.h = o.h THEN 'kept' WHEN s = 'F' OR s = 'O' AND k % 2 = 0 THEN 'update' ELSE 'create' END AS plan
  FROM o JOIN c USING (k) WHERE (approved AND fine) OR s = 'F' OR k % 2 = 0""")
def publication_write(spark, d):
    """Both phases of a publication: a plan over all candidates, then only approved rows that every gate still lets through
    are written; a batch with one spoilt row writes nothing."""
    orders = table(spark, d, "orders")
    price, status = F.col("o_totalprice"), F.col("o_orderstatus")
    kept = tables.KeyedTable(f"{shared_dir(spark)}/tidemark/table-{uuid.uuid4().hex}", "record_id bigint, content_hash string, plan string", "record_id")
    kept.create(spark)
    old = orders.where((status == "F") | (F.col("o_orderkey") % 2 == 0)).select(F.col("o_orderkey").alias("record_id"), canon.sha256(F.col("o_orderpriority")).alias("content_hash"), F.lit("kept").alias("plan"))
    kept.append(old)
    content = F.when(status == "O", F.concat("o_orderpriority", "o_orderstatus")).otherwise(F.col("o_orderpriority"))
    candidates = orders.select(F.col("o_orderkey").alias("record_id"), canon.sha256(content).alias("content_hash"), F.when(status == "P", "quarantine").otherwise("allow").alias("privacy"))
    approved = orders.where(price > 100000).select(F.col("o_orderkey").alias("record_id"))
    audit.publish(audit.publication_plan(candidates, kept.read(spark), approved), candidates, approved, kept)
    spoilt = candidates.withColumn("privacy", F.when(F.col("record_id") % 1000 == 0, "quarantine").otherwise("allow"))  # privacy has changed since the plan
    plan = audit.publication_plan(candidates.withColumn("privacy", F.lit("allow")).withColumn("content_hash", F.lit("x")), kept.read(spark), approved)
    if audit.publish(plan, spoilt.withColumn("content_hash", F.lit("x")), approved, kept).isEmpty():
        raise AssertionError("a spoilt batch was written")
    return kept.read(spark)


@query("""SELECT c_custkey, 'Customer%23' || substr(c_name, 10) || '%2Ex%2Fy%20z' AS safe, sha256(c_name || chr(31) || c_mktsegment) AS digest FROM customer""")
def opaque_keys(spark, d):
    name = F.concat(F.col("c_name"), F.lit(".x/y z"))
    return table(spark, d, "customer").select("c_custkey", canon.safe_name(name).alias("safe"), normalize.digest(F.col("c_name"), F.col("c_mktsegment")).alias("digest"))


@query("SELECT 'brand-' || b AS slug, n AS names FROM (SELECT CAST(split_part(p_brand, '#', 2) AS INT) % 7 AS b, count(DISTINCT p_brand) AS n FROM part GROUP BY 1) WHERE n > 1")
def slug_collisions(spark, d):
    page = canon.slug(F.concat(F.lit("Brand "), (F.split_part("p_brand", F.lit("#"), F.lit(2)).cast("int") % 7).cast("string")))
    return canon.slug_collisions(table(spark, d, "part"), "p_brand", page)


# -- streams ----------------------------------------------------------------------------------------------------


@query("""WITH o AS (SELECT user_id, event_type AS cur, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || event_type AS at, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_type) AS prev, ts FROM events),
  c AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, cur) AS version FROM o WHERE prev IS NULL OR prev <> cur)
  SELECT user_id::VARCHAR AS record_id, CASE WHEN prev IS NULL THEN 'create' ELSE 'update' END AS event, prev AS previous_hash, cur AS content_hash, version FROM c""")
def stream_state_changes(spark, d):
    """Create and update events of a stream of observations with state by key; events are written before states."""
    base = f"{shared_dir(spark)}/tidemark/stream-{uuid.uuid4().hex}"
    stream = incremental.read_stream(spark, f"{d}/events.parquet*", table(spark, d, "events").schema)
    found = incremental.state_changes(stream.withColumn("at", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")), "user_id", "event_type", "at")
    numbered = found.withColumn("event_id", F.concat_ws("/", "record_id", F.col("version").cast("string")))
    sinks = (incremental.append_once(f"{base}/events", "event_id"), incremental.latest_by_key(f"{base}/states", "record_id", "version"))
    incremental.run_available(numbered, f"{base}/checkpoint", incremental.in_order(*sinks))
    return spark.read.option("recursiveFileLookup", "true").parquet(f"{base}/events").select("record_id", "event", "previous_hash", "content_hash", "version")


# -- diagnoses --------------------------------------------------------------------------------------------------


@query("SELECT CASE event_type WHEN 'click' THEN 'http_error' WHEN 'view' THEN 'timeout' ELSE 'other' END AS code, count(*) AS n FROM events GROUP BY 1")
def warning_counts(spark, d):
    code = F.when(F.col("event_type") == "click", "http_error").when(F.col("event_type") == "view", "timeout").otherwise(F.col("props"))
    return audit.warning_counts(table(spark, d, "events").select(F.array(code).alias("codes")), "codes", ("http_error", "timeout"))


@query("""SELECT event_id, CASE event_type WHEN 'view' THEN 'success' WHEN 'click' THEN 'no_publication' WHEN 'signup' THEN 'partial' ELSE 'failed' END AS status, CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 0 WHEN 'signup' THEN 2 ELSE 1 END AS exit_code,
  CASE WHEN event_type IN ('view', 'click') THEN event_type ELSE 'unclassified' END AS reason, CASE event_type WHEN 'view' THEN 'office' WHEN 'click' THEN 'multiple' WHEN 'signup' THEN 'other' END AS family FROM events""")
def run_diagnosis(spark, d):
    kind = F.col("event_type")
    state = F.when(kind == "view", "ok").when(kind == "click", "no_daily_publication").when(kind == "signup", "partial").when(kind == "error", "timeout").otherwise("what?")
    codes = F.when(kind == "view", F.array(F.lit("office_url_invalid"), F.lit("x"))).when(kind == "click", F.array(F.lit("office_url_invalid"), F.lit("bases_url_invalid"))).when(kind == "signup", F.array(F.lit("x"))).otherwise(F.array().cast("array<string>"))
    told = audit.run_status(state)
    return table(spark, d, "events").select("event_id", told["status"].alias("status"), told["exit_code"].alias("exit_code"), audit.closed_reason(kind, ("view", "click")).alias("reason"), audit.failing_family(codes).alias("family"))


@query("SELECT coalesce(e, o) AS event_id, CASE WHEN o IS NULL THEN 'missing' ELSE 'unexpected' END AS problem FROM (SELECT o_orderkey AS e FROM orders WHERE o_orderkey % 3 <> 0) FULL OUTER JOIN (SELECT o_orderkey AS o FROM orders WHERE o_orderkey % 5 <> 0) ON e = o WHERE e IS NULL OR o IS NULL")
def staged_events(spark, d):
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("event_id"))
    return audit.expected_events(rows.where("event_id % 3 <> 0"), rows.where("event_id % 5 <> 0"))


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')")
def shadowed_entries(spark, d):
    gone = table(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    return audit.shadowed(table(spark, d, "lineitem"), gone, "l_orderkey").select("l_orderkey", "l_linenumber")


@query("""SELECT doc_id, n_chars >= 100 AND lang = 'en' AS publishable, CASE WHEN n_chars < 100 THEN 'short' WHEN lang <> 'en' THEN 'language' END AS reason, CASE WHEN lang = 'en' THEN '8 registros' ELSE '3 de 8 registros' END AS label,
  'persistence_blocked' AS persistence FROM documents WHERE source <> 'src1'""")
def public_records(spark, d):
    sources = table(spark, d, "documents").select("source").distinct().withColumn("public_records", F.col("source") != "src1")
    rows = views.public_only(table(spark, d, "documents"), sources, "source")
    told = views.publishable({"short": F.col("n_chars") >= 100, "language": F.col("lang") == "en"})
    held = audit.blocked_plan(rows, F.lit("allow"))
    label = views.count_label(F.when(F.col("lang") == "en", 8).otherwise(3), F.lit(8))
    return held.select("doc_id", told["publishable"].alias("publishable"), told["reason"].alias("reason"), label.alias("label"), "persistence")


@query("""SELECT violation, count(*) AS n FROM (SELECT 'code_invalid' AS violation FROM supplier WHERE s_suppkey % 20 = 0 UNION ALL SELECT 'code_duplicated' FROM supplier GROUP BY CASE WHEN s_suppkey % 20 = 0 THEN -1 ELSE s_suppkey % 60 END HAVING count(*) > 1) GROUP BY 1""")
def registry_check(spark, d):
    """Codes of a gazetteer that are malformed (all the same here) or stand twice."""
    k = F.col("s_suppkey")
    code = F.when(k % 20 == 0, "bad").otherwise(F.concat(F.lit("12"), F.lpad((k % 60).cast("string"), 3, "0")))
    registry = table(spark, d, "supplier").select(code.alias("code"), F.col("s_name").alias("name"))
    return catalog.registry_violations(registry).groupBy("violation").agg(F.count("*").alias("n"))


# -- texts ------------------------------------------------------------------------------------------------------


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) END AS day, CASE WHEN o_totalprice >= 1000 THEN CAST(floor(o_totalprice / 1000) AS BIGINT) || '.' ELSE '' END || CASE WHEN o_totalprice >= 1000 THEN lpad(CAST(CAST(floor(o_totalprice) AS BIGINT) % 1000 AS VARCHAR), 3, '0') ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) END || ',5' AS amount,
  strftime(o_orderdate - INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S') || '.000000Z' AS instant, true AS upper_title, 'Order ' || o_orderkey || CASE WHEN o_orderkey % 2 = 0 THEN ' Council' ELSE '' END AS asked,
  'https://s.example/?q=Order+' || o_orderkey || CASE WHEN o_orderkey % 2 = 0 THEN '+Council' ELSE '' END AS link FROM orders WHERE o_totalprice < 1000000""")
def canonical_texts(spark, d):
    """Dates and amounts as official pages write them, instants in UTC, and what to ask a search engine."""
    n, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    month = F.element_at(F.array(*map(F.lit, canon.MONTHS)), F.month(day))
    said = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("Fecha: "), F.day(day).cast("string"), F.lit(" de "), F.initcap(month), F.lit(" de "), F.date_format(day, "yyyy"))).otherwise("31 de febrero de 2024")
    asked = canon.search_text(F.concat(F.lit(" Order  "), n.cast("string")), [F.lit("OTROS"), F.when(n % 2 == 0, " Council ").otherwise("local")])
    return table(spark, d, "orders").where("o_totalprice < 1000000").select(
        "o_orderkey", canon.spanish_date(said).alias("day"), canon.grouped_decimal(F.concat(F.floor("o_totalprice").cast("string"), F.lit(".5"))).alias("amount"),
        canon.utc_text(F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00"))).alias("instant"), canon.is_upper_title(F.lit("ÓRDENES 1")).alias("upper_title"),
        asked.alias("asked"), canon.search_url("https://s.example/", asked).alias("link"),
    )


@query("SELECT p_partkey, label, text FROM (SELECT p_partkey, 'name' AS label, p_name AS text FROM part UNION ALL SELECT p_partkey, 'type', CASE WHEN p_partkey % 2 = 0 THEN p_type ELSE p_name END FROM part WHERE p_partkey % 2 = 0)")
def search_corpus(spark, d):
    """The labelled texts of the index: one that only repeats another goes."""
    kind = F.when(F.col("p_partkey") % 2 == 0, F.col("p_type")).otherwise(F.concat(F.lit(" "), F.regexp_replace("p_name", " ", "  ")))
    return search.corpus(table(spark, d, "part"), "p_partkey", {"name": (F.col("p_name"), 3), "type": (kind, 1), "none": (F.lit(" "), 1)}).select("p_partkey", "label", "text")


@query("SELECT user_id, event_type, event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id)::INT AS ordinal FROM events")
def ordinals(spark, d):
    return runs.ordinals(table(spark, d, "events"), ["user_id", "event_type"], ["event_id"]).select("user_id", "event_type", "event_id", "ordinal")
