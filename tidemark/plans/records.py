"""Queries of normalisers, policies, catalogues, audits and views over the given tables, with the SQL each must equal."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import canon
from ..operators import audit, catalog, change, gates, identity, normalize, policy, search, views
from .queries import query, table

WEB = "https://www.example.org/"


# -- normalisers ------------------------------------------------------------------------------------------------


@query("""WITH u AS (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN '' ELSE url END AS h, CASE WHEN page_id % 2 = 0 THEN url || '.xml' ELSE '' END AS x, CASE WHEN page_id % 5 = 0 THEN url END AS p FROM pages)
  SELECT page_id, CASE WHEN h <> '' THEN h WHEN x <> '' THEN x ELSE p END AS source_url, array_to_string(list_sort(list_distinct(list_filter([h, x, p], lambda v: v <> ''))), ' ') AS urls FROM u""")
def item_documents(spark, d):
    n, url = F.col("page_id"), F.col("url")
    links = normalize.documents(F.when(n % 3 == 0, "").otherwise(url), F.when(n % 2 == 0, F.concat(url, F.lit(".xml"))).otherwise(""), F.when(n % 5 == 0, url))
    return table(spark, d, "pages").select("page_id", links["source_url"].alias("source_url"), F.array_join(F.transform(links["documents"], lambda x: x["source_url"]), " ").alias("urls"))


def _town(code, name, reason="municipality_exact"):
    return F.struct(F.lit(reason).alias("reason"), code.alias("entity_code"), name.alias("entity_name"), F.lit("title").alias("field"), name.alias("matched_text"), F.lit("official_variant").alias("method"))


def _items(spark, d):
    """Orders as gazette items: the nation is the place, and only some regions are within scope."""
    nation = F.broadcast(table(spark, d, "nation"))  # a fixed list of countries
    rows = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    town = _town(F.concat(F.lit("12"), F.lpad(F.col("n_nationkey").cast("string"), 3, "0")), F.col("n_name"))
    province = _town(F.lit("12"), F.lit("Province"), "province_exact")
    matches = F.when(F.col("n_regionkey") == 0, F.array(town)).when(F.col("n_regionkey") == 1, F.array(town, province)).when(F.col("n_regionkey") == 2, F.array(province)).otherwise(F.array().cast(f"array<{normalize.MATCH}>"))
    section = F.when(F.col("o_orderpriority") == "1-URGENT", " 1 ").when(F.col("o_orderpriority") == "2-HIGH", "2b").when(F.col("o_orderpriority") == "5-LOW", "5A").otherwise("3")
    number = F.col("o_orderkey")
    return rows.select(
        number.alias("number"), F.when(number % 7 == 0, " ").otherwise(F.concat(F.lit("ORD-"), number.cast("string"))).alias("official_id"), F.col("n_nationkey").cast("string").alias("department_code"),
        F.col("n_name").alias("department_name"), F.concat(F.lit("  Order  of "), "c_name", F.lit("\n")).alias("title"), F.to_date("o_orderdate").alias("published_on"), section.alias("section_code"),
        F.concat(F.lit(WEB), number.cast("string")).alias("html_url"), F.lit("").alias("xml_url"), F.lit(None).cast("string").alias("pdf_url"), matches.alias("matches"),
        F.col("o_orderdate").alias("detected"), F.when(number % 11 == 0, F.col("o_orderdate") - F.expr("interval 1 day")).otherwise(F.col("o_orderdate")).alias("checked"),
    )


@query(f"""WITH r AS (SELECT o.*, c_name, n_nationkey, n_name, n_regionkey FROM orders o JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey <= 2),
  k AS (SELECT *, concat_ws(',', CASE WHEN o_orderkey % 7 = 0 THEN 'official_id_missing' END, CASE WHEN o_orderkey % 11 = 0 THEN 'observation_timestamp_order_invalid' END) AS codes FROM r)
  SELECT o_orderkey AS number, codes, CASE WHEN codes = '' THEN CASE o_orderpriority WHEN '1-URGENT' THEN 'regulation' WHEN '2-HIGH' THEN 'employment' WHEN '5-LOW' THEN 'procurement' ELSE 'other' END END AS category,
  CASE WHEN codes = '' THEN 'Order of ' || c_name END AS title, CASE WHEN codes = '' AND n_regionkey = 0 THEN n_name END AS municipality, CASE WHEN codes = '' THEN CASE n_regionkey WHEN 1 THEN 2 ELSE 1 END END::INT AS evidence,
  CASE WHEN codes = '' THEN '{WEB}' || o_orderkey END AS source_url FROM k""")
def official_candidates(spark, d):
    found = normalize.official_candidates(_items(spark, d), F.col("detected"), F.col("checked"))
    c = F.col("candidate")
    return found.select("number", F.array_join("codes", ",").alias("codes"), c["category"].alias("category"), c["title"].alias("title"), c["municipality"].alias("municipality"), F.size(c["territorial_matches"]).alias("evidence"), c["source_url"].alias("source_url")).withColumn("evidence", F.when(F.col("evidence") > 0, F.col("evidence")))


def _grants(spark, d):
    lines = table(spark, d, "lineitem").where("l_quantity > 25")
    detail = lines.groupBy("l_orderkey").agg(F.collect_set("l_returnflag").alias("labels"), F.min("l_linestatus").alias("coofficial"))
    return table(spark, d, "orders"), detail


@query("""WITH g AS (SELECT l_orderkey, list(DISTINCT l_returnflag) AS labels, min(l_linestatus) AS c FROM lineitem WHERE l_quantity > 25 GROUP BY 1)
  SELECT o_orderkey, CASE WHEN list_contains(labels, 'R') THEN 'include' WHEN labels = ['N'] THEN 'out_of_scope' ELSE 'unresolved' END AS scope,
  CASE WHEN list_contains(labels, 'R') THEN 'exact_region' WHEN labels = ['N'] THEN 'exact_disjoint_region' ELSE 'region_not_exactly_mapped' END AS reason,
  CASE WHEN o_orderstatus = 'O' THEN c ELSE o_orderpriority END AS title FROM orders JOIN g ON o_orderkey = l_orderkey""")
def grant_candidates(spark, d):
    orders, detail = _grants(spark, d)
    pairs, _ = normalize.matched_pairs(orders, detail, "o_orderkey", "l_orderkey")
    scope = normalize.label_scope(F.col("labels"), "R", "N")
    title = normalize.preferred_title(F.when(F.col("o_orderstatus") == "O", " ").otherwise(F.col("o_orderpriority")), F.col("coofficial"))
    return pairs.select("o_orderkey", scope["scope"].alias("scope"), scope["reason"].alias("reason"), title.alias("title"))


@query("""SELECT coalesce(o, l) AS key, CASE WHEN l IS NULL THEN 'left' ELSE 'right' END AS side FROM (SELECT DISTINCT o_orderkey AS o FROM orders) FULL OUTER JOIN
  (SELECT DISTINCT l_orderkey AS l FROM lineitem WHERE l_quantity > 25) ON o = l WHERE o IS NULL OR l IS NULL""")
def unmatched_details(spark, d):
    orders, detail = _grants(spark, d)
    return normalize.matched_pairs(orders, detail, "o_orderkey", "l_orderkey")[1]


@query("""SELECT c_custkey, n_name || ' / ' || c_mktsegment AS name, CASE WHEN c_custkey % 2 = 0 THEN 'bdns:invente:I' || c_custkey ELSE 'bdns:derived-authority:' || substr(sha256('{"levels":["' || lower(n_name) || '","' || lower(c_mktsegment) || '"]}'), 1, 20) END AS id
  FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def derived_authority(spark, d):
    rows = table(spark, d, "customer").join(F.broadcast(table(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    code = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit(" I"), F.col("c_custkey").cast("string"))).otherwise("")
    who = normalize.joined_authority([F.col("n_name"), F.lit(" "), F.concat(F.col("c_mktsegment"), F.lit(" "))], code)
    return rows.select("c_custkey", who["name"].alias("name"), who["id"].alias("id"))


@query("""WITH r AS (SELECT c_custkey AS k, n_nationkey AS n, lower(replace(n_name, '_', ' ')) AS f, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey),
  a AS (SELECT k, CASE k % 6 WHEN 0 THEN CASE WHEN n <= 15 THEN 'bop-castellon:municipality:12' || lpad(n::VARCHAR, 3, '0') ELSE 'bop-castellon:authority:ayuntamiento-de-nation-' || n || '-' || substr(sha256('ayuntamiento de ' || f), 1, 16) END
      WHEN 1 THEN CASE WHEN n <= 15 THEN 'bop-castellon:municipality:12' || lpad(n::VARCHAR, 3, '0') END WHEN 2 THEN 'bop-castellon:diputacion:12'
      WHEN 3 THEN 'bop-castellon:authority:ministerio-de-nation-' || n || '-' || substr(sha256('ministerio de ' || f), 1, 16) WHEN 4 THEN 'bop-castellon:authority:consorcio-nation-' || n || '-' || substr(sha256('consorcio ' || f), 1, 16) END AS id FROM r)
  SELECT k AS c_custkey, id, CASE WHEN id IS NULL THEN NULL WHEN k % 6 <= 1 THEN 'municipal' WHEN k % 6 = 2 THEN 'provincial' WHEN k % 6 = 3 THEN 'state' END AS level FROM a""")
def heading_authority(spark, d):
    nation = table(spark, d, "nation")
    rows = table(spark, d, "customer").join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
    head = lambda *parts: F.array(*(F.concat(*(F.lit(x) if isinstance(x, str) else x for x in p)) if isinstance(p, tuple) else F.lit(p) for p in parts))
    name, k = F.col("n_name"), F.col("c_custkey") % 6
    path = (
        F.when(k == 0, head("Consorcio Provincial", ("Ayuntamiento  de ", name), "ANUNCIOS")).when(k == 1, head(("", name))).when(k == 2, head("Diputación Provincial de Castellón", "Anuncios"))
        .when(k == 3, head("Administración del Estado", ("Ministerio de ", name))).when(k == 4, head("Consorcios", ("Consorcio ", name), "Licitaciones")).otherwise(head("Otros", "Varios"))
    )
    registry = nation.where("n_nationkey <= 15").select(F.concat(F.lit("12"), F.lpad(F.col("n_nationkey").cast("string"), 3, "0")).alias("code"), F.col("n_name").alias("name"))
    found = normalize.heading_authority(rows.withColumn("heading_path", path), "heading_path", registry)
    return found.select("c_custkey", F.col("authority.id").alias("id"), F.col("authority.level").alias("level"))


@query("""SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN 'employment' WHEN p_size % 7 = 1 THEN 'grants' WHEN p_size % 7 = 2 THEN 'budget' WHEN p_size % 7 = 3 THEN NULL ELSE 'other' END AS category FROM part""")
def notice_category(spark, d):
    size = F.col("p_size") % 7
    title = F.when(size == 0, "Oposición y contratación").when(size == 1, "CONVOCATORIA DE AYUDAS").when(size == 2, "Presupuestos de 2024").when(size == 3, "  ").otherwise(F.col("p_name"))
    return table(spark, d, "part").select("p_partkey", normalize.title_category(title).alias("category"))


@query("""WITH g AS (SELECT user_id, CAST(ts AS DATE) AS day, list(DISTINCT event_type) AS v FROM events GROUP BY 1, 2)
  SELECT user_id, day, CASE WHEN len(v) = 1 THEN v[1] END AS value, CASE WHEN len(v) > 1 THEN 'structured_fields_inconsistent' END AS code, CASE WHEN len(v) > 1 THEN 'multiple' ELSE 'present' END AS state FROM g""")
def entry_fields(spark, d):
    sets = table(spark, d, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.collect_set("event_type").alias("v"))
    only = normalize.only_value(F.col("v"))
    return sets.select("user_id", "day", only["value"].alias("value"), only["code"].alias("code"), normalize.title_state(F.col("v"))["state"].alias("state"))


@query("""SELECT page_id, CASE WHEN page_id % 3 <> 0 AND url LIKE 'https://%' THEN url END AS url, CASE WHEN page_id % 3 <> 0 AND url NOT LIKE 'https://%' THEN 'office_url_dropped' END AS warning,
  CASE WHEN url LIKE 'https://%' THEN NULL ELSE 'url_invalid' END AS error FROM pages""")
def enriched_block(spark, d):
    link = F.when(F.col("page_id") % 3 != 0, F.col("url"))
    verdict = F.when(F.col("url").startswith("https://"), "ok").otherwise("scheme")
    kept = normalize.optional_url(link, verdict, "office_url_dropped")
    block = normalize.closed_block({"url": F.col("url")}, {"page_missing": F.col("page_id").isNotNull(), "url_invalid": verdict == "ok"})
    return table(spark, d, "pages").select("page_id", kept["url"].alias("url"), kept["warning"].alias("warning"), block["error"].alias("error"))


_ORD = "'ORD ' || o_orderkey"


@query(f"""WITH r AS (SELECT o_orderkey, o_custkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) || '00' AS t FROM orders),
  h AS (SELECT *, '{{"custkey":"' || o_custkey || '","total":"' || regexp_replace(regexp_replace(t, '(\\.\\d*?)0+$', '\\1'), '\\.$', '') || '"}}' AS body FROM r)
  SELECT o_orderkey, CASE WHEN o_orderkey % 50 <> 0 THEN CASE WHEN o_orderkey % 10 = 0 THEN 'rec:orders:' || sha256(body) ELSE 'rec:orders:ord-' || o_orderkey || '-' || substr(sha256({_ORD}), 1, 16) END END AS record_id,
  CASE WHEN o_orderkey % 50 <> 0 THEN CASE WHEN o_orderkey % 10 = 0 THEN 'composite_fingerprint' ELSE 'official_id' END END AS identity_strategy, CASE WHEN o_orderkey % 50 <> 0 THEN sha256(body) END AS content_hash,
  CASE WHEN o_orderkey % 50 <> 0 THEN 1 END AS content_hash_version, CASE WHEN o_orderkey % 50 = 0 THEN 'observation_timestamp_order_invalid' ELSE '' END AS codes FROM h""")
def finalized_orders(spark, d):
    n = F.col("o_orderkey")
    total = F.concat(F.expr("cast(cast(o_totalprice as decimal(18,2)) as string)"), F.lit("00"))
    checked = F.when(n % 50 == 0, F.col("o_orderdate") - F.expr("interval 1 day")).otherwise(F.col("o_orderdate"))
    found = normalize.finalize(
        table(spark, d, "orders"), F.lit("Orders"), {"custkey": F.col("o_custkey").cast("string"), "total": total}, money=("total",),
        official_id=F.when(n % 10 != 0, F.concat(F.lit("ORD "), n.cast("string"))), detected=F.col("o_orderdate"), checked=checked,
    )
    return found.select("o_orderkey", "record_id", "identity_strategy", "content_hash", "content_hash_version", F.array_join("codes", ",").alias("codes"))


@query("""WITH v AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 END AS s, o_orderkey % 3 = 0 AS x FROM orders),
  w AS (SELECT o_orderkey, CASE WHEN coalesce(s, 1) = 2 AND x OR coalesce(s, 1) = 1 AND NOT x THEN coalesce(s, 1) END AS version FROM v)
  SELECT o_orderkey, version, coalesce(version = 1, false) AS comparable FROM w""")
def hash_contract(spark, d):
    stated = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2)
    version = normalize.hash_version(stated, F.col("o_orderkey") % 3 == 0)
    return table(spark, d, "orders").select("o_orderkey", version.alias("version")).withColumn("comparable", normalize.same_contract(F.col("version"), F.lit(1)))


@query("""SELECT event_id, concat_ws(',', CASE WHEN NOT starts_with(props, '{') OR CAST(json_extract(props, '$.k') AS BIGINT) > 90 THEN 'k_invalid' END, CASE WHEN event_type NOT IN ('view', 'click', 'purchase', 'signup') THEN 'type_unknown' END, CASE WHEN value < 5 THEN 'value_small' END) AS violations FROM events""")
def row_violations(spark, d):
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    checks = {"type_unknown": audit.one_of(F.col("event_type"), ("view", "click", "purchase", "signup")), "value_small": F.col("value") >= 5, "k_invalid": k <= 90, "instant_invalid": F.col("ts").isNotNull(), "hash_invalid": audit.sha256_text(F.sha2(F.col("event_id").cast("string"), 256))}
    return audit.violations(table(spark, d, "events"), checks).select("event_id", F.array_join("violations", ",").alias("violations"))


# -- gates and policies -----------------------------------------------------------------------------------------

_LETTER = "substr('TRWAGMYFPDXBNJZSQVHLCKE', CAST(c_custkey % 23 AS INT) + 1, 1)"


@query(f"""SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'personal_identifier' WHEN 1 THEN CASE WHEN {_LETTER} = 'A' THEN 'personal_identifier' ELSE 'ambiguous_tax_identifier' END END AS class,
  CASE c_custkey % 4 WHEN 0 THEN 'quarantine' WHEN 1 THEN 'quarantine' WHEN 2 THEN 'quarantine' ELSE 'allow' END AS privacy,
  CASE c_custkey % 4 WHEN 0 THEN 'personal_identifier:title,personal_identifier:tax_identifier' WHEN 1 THEN CASE WHEN {_LETTER} = 'A' THEN 'personal_identifier:title,personal_identifier:tax_identifier' ELSE 'ambiguous_tax_identifier:tax_identifier' END
    WHEN 2 THEN 'private_address:title' ELSE '' END AS reasons FROM customer""")
def privacy_gate(spark, d):
    """Personal numbers in any grouping, tax identifiers by class, stated private addresses."""
    n = F.col("c_custkey")
    eight = F.lpad(n.cast("string"), 8, "0")
    grouped = F.concat(F.substring(eight, 1, 2), F.lit("."), F.substring(eight, 3, 3), F.lit("."), F.substring(eight, 6, 3))
    right, wrong = F.concat(grouped, F.lit("-"), canon.person_letter(n)), F.concat(eight, F.lit("A"))
    tax = F.when(n % 4 == 0, right).when(n % 4 == 1, wrong)
    title = F.when(n % 4 <= 1, F.concat(F.lit("given to "), tax, F.lit("."))).when(n % 4 == 2, F.concat(F.lit("Domicilio particular: calle Mayor "), (n % 90 + 1).cast("string"))).otherwise("calle Mayor, 12")
    found = gates.privacy_decision(table(spark, d, "customer").withColumns({"title": title, "tax": tax}), {"title": F.col("title"), "tax_identifier": F.col("tax")})
    order = F.array_join(F.array_sort("privacy_reasons", lambda a, b: F.when(a > b, -1).when(a < b, 1).otherwise(0)), ",")
    return found.select("c_custkey", canon.tax_class(F.col("tax")).alias("class"), "privacy", order.alias("reasons"))


@query("""SELECT page_id, CASE page_id % 4 WHEN 1 THEN 'quarantine' WHEN 2 THEN 'quarantine' WHEN 3 THEN 'quarantine' ELSE 'allow' END AS privacy,
  CASE page_id % 4 WHEN 1 THEN 'personal_identifier:source_data.office_url' WHEN 2 THEN 'consumer_email:source_data.lines[1]' WHEN 3 THEN 'url_encoding_invalid:source_data.office_url' ELSE '' END AS reasons FROM pages""")
def inspected_fields(spark, d):
    """Nested fields by path, and URLs after every decoding: twice encoded identifiers are found, endless ones held."""
    k = F.col("page_id") % 4
    url = F.when(k == 1, "https://a.example/?q=%2531%2532%2533%2534%2535%2536%2537%2538Z").when(k == 3, "https://a.example/%2525252525252531").otherwise(F.lit("https://a.example/x?y=1"))
    lines = F.when(k == 2, F.array(F.lit("first"), F.lit("ann@gmail.com"))).otherwise(F.array(F.lit("first")))
    rows = gates.inspected_fields(table(spark, d, "pages").select("page_id"), {"title": F.lit("a title"), "description": F.lit(None).cast("string")}, {"source_data.lines": lines}, {"source_data.office_url": url})
    found = gates.scan_fields(rows)
    return found.select("page_id", "privacy", F.array_join("privacy_reasons", ",").alias("reasons"))


#: Titles are parts' names, which end in one of a few nouns.
_RULES = (
    policy.PublicationRule("widgets-1", True, "1", "regulation", ("brand#1", "brand#2", "brand#3", "brand#4", "brand#5"), ("title",), reasons_all=("municipality_exact",), title_any=("widget",), title_not=("cold",)),
    policy.PublicationRule("anvils-2b", True, "2B", "employment", ("brand#6", "brand#7", "brand#8", "brand#9"), ("title", "heading"), reasons_any=("municipality_exact", "province_exact"), title_any=("anvil", "widget")),
)
_POLICY = policy.PublicationPolicy("parts.v1", True, "2024-01-01", _RULES, ("5A",), ("small",))


def _evaluated(spark, d, shadow=False):
    n, size = F.col("p_partkey"), F.col("p_size") % 5
    section = F.when(size == 0, " 1").when(size == 1, "2b").when(size == 2, "5A").when(size == 3, "9").otherwise(" ")
    match = F.when(n % 3 == 0, F.array(_town(F.lit("12001"), F.lit("x")))).when(n % 3 == 1, F.array(_town(F.lit("12"), F.lit("y"), "province_exact"))).otherwise(F.array().cast(f"array<{normalize.MATCH}>"))
    manual = F.when(n % 11 == 0, "approved").when(n % 11 == 1, "rejected").when(n % 11 == 2, "hold")
    rows = table(spark, d, "part").withColumns({"section": section, "manual": manual, "privacy": F.when(n % 13 == 0, "quarantine").otherwise("allow")})
    told = policy.evaluate(
        _POLICY, integrity=n % 17 != 0, privacy=F.col("privacy"), section=F.col("section"), title=F.lower("p_name"), category=normalize.section_category(F.col("section")), department=F.lower("p_brand"), matches=match,
        manual=F.col("manual"), manual_reason=F.lit("pending"), shadow=shadow,
    )
    return rows.withColumn("e", told)


_EVALUATED = """WITH p AS (SELECT p_partkey AS n, p_size % 5 AS s, lower(p_name) AS t, CAST(split_part(p_brand, '#', 2) AS INT) AS b FROM part),
  w AS (SELECT *, regexp_matches(t, '(^|\\W)widget(e?s)?($|\\W)') AS is_w, regexp_matches(t, '(^|\\W)anvil(e?s)?($|\\W)') AS is_a, regexp_matches(t, '(^|\\W)cold(e?s)?($|\\W)') AS is_c, regexp_matches(t, '(^|\\W)small(e?s)?($|\\W)') AS is_s FROM p),
  e AS (SELECT *, CASE WHEN n % 17 = 0 THEN 'deny:record_integrity_failure' WHEN n % 13 = 0 THEN 'deny:privacy_quarantine' WHEN s = 4 THEN 'unresolved:missing_section' WHEN n % 3 = 2 THEN 'unresolved:missing_territorial_inclusion'
    WHEN n % 11 = 1 THEN 'deny:manual_rejected' WHEN n % 11 = 2 THEN 'hold:manual_hold_pending' WHEN n % 11 = 0 THEN 'manual_approved:manual_approved' WHEN s = 2 THEN 'hold:excluded_section' WHEN is_s THEN 'hold:excluded_title_term' WHEN s = 3 THEN 'hold:no_rule_for_section'
    WHEN s = 0 THEN CASE WHEN b > 5 THEN 'hold:department_not_allowed' WHEN n % 3 <> 0 THEN 'hold:territorial_requirements_not_met' WHEN is_c THEN 'hold:rule_title_exclusion' WHEN NOT is_w THEN 'hold:title_pattern_not_matched' ELSE 'candidate:rule_matched' END
    ELSE CASE WHEN b < 6 OR b > 9 THEN 'hold:department_not_allowed' WHEN NOT is_w AND NOT is_a THEN 'hold:title_pattern_not_matched' ELSE 'candidate:rule_matched' END END AS told FROM w)"""


@query(_EVALUATED + """, f AS (SELECT *, split_part(told, ':', 1) AS outcome, split_part(told, ':', 2) AS reason FROM e)
  SELECT n AS p_partkey, outcome, reason, CASE WHEN outcome = 'candidate' THEN CASE s WHEN 0 THEN 'widgets-1' ELSE 'anvils-2b' END END AS rule_id,
  CASE WHEN reason = 'record_integrity_failure' THEN 'abort' WHEN n % 11 <> 1 AND (starts_with(reason, 'privacy_') OR outcome = 'unresolved') THEN 'hold' WHEN n % 11 = 0 THEN 'approved' WHEN n % 11 = 1 THEN 'rejected' WHEN n % 11 = 2 THEN 'hold' WHEN outcome = 'candidate' THEN 'approved' ELSE 'hold' END AS decision,
  CASE WHEN n % 13 = 0 THEN NULL WHEN outcome = 'manual_approved' THEN 'manual-review' WHEN outcome = 'candidate' THEN 'parts.v1' END AS policy_id FROM f""")
def policy_evaluation(spark, d):
    rows = _evaluated(spark, d)
    decided = policy.publication_decision(F.col("e"), F.col("manual"))
    rows = rows.withColumn("d", decided)
    grant = policy.authorisation(F.col("privacy") == "allow", F.col("d.decision"), F.col("manual"), F.col("e"), _POLICY.policy_id)
    return rows.select("p_partkey", "e.outcome", "e.reason", "e.rule_id", "d.decision", grant.alias("policy_id"))


@query(_EVALUATED + " SELECT CASE s WHEN 0 THEN '1' WHEN 1 THEN '2B' WHEN 2 THEN '5A' WHEN 3 THEN '9' ELSE '?' END AS section, split_part(told, ':', 1) AS outcome, split_part(told, ':', 2) AS reason, count(*) AS n FROM e GROUP BY ALL")
def policy_simulation(spark, d):
    section = F.upper(F.trim("section"))
    return policy.simulate(_evaluated(spark, d, shadow=True), [F.when(section == "", "?").otherwise(section).alias("section")], F.col("e.outcome"), F.col("e.reason"))


@query("""WITH q AS (SELECT CASE WHEN p_partkey % 11 = 0 THEN 'manual_approved' WHEN p_partkey % 11 = 1 THEN 'deny' WHEN p_partkey % 11 = 2 THEN 'hold' ELSE 'unresolved' END AS outcome FROM part)
  SELECT o.outcome, count(q.outcome) AS n FROM (VALUES ('candidate'), ('hold'), ('deny'), ('unresolved'), ('manual_approved')) o(outcome) LEFT JOIN q ON q.outcome = o.outcome GROUP BY 1""")
def queue_simulation(spark, d):
    n = F.col("p_partkey")
    told = policy.queue_outcome(F.when(n % 11 == 0, "approved").when(n % 11 == 1, "rejected").when(n % 11 == 2, "hold"), F.lit("pending"))
    rows = policy.simulate(table(spark, d, "part").withColumn("t", told), [F.col("p_brand")], F.col("t.outcome"), F.col("t.reason"))
    return policy.outcome_totals(rows)


@query("""WITH r AS (SELECT doc_id, source, CASE WHEN doc_id % 5 = 0 THEN 'quarantine' ELSE 'allow' END AS p, n_chars >= 300 AS long FROM documents)
  SELECT doc_id, CASE WHEN source = 'src0' THEN 'hold' ELSE 'eligible' END AS eligibility, CASE WHEN p <> 'allow' OR source = 'src0' THEN NULL WHEN long THEN 'publishable_metadata' ELSE 'hold' END AS metadata, CASE WHEN p = 'allow' THEN 'hold' ELSE p END AS barred FROM r""")
def source_switch(spark, d):
    rows = policy.source_eligibility(table(spark, d, "documents"), "source", {"src0": "source_publication_hold"})
    privacy = F.when(F.col("doc_id") % 5 == 0, "quarantine").otherwise("allow")
    told = policy.metadata_decision(privacy, F.col("eligibility") == "eligible", F.col("n_chars") >= 300)
    return rows.select("doc_id", "eligibility", told["metadata"].alias("metadata"), policy.always_held(privacy)["decision"].alias("barred"))


# -- catalogue --------------------------------------------------------------------------------------------------

_KINDS = {"BUILDING": "municipality", "MACHINERY": "municipality", "HOUSEHOLD": "sub_municipal"}


def _catalog(spark, d):
    n = F.col("c_custkey")
    raw = table(spark, d, "customer").select(
        F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.concat(F.lit("12"), F.lpad((n % 900).cast("string"), 3, "0"))).alias("ine"), F.concat(F.when(n % 41 == 0, "X").otherwise("L"), F.lpad((n % 800).cast("string"), 8, "0")).alias("dir3"),
        F.when(n % 37 != 0, F.col("c_name")).alias("name"), F.col("c_mktsegment").alias("type"),
        F.when(n % 3 == 0, F.concat(F.lit("www.town"), n.cast("string"), F.lit(".example"))).when(n % 3 == 1, "https://u:p@town.example").alias("web"), F.when(n % 2 == 0, "http://town.example:70000/x").alias("office"),
    )
    registry = table(spark, d, "supplier").select(F.concat(F.lit("12"), F.lpad((F.col("s_suppkey") * 7 % 1000).cast("string"), 3, "0")).alias("code"), F.col("s_name").alias("name")).groupBy("code").agg(F.min("name").alias("name"))
    return catalog.build_catalog(raw, registry, _KINDS)


_CATALOG = """WITH raw AS (SELECT CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN '12' || lpad((c_custkey % 900)::VARCHAR, 3, '0') END AS ine, CASE WHEN c_custkey % 41 = 0 THEN 'X' ELSE 'L' END || lpad((c_custkey % 800)::VARCHAR, 8, '0') AS dir3,
    CASE WHEN c_custkey % 37 <> 0 THEN c_name END AS name, c_mktsegment AS type, c_custkey % 3 AS w, c_custkey % 2 AS o FROM customer),
  reg AS (SELECT '12' || lpad((s_suppkey * 7 % 1000)::VARCHAR, 3, '0') AS code, min(s_name) AS rname FROM supplier GROUP BY 1),
  ok AS (SELECT * FROM raw WHERE name IS NOT NULL AND dir3 LIKE 'L%'),
  di AS (SELECT ine, count(DISTINCT dir3) AS p FROM ok WHERE ine IS NOT NULL GROUP BY 1 HAVING count(*) > 1), dd AS (SELECT dir3, count(DISTINCT coalesce(ine, '')) AS p FROM ok GROUP BY 1 HAVING count(*) > 1),
  one AS (SELECT ok.*, CASE WHEN type IN ('BUILDING', 'MACHINERY') THEN 'municipality' WHEN type = 'HOUSEHOLD' THEN 'sub_municipal' END AS kind, rname FROM ok LEFT JOIN reg ON ok.ine = code WHERE coalesce(ok.ine NOT IN (SELECT ine FROM di), true) AND dir3 NOT IN (SELECT dir3 FROM dd)),
  pr AS (SELECT *, CASE WHEN kind IS NULL THEN 'unknown_entity_type' WHEN kind = 'municipality' AND rname IS NULL THEN 'unknown_ine' END AS problem FROM one)"""


@query(_CATALOG + """ SELECT issue, blocking, ine, dir3, count(*) AS n FROM (SELECT 'invalid_record' AS issue, true AS blocking, ine, dir3 FROM raw WHERE name IS NULL OR dir3 NOT LIKE 'L%'
  UNION ALL SELECT 'link_rejected:web:userinfo_not_allowed', false, ine, dir3 FROM ok WHERE w = 1 UNION ALL SELECT 'link_rejected:office:invalid_port', false, ine, dir3 FROM ok WHERE o = 0
  UNION ALL SELECT 'duplicate_ine', true, ine, NULL FROM di UNION ALL SELECT 'duplicate_dir3', true, NULL, dir3 FROM dd UNION ALL SELECT 'ine_dir3_conflict', true, ine, NULL FROM di WHERE p > 1 UNION ALL SELECT 'ine_dir3_conflict', true, NULL, dir3 FROM dd WHERE p > 1
  UNION ALL SELECT problem, true, ine, dir3 FROM pr WHERE problem IS NOT NULL UNION ALL SELECT 'missing_in_dataset', true, code, NULL FROM reg WHERE code NOT IN (SELECT ine FROM ok WHERE ine IS NOT NULL)) GROUP BY ALL""")
def catalog_issues(spark, d):
    return _catalog(spark, d)[1].groupBy("issue", "blocking", "ine", "dir3").agg(F.count("*").alias("n"))


@query(_CATALOG + " SELECT kind, count(*) AS entities, count(*) FILTER (w = 0)::BIGINT AS valid_links, (count(*) FILTER (w = 1) + count(*) FILTER (o = 0))::BIGINT AS rejected_links FROM pr WHERE problem IS NULL GROUP BY 1")
def catalog_summary(spark, d):
    return catalog.snapshot_summary(_catalog(spark, d)[0])


# -- audits -----------------------------------------------------------------------------------------------------


@query("""WITH k AS (SELECT o_orderkey, o_orderkey % 97 = 0 AS lost, o_orderkey % 89 = 0 AS late, o_orderkey % 83 = 0 AS odd, o_orderkey % 79 = 0 AS drift FROM orders)
  SELECT o_orderkey::VARCHAR AS key, CASE WHEN lost THEN 'incomplete_batch' WHEN late OR odd THEN 'evidence_conflict' ELSE 'source_drift' END AS code FROM k WHERE lost OR late OR odd OR drift""")
def migration_check(spark, d):
    n = F.col("o_orderkey")
    rows = table(spark, d, "orders").select(n.alias("record_id"), F.lit("orders").alias("source"), F.col("o_orderdate").alias("detected_at"), F.sha2(n.cast("string"), 256).alias("h1"), F.sha2(F.concat(F.lit("2:"), n.cast("string")), 256).alias("h2"))
    k = F.col("record_id")
    originals = rows.select("record_id", F.lit(1).alias("version"), "source", "detected_at", F.col("h1").alias("content_hash"))
    shifted = F.when(k % 89 == 0, F.col("detected_at") + F.expr("interval 1 day")).otherwise(F.col("detected_at"))
    prepared = rows.where(k % 97 != 0).select("record_id", F.lit(2).alias("version"), "source", shifted.alias("detected_at"), F.col("h2").alias("content_hash"), F.when(k % 79 == 0, F.col("h2")).otherwise(F.col("h1")).alias("v1_hash"))
    evidence = rows.select("record_id", F.col("h1").alias("from_hash"), F.when(k % 83 == 0, F.col("h1")).otherwise(F.col("h2")).alias("to_hash"))
    return audit.validate_migration(originals, prepared, evidence)


@query("SELECT count(*) FILTER (s IS NULL) + count(*) FILTER (c IS NULL) = 0 AS equal, count(*) FILTER (s IS NULL) AS only_left, count(*) FILTER (c IS NULL) AS only_right FROM (SELECT DISTINCT c_custkey AS c FROM customer) FULL OUTER JOIN (SELECT DISTINCT s_suppkey + 50 AS s FROM supplier) ON c = s")
def set_equality(spark, d):
    return audit.same_set(table(spark, d, "customer").select(F.col("c_custkey").alias("k")), table(spark, d, "supplier").select((F.col("s_suppkey") + 50).alias("k")), "k")


@query("SELECT 'customer' AS kind, c_custkey AS key, 'left' AS side FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders) UNION ALL SELECT 'order', o_custkey, 'right' FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 10 <> 0))")
def lone_keys(spark, d):
    """Customers without an order, and customers of orders that a part of the customer table lacks."""
    customer, orders = table(spark, d, "customer"), table(spark, d, "orders").select(F.col("o_custkey").alias("key"))
    left = views.symmetric_difference(customer.select(F.col("c_custkey").alias("key")), orders, "key").where("side = 'left'").select(F.lit("customer").alias("kind"), "key", "side")
    right = views.symmetric_difference(customer.where("c_custkey % 10 <> 0").select(F.col("c_custkey").alias("key")), orders, "key").where("side = 'right'").select(F.lit("order").alias("kind"), "key", "side")
    return left.unionByName(right)


@query("""WITH c AS (SELECT o_orderkey AS k, 'h' || o_orderstatus AS h, o_orderpriority = '1-URGENT' AS bad FROM orders WHERE o_orderkey % 2 = 0), a AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 3 = 0)
  SELECT coalesce(c.k, a.k) AS record_id, CASE WHEN c.k IS NULL THEN 'missing' WHEN bad THEN 'blocked' WHEN a.k IS NULL THEN 'held' WHEN c.k % 5 = 0 THEN 'create' WHEN h <> 'hF' THEN 'update' ELSE 'no_change' END AS plan,
  CASE WHEN coalesce(c.k, a.k) % 5 <> 0 THEN 'hF' END AS previous_hash, h AS content_hash FROM c FULL OUTER JOIN a ON c.k = a.k""")
def publication_plan(spark, d):
    orders = table(spark, d, "orders").withColumn("record_id", F.col("o_orderkey"))
    hashed = F.concat(F.lit("h"), F.col("o_orderstatus")).alias("content_hash")
    candidates = orders.where("o_orderkey % 2 = 0").select("record_id", hashed, F.when(F.col("o_orderpriority") == "1-URGENT", "quarantine").otherwise("allow").alias("privacy"))
    known = orders.where("o_orderkey % 5 <> 0").select("record_id", F.lit("hF").alias("content_hash"))
    return audit.publication_plan(candidates, known, orders.where("o_orderkey % 3 = 0"))


@query("""WITH s AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 9 = 0 THEN 'not_attempted' WHEN o_orderkey % 7 = 0 THEN 'rejected' WHEN o_orderstatus = 'F' THEN 'identical' ELSE 'modified' END AS o FROM orders WHERE o_orderkey % 2 = 0)
  SELECT count(*) AS selected, count(*) FILTER (o = 'identical') AS identical, count(*) FILTER (o = 'modified') AS modified, count(*) FILTER (o = 'rejected') AS rejected, count(*) FILTER (o = 'not_attempted') AS not_attempted,
  count(*) FILTER (o IN ('identical', 'modified')) AS accepted, 'partial' AS status FROM s""")
def recheck_totals(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("record_id"), F.col("o_orderstatus").alias("content_hash"))
    k = F.col("record_id")
    first = orders.where(k % 9 != 0)
    second = first.withColumn("content_hash", F.when(k % 7 == 0, "?").otherwise(F.col("content_hash")))
    stable = audit.stable_reads(first, second, "record_id", "content_hash")
    known = orders.withColumn("content_hash", F.lit("F"))
    return audit.recheck_totals(audit.recheck(orders.where(k % 2 == 0), first.join(stable, "record_id"), known))


_EV = """'evt-v1-' || sha256('["' || o_orderkey || '","create",null,"' || o_orderstatus || '"]')"""


@query(f"""WITH e AS (SELECT o_orderkey, {_EV} AS id FROM orders WHERE o_orderkey % 4 = 0)
  SELECT 'records' AS kind, o_orderkey::VARCHAR AS key, 'content_hash' AS code FROM orders WHERE o_orderkey % 31 = 0 AND o_orderkey % 5 <> 0 UNION ALL SELECT 'events', CASE WHEN o_orderkey % 3 = 0 THEN 'wrong' || o_orderkey ELSE id END, 'event_without_record' FROM e WHERE o_orderkey % 5 = 0
  UNION ALL SELECT 'events', 'wrong' || o_orderkey, 'event_identity' FROM e WHERE o_orderkey % 3 = 0 UNION ALL SELECT 'runs', user_id::VARCHAR, 'counters' FROM events GROUP BY user_id HAVING count(*) FILTER (event_type = 'signup') > 0""")
def lake_audit(spark, d):
    orders = table(spark, d, "orders").withColumn("record_id", F.col("o_orderkey").cast("string"))
    records = orders.where("o_orderkey % 5 <> 0").withColumn("content_hash", F.when(F.col("o_orderkey") % 31 == 0, "x").otherwise(F.sha2("record_id", 256)))
    right = identity.event_id(F.col("record_id"), F.lit("create"), F.lit(None).cast("string"), F.col("o_orderstatus"))
    events = orders.where("o_orderkey % 4 = 0").withColumn("event_id", F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("wrong"), "record_id")).otherwise(right))
    kind = F.col("event_type")
    made = table(spark, d, "events").groupBy(F.col("user_id").alias("run_id")).agg(F.count("*").alias("seen"), F.count_if(kind.isin("view", "click")).alias("included"), F.count_if(kind.isin("purchase", "error")).alias("excluded"))
    return audit.audit(records, events, made, F.sha2("record_id", 256), right)


@query("""SELECT 'customer' AS kind, (SELECT count(*) FROM customer) AS n UNION ALL SELECT 'orders', (SELECT count(*) FROM orders) UNION ALL SELECT 'none', 0""")
def artefact_counts(spark, d):
    orders = table(spark, d, "orders")
    return audit.artefact_counts({"customer": table(spark, d, "customer"), "orders": orders, "none": orders.where("false")})


@query("""WITH i AS (SELECT n_regionkey AS id, count(*) AS n, count(DISTINCT n_name) > 1 AS c, count(*) FILTER (n_nationkey % 4 = 0) AS f FROM nation GROUP BY 1)
  SELECT sum(n)::BIGINT AS rows, count(*) AS unique_ids, sum(f)::BIGINT AS fallbacks, count(*) FILTER (c) AS collisions, NOT bool_or(c) AS hashes_stable FROM i""")
def identity_report(spark, d):
    rows = table(spark, d, "nation").withColumn("strategy", F.when(F.col("n_nationkey") % 4 == 0, "composite_fingerprint").otherwise("official_id"))
    return audit.identity_report(rows, "n_regionkey", "strategy", "n_name", "n_name")


@query("""WITH k AS (SELECT o_orderkey AS id, o_orderkey % 8 AS m FROM orders) SELECT id AS record_id, CASE m WHEN 1 THEN 'incompatible_creates' WHEN 2 THEN 'order_ambiguous' WHEN 3 THEN 'create_after_update' WHEN 4 THEN 'disconnected_or_forked' WHEN 5 THEN 'tip_mismatch' WHEN 7 THEN 'event_without_record' END AS code FROM k WHERE m NOT IN (0, 6)""")
def history_validation(spark, d):
    """Eight kinds of history: plain, broken in six ways, and one that takes a transition it has seen before again."""
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("record_id"), (F.col("o_orderkey") % 8).alias("m"))
    step = lambda at, kind, before, after: F.struct(F.lit(at).alias("observed_at"), F.lit(kind).alias("type"), F.lit(before).cast("string").alias("previous_hash"), F.lit(after).alias("content_hash"))
    made, ab, bc, ba = step(1, "create", None, "a"), step(2, "update", "a", "b"), step(3, "update", "b", "c"), step(3, "update", "b", "a")
    path = (
        F.when(F.col("m") == 1, F.array(made, step(2, "create", None, "b"))).when(F.col("m") == 2, F.array(made, ab, step(2, "update", "b", "c"))).when(F.col("m") == 3, F.array(step(0, "update", "x", "a"), made, ab))
        .when(F.col("m") == 4, F.array(made, ab, step(3, "update", "z", "c"))).when(F.col("m") == 6, F.array(made, ab, ba, step(4, "update", "b", "c"))).otherwise(F.array(made, ab, bc))
    )
    events = orders.select("record_id", F.explode(path).alias("x")).select("record_id", "x.*")
    records = orders.where("m <> 7").select("record_id", F.when(F.col("m") == 5, "q").otherwise("c").alias("content_hash"))
    return audit.validate_history(events, records)


# -- nested differences -----------------------------------------------------------------------------------------


def _bodies(spark, d, changed):
    n = F.col("p_partkey")
    price = F.expr("cast(cast(p_retailprice as decimal(12,2)) as string)")
    body = F.struct(
        F.struct(F.when((n % 5 != 0) | F.lit(not changed), price).alias("value"), F.lit("EUR").alias("currency")).alias("budget"),
        F.when((n % 7 != 0) | F.lit(not changed), F.struct(F.col("p_brand").alias("name"))).alias("maker"),
        F.array(*(F.struct(F.lit(str(k)).alias("cve"), F.when((n % 3 != 0) | F.lit(not changed), F.col("p_type")).alias("title")) for k in (1, 2))).alias("extracts"),
        F.when((n % 11 == 0) & F.lit(changed), F.concat("p_name", F.lit("!"))).otherwise(F.col("p_name")).alias("title"),
    )
    return table(spark, d, "part").select("p_partkey", body.alias("body"))


@query("""WITH p AS (SELECT *, CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) AS price FROM part)
  SELECT p_partkey, 'budget.value' AS path, price AS old, NULL AS new FROM p WHERE p_partkey % 5 = 0 UNION ALL SELECT p_partkey, 'maker', '{"name":"' || p_brand || '"}', NULL FROM p WHERE p_partkey % 7 = 0 UNION ALL SELECT p_partkey, 'title', p_name, p_name || '!' FROM p WHERE p_partkey % 11 = 0
  UNION ALL SELECT p_partkey, 'extracts', '[{"cve":"1","title":"' || p_type || '"},{"cve":"2","title":"' || p_type || '"}]', '[{"cve":"1"},{"cve":"2"}]' FROM p WHERE p_partkey % 3 = 0""")
def nested_diff(spark, d):
    return change.diff_nested(_bodies(spark, d, False), _bodies(spark, d, True), "p_partkey", "body")


@query("SELECT p_partkey, p_partkey % 5 = 0 OR p_partkey % 7 = 0 OR p_partkey % 3 = 0 AS loses FROM part")
def nested_loss(spark, d):
    before, after = _bodies(spark, d, False), _bodies(spark, d, True).withColumnRenamed("body", "after")
    return before.join(after, "p_partkey").select("p_partkey", change.loses_nested(F.col("body"), F.col("after"), before.schema["body"].dataType).alias("loses"))


# -- views ------------------------------------------------------------------------------------------------------

_MONTHS = "['enero', 'febrero', 'marzo', 'abril', 'mayo', 'junio', 'julio', 'agosto', 'septiembre', 'octubre', 'noviembre', 'diciembre'][month(v)]"


@query(f"""WITH r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'bdns' ELSE 'boe' END AS s, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderdate AS DATE) END AS p, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderdate AS DATE) + 1 END AS q, CAST(o_orderdate AS DATE) + 2 AS t, o_orderpriority FROM orders),
  w AS (SELECT *, coalesce(p, CASE WHEN s = 'bdns' THEN q END, t) AS v FROM r)
  SELECT o_orderkey, v AS value, CASE WHEN p IS NOT NULL THEN 'Publicado' WHEN s = 'bdns' AND q IS NOT NULL THEN 'Recibida en BDNS' ELSE 'Detectado' END AS label, day(v) || ' de ' || {_MONTHS} || ' de ' || year(v) AS display,
  CASE s WHEN 'boe' THEN 'Sección del BOE' ELSE 'Organismo' END AS authority_label, s <> 'boe' AS shows_level, CASE WHEN s = 'bdns' AND q IS NOT NULL THEN q END AS deadline FROM w""")
def record_view(spark, d):
    n, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    source, received = F.when(n % 2 == 0, "bdns").otherwise("boe"), F.when(n % 5 != 0, F.date_add(day, 1))
    shown = views.primary_date(F.when(n % 3 == 0, day), received, F.date_add(day, 2), source)
    return table(spark, d, "orders").select(
        "o_orderkey", shown["value"].alias("value"), shown["label"].alias("label"), canon.date_display(shown["value"]).alias("display"), views.authority_label(source, F.col("o_orderpriority"))["label"].alias("authority_label"),
        views.shows_level(source, F.lit("state")).alias("shows_level"), views.official_deadline(source, received, F.lit(" "))["date"].alias("deadline"),
    )


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 <> 2 THEN '12' || lpad((c_custkey % 1000)::VARCHAR, 3, '0') END AS code, CASE c_custkey % 3 WHEN 0 THEN 'convocante' WHEN 1 THEN 'relacionado' END AS role FROM customer""")
def derived_municipality(spark, d):
    n = F.col("c_custkey")
    name = F.concat(F.lit("Vila "), n.cast("string"))
    town = _town(F.concat(F.lit("12"), F.lpad((n % 1000).cast("string"), 3, "0")), name)
    town = F.struct(*(town[c].alias(c) for c in ("reason", "entity_code")), F.concat(name, F.lit("/Villa "), n.cast("string")).alias("entity_name"), *(town[c].alias(c) for c in ("field", "matched_text", "method")))
    other = F.struct(F.lit("municipality_exact").alias("reason"), F.lit("12999x").alias("entity_code"), name.alias("entity_name"), F.lit("title").alias("field"), name.alias("matched_text"), F.lit("official_variant").alias("method"))
    title = F.concat(F.when(n % 3 == 0, "Resolución de 3 de mayo de 2024, del Ayuntamiento de ").otherwise("Obras cerca de "), name, F.lit(", sobre obras"))
    found = views.derived_municipality(F.lit("boe"), title, F.when(n % 3 == 2, F.array(other)).otherwise(F.array(other, town)))
    return table(spark, d, "customer").select("c_custkey", found["code"].alias("code"), found["role"].alias("role"))


@query("SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id)::INT AS place FROM events")
def timeline(spark, d):
    return views.timeline(table(spark, d, "events"), "user_id", "ts", "event_id").select("user_id", "event_id", "place")


@query("""WITH s AS (SELECT n_nationkey AS source_id FROM nation), h AS (SELECT c_nationkey AS source_id, max(c_acctbal) > 9000 AS rich FROM customer GROUP BY 1),
  r AS (SELECT s_nationkey AS source_id, count(*) AS runs, arg_max(s_name, s_suppkey) AS latest FROM supplier GROUP BY 1), q AS (SELECT c_nationkey AS source_id, count(*) AS n FROM customer WHERE c_mktsegment = 'BUILDING' GROUP BY 1)
  SELECT source_id, rich, coalesce(runs, 0) AS runs, latest AS latest_status, coalesce(n, 0) AS waiting FROM s LEFT JOIN h USING (source_id) LEFT JOIN r USING (source_id) LEFT JOIN q USING (source_id)""")
def portal_status(spark, d):
    customer = table(spark, d, "customer").withColumn("source_id", F.col("c_nationkey"))
    health = customer.groupBy("source_id").agg((F.max("c_acctbal") > 9000).alias("rich"))
    made = table(spark, d, "supplier").select(F.col("s_nationkey").alias("source_id"), F.col("s_name").alias("status"), F.col("s_suppkey").alias("finished_at"), F.col("s_suppkey").alias("run_id"))
    found = views.portal_status(table(spark, d, "nation").select(F.col("n_nationkey").alias("source_id")), health, made, customer.where("c_mktsegment = 'BUILDING'"))
    return found.select("source_id", "rich", "runs", "latest_status", "waiting")


@query("""WITH c AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) SELECT coalesce(c_custkey, o_custkey) AS k, coalesce(n, 0) AS n, c_custkey IS NOT NULL AS known FROM (SELECT c_custkey FROM customer WHERE c_custkey % 10 <> 0) FULL OUTER JOIN c ON c_custkey = o_custkey""")
def coverage(spark, d):
    counts = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("n"))
    return views.coverage(table(spark, d, "customer").where("c_custkey % 10 <> 0").select(F.col("c_custkey").alias("k")), counts, "k")


@query("""WITH a AS (SELECT p_partkey, p_name, p_type FROM part), w AS (SELECT p_partkey, unnest(regexp_extract_all(lower(p_name), '[a-z0-9_]+')) AS term, 3 AS n FROM a UNION ALL SELECT p_partkey, unnest(regexp_extract_all(lower(p_type || ' ' || p_name), '[a-z0-9_]+')), 1 FROM a),
  p AS (SELECT p_partkey, term, sum(n) AS n FROM w WHERE term IN ('widget', 'promo') GROUP BY ALL) SELECT p_partkey, sum(n)::BIGINT AS score FROM p GROUP BY 1 HAVING count(*) = 2""")
def search_titles(spark, d):
    part = table(spark, d, "part")
    index = search.titled_postings(part, "p_partkey", F.col("p_name"), F.concat_ws(" ", "p_type", "p_name"))
    return search.search(index, "p_partkey", ["widget", "Promo"])
