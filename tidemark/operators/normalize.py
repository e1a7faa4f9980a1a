"""From parsed source rows to candidates, and from candidates to finalised records, as column expressions.

Nothing here fails a job because of one row: what a row lacks is told by codes in a column, without its values, and
rows with codes have no candidate.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.canon import canonical_decimal, canonical_json, canonical_set, fold, sha256, slug, squeeze
from .identity import UNIT, identify

#: Categories by section code, and by folded words of a title (the first rule that fits counts).
SECTION_CATEGORIES = {"1": "regulation", "2B": "employment", "5A": "procurement"}
TITLE_RULES = (
    ("employment", r"\b(?:empleo|oposicion(?:es)?|bolsas? de trabajo|proceso(?:s)? selectivo(?:s)?|personal funcionario|personal laboral|concurso oposicion)\b"),
    ("procurement", r"\b(?:contratacion|licitacion(?:es)?|adjudicacion(?:es)?|contrato(?:s)? publicos?)\b"),
    ("grants", r"\b(?:subvenciones?|ayudas?|convocatoria de ayudas)\b"),
    ("regulation", r"\b(?:ordenanzas?|reglamentos?|disposiciones? generales?|normativa municipal)\b"),
    ("budget", r"\bpresupuestos?\b"),
    ("urbanism", r"\b(?:urbanismo|plan general de ordenacion|plan especial)\b"),
    ("auction", r"\bsubastas?\b"),
    ("agreement", r"\bconvenios?\b"),
)
#: How headings of a bulletin name who speaks.
MUNICIPAL_PREFIXES = ("ayuntamiento de", "ayuntamiento del", "ajuntament de", "ajuntament del")
PROVINCIAL_PREFIXES = ("diputacion provincial de castellon", "diputacion provincial de castello", "diputacion de castellon", "diputacion de castello")
GENERIC_HEADINGS = ("ayuntamientos", "diputacion provincial", "mancomunidades", "consorcios", "administracion de justicia", "administracion del estado", "administracion autonomica", "otras administraciones", "anuncios")
OTHER_PREFIXES = (
    "mancomunidad ", "mancomunitat ", "consorcio ", "juzgado ", "juzgados ", "tribunal ", "consejeria ", "conselleria ", "generalitat ", "ministerio ",
    "delegacion del gobierno ", "subdelegacion del gobierno ", "direccion general ", "organismo autonomo ", "agencia ", "universidad ", "autoridad portuaria ",
    "comunidad de regantes ", "servicio provincial ", "gerencia ", "hospital ", "instituto ",
)
AUTONOMOUS_PREFIXES, STATE_PREFIXES = ("generalitat valenciana", "consejeria ", "conselleria "), ("ministerio ", "delegacion del gobierno ", "subdelegacion del gobierno ")

MATCH = "struct<reason: string, entity_code: string, entity_name: string, field: string, matched_text: string, method: string>"


def fold_words(text: Column) -> Column:
    """Folded words of letters and digits with one blank between them."""
    return F.trim(F.regexp_replace(fold(text), "[^a-z0-9]+", " "))


def filled(text: Column) -> Column:
    """The text, or null where it is blank."""
    return F.when(F.trim(text) != "", text)


def starts_with_any(text: Column, prefixes: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, (F.startswith(text, F.lit(p)) for p in prefixes))


def section_category(section: Column) -> Column:
    """The category of a section code, "other" for codes without one."""
    names = F.create_map(*(F.lit(x) for pair in SECTION_CATEGORIES.items() for x in pair))
    return F.coalesce(F.try_element_at(names, F.upper(F.trim(section))), F.lit("other"))


def title_category(title: Column, rules: tuple[tuple[str, str], ...] = TITLE_RULES) -> Column:
    """The category of the first rule that a title's folded words fit, else "other"; null for blank titles."""
    words = fold_words(title)
    chosen = reduce(lambda out, rule: out.when(words.rlike(rule[1]), rule[0]), rules[1:], F.when(words.rlike(rules[0][1]), rules[0][0]))
    return F.when(filled(title).isNotNull(), chosen.otherwise("other"))


def documents(html: Column, xml: Column, pdf: Column) -> Column:
    """source_url (the first of the three that is not empty) and documents (all of them, distinct and sorted)."""
    some = lambda c: F.when(c != "", c)
    urls = F.array_sort(F.array_distinct(F.array_compact(F.array(some(html), some(xml), some(pdf)))))
    entry = lambda u: F.struct(u.alias("source_url"), F.lit("not_archived").alias("archive_status"), F.lit(False).alias("has_local_copy"), F.lit(False).alias("publication_allowed"))
    return F.struct(F.coalesce(some(html), some(xml), some(pdf)).alias("source_url"), F.transform(urls, entry).alias("documents"))


def geography(matches: Column, code: str = r"^12\d{3}$") -> Column:
    """The municipality's name if the only match is a municipality with a sound code, else null."""
    only = F.try_element_at(matches, F.lit(1))
    fits = (F.size(matches) == 1) & (only["reason"] == "municipality_exact") & only["entity_code"].rlike(code) & filled(only["entity_name"]).isNotNull()
    return F.when(fits, only["entity_name"])


def match_evidence(matches: Column) -> Column:
    """Distinct (reason, detail) of the matches in order; the detail is canonical JSON of everything a match holds."""
    keys = ("entity_code", "entity_name", "field", "matched_text", "method")
    names = F.create_map(*(F.lit(x) for x in ("municipality_exact", "municipality_match", "province_exact", "explicit_text_match", "authority_exact", "authority_match")))
    told = lambda m: F.struct(F.try_element_at(names, m["reason"]).alias("reason"), canonical_json({"boe_reason": m["reason"], **{k: m[k] for k in keys}}).alias("detail"))
    return F.array_sort(F.array_distinct(F.transform(matches, told)))


def observation_codes(detected: Column, checked: Column) -> Column:
    """What is wrong with the instants of an observation: one is missing, or the check precedes the detection."""
    return F.array_compact(F.array(F.when(detected.isNull() | checked.isNull(), "observation_timestamp_invalid"), F.when(checked < detected, "observation_timestamp_order_invalid")))


def official_candidates(items: DataFrame, detected: Column, checked: Column) -> DataFrame:
    """Candidates of gazette items with ``matches`` (array of MATCH): items without a match are out of scope and go.

    Adds codes and, where there are none, candidate: closed columns of a record before it has an id.
    """
    links = documents(F.col("html_url"), F.col("xml_url"), F.col("pdf_url"))
    need = {"official_id": F.col("official_id"), "department_code": F.col("department_code"), "department_name": F.col("department_name"), "title": F.col("title")}
    codes = F.concat(
        F.array_compact(F.array(*(F.when(filled(c).isNull(), f"{k}_missing") for k, c in need.items()), F.when(F.col("published_on").isNull(), "published_on_invalid"), F.when(links["source_url"].isNull(), "documents_missing"))),
        observation_codes(detected, checked),
    )
    candidate = F.struct(
        F.struct(F.lit("boe").alias("id"), F.col("official_id")).alias("source"),
        F.struct(F.concat(F.lit("boe-department:"), F.col("department_code")).alias("id"), F.col("department_name").alias("name")).alias("authority"),
        F.lit("state").alias("administration_level"), section_category(F.col("section_code")).alias("category"), squeeze(F.col("title")).alias("title"),
        F.struct(F.col("published_on").alias("published_at"), detected.alias("detected_at"), checked.alias("last_checked_at")).alias("dates"),
        links["source_url"].alias("source_url"), links["documents"].alias("documents"), geography(F.col("matches")).alias("municipality"),
        match_evidence(F.col("matches")).alias("territorial_matches"), F.lit("active").alias("status"),
    )
    inside = items.where(F.size("matches") > 0).withColumn("codes", codes)
    return inside.withColumn("candidate", F.when(F.size("codes") == 0, candidate))


def label_scope(labels: Column, inside: str, outside: str) -> Column:
    """include if a label says so exactly, out_of_scope if all say they are elsewhere, else unresolved, with the reason."""
    told = lambda scope, reason: F.struct(F.lit(scope).alias("scope"), F.lit(reason).alias("reason"))
    return (
        F.when(F.array_contains(labels, inside), told("include", "exact_region"))
        .when((F.size(labels) > 0) & F.forall(labels, lambda x: x.eqNullSafe(F.lit(outside))), told("out_of_scope", "exact_disjoint_region"))
        .when(F.size(labels) > 0, told("unresolved", "region_not_exactly_mapped"))
        .otherwise(told("unresolved", "region_absent"))
    )


def preferred_title(*titles: Column) -> Column:
    """The first title that is not blank."""
    return F.coalesce(*(filled(t) for t in titles))


def single_extract_date(extracts: Column) -> Column:
    """The publication date of the only extract, if it names its diary and a code or link."""
    only = F.try_element_at(extracts, F.lit(1))
    return F.when((F.size(extracts) == 1) & (only["diary"] != "") & ((only["cve"] != "") | (only["url"] != "")), only["publication_date"])


def joined_authority(levels: list[Column], registry_code: Column) -> Column:
    """id and name of who speaks: the filled levels joined; the id is the registry's code or a hash of the folded levels."""
    known = F.array_compact(F.array(*(F.trim(filled(x)) for x in levels)))
    folded = F.transform(known, lambda x: F.lower(squeeze(x)))
    derived = F.concat(F.lit("bdns:derived-authority:"), F.substring(sha256(F.to_json(F.struct(folded.alias("levels")))), 1, 20))
    given = F.concat(F.lit("bdns:invente:"), F.trim(filled(registry_code)))
    return F.when(F.size(known) > 0, F.struct(F.coalesce(given, derived).alias("id"), F.array_join(known, " / ").alias("name")))


def derived_authority_id(folded: Column, prefix: str = "bop-castellon:authority:") -> Column:
    """An id for a name that no registry has: a readable part and the name's hash."""
    readable = slug(folded, 48)
    return F.concat(F.lit(prefix), F.when(readable != "", readable).otherwise("observed"), F.lit("-"), F.substring(sha256(folded), 1, 16))


def matched_pairs(left: DataFrame, right: DataFrame, key: str, other: str) -> tuple[DataFrame, DataFrame]:
    """Rows of both sides with one key, and the keys that only one side has, with its name."""
    pairs = left.join(right, left[key] == right[other])
    lone = left.select(F.col(key).alias("key")).distinct().withColumn("l", F.lit(True)).join(right.select(F.col(other).alias("key")).distinct().withColumn("r", F.lit(True)), "key", "full_outer")
    return pairs, lone.where("l is null or r is null").select("key", F.when(F.col("r").isNull(), "left").otherwise("right").alias("side"))


def heading_authority(rows: DataFrame, path: str, registry: DataFrame) -> DataFrame:
    """``rows`` with authority: id, name, level, municipality code and evidence of the most specific heading that tells.

    ``registry`` has code and name of municipalities (a name of two codes is ambiguous and matches none). Headings are
    tried from the last to the first: municipal prefixes, municipalities by name, the province, other organisations.
    """
    names = registry.select(fold_words(F.col("name")).alias("folded"), "code").groupBy("folded").agg(F.min("code").alias("code"), F.max("code").alias("other")).where("code = other").select("folded", "code")
    # headings are told once for each distinct path, which is also what leads back to its rows
    paths = rows.select(F.col(path).alias("way")).distinct()
    headings = paths.select("way", F.posexplode(F.reverse("way")).alias("at", "heading")).withColumn("folded", fold_words(F.col("heading")))
    headings = headings.where((F.col("folded") != "") & ~F.col("folded").isin(*GENERIC_HEADINGS))
    bare = F.regexp_extract("folded", rf"^(?:{'|'.join(sorted(MUNICIPAL_PREFIXES, key=len, reverse=True))}) (.+)$", 1)
    headings = headings.withColumn("town", F.when(bare != "", bare))
    met = headings.withColumn("asked", F.coalesce("town", "folded")).join(names, F.col("asked") == names["folded"], "left").select(headings["*"], "code")
    clean = F.trim("heading")
    told = lambda id_, name, level, code, evidence: F.struct(id_.alias("id"), name.alias("name"), level.cast("string").alias("level"), code.cast("string").alias("municipality"), F.lit(evidence).alias("evidence"))
    level = F.when(starts_with_any(F.col("folded"), AUTONOMOUS_PREFIXES), "autonomous").when(starts_with_any(F.col("folded"), STATE_PREFIXES), "state")
    found = (
        F.when(F.col("code").isNotNull(), told(F.concat(F.lit("bop-castellon:municipality:"), "code"), clean, F.lit("municipal"), F.col("code"), "exact_municipality_registry_heading"))
        .when(F.col("town").isNotNull(), told(derived_authority_id(F.col("folded")), clean, F.lit("municipal"), F.lit(None), "explicit_municipal_authority_heading"))
        .when(starts_with_any(F.col("folded"), PROVINCIAL_PREFIXES), told(F.lit("bop-castellon:diputacion:12"), F.lit("Diputación Provincial de Castellón"), F.lit("provincial"), F.lit(None), "explicit_provincial_deputation_heading"))
        .when(starts_with_any(F.col("folded"), OTHER_PREFIXES), told(derived_authority_id(F.col("folded")), clean, level, F.lit(None), "explicit_observed_organization_heading"))
    )
    best = met.withColumn("told", found).where("told is not null").groupBy("way").agg(F.min_by("told", "at").alias("authority"))
    return rows.join(best, rows[path] == best["way"], "left").drop("way")


def notice_candidates(notices: DataFrame, registry: DataFrame, detected: Column, checked: Column, path: str = "heading_path", title: str = "title", url: str = "url") -> DataFrame:
    """Candidates of bulletin announcements: category by title, authority by headings; codes tell why one has none."""
    rows = heading_authority(notices, path, registry)
    codes = F.concat(F.array_compact(F.array(F.when(filled(F.col(title)).isNull(), "announcement_title_invalid"), F.when(filled(F.col(url)).isNull(), "announcement_url_invalid"), F.when(F.col("authority").isNull(), "authority_unresolved"))), observation_codes(detected, checked))
    candidate = F.struct(F.col("authority"), title_category(F.col(title)).alias("category"), squeeze(F.col(title)).alias("title"), F.col(url).alias("source_url"), detected.alias("detected_at"), checked.alias("last_checked_at"), F.lit("active").alias("status"))
    return rows.withColumn("codes", codes).withColumn("candidate", F.when(F.size("codes") == 0, candidate))


def only_value(values: Column) -> Column:
    """value and code of what should be said once: contradictions and texts with outer blanks are inconsistent."""
    distinct = F.array_distinct(values)
    value = F.try_element_at(distinct, F.lit(1))
    wrong = (F.size(distinct) > 1) | ((F.size(distinct) == 1) & ((value == "") | (value != F.trim(value))))
    return F.struct(F.when(~wrong, value).alias("value"), F.when(wrong, "structured_fields_inconsistent").alias("code"))


def title_state(titles: Column) -> Column:
    """The only title as it is, and whether it is absent, multiple, empty, blank or present."""
    only = F.try_element_at(titles, F.lit(1))
    state = F.when(F.size(titles) == 0, "absent").when(F.size(titles) > 1, "multiple").when(only == "", "empty").when(F.trim(only) == "", "blank").otherwise("present")
    return F.struct(F.when(state.isin("blank", "present"), only).alias("title"), state.alias("state"))


def optional_url(url: Column, verdict: Column, warning: str) -> Column:
    """The URL if its verdict is ok, else a warning; nothing for no URL."""
    return F.struct(F.when(verdict == "ok", url).alias("url"), F.when(url.isNotNull() & (verdict != "ok"), warning).alias("warning"))


def closed_block(fields: dict[str, Column], checks: dict[str, Column]) -> Column:
    """All fields or none: value is a struct of them if every check holds, else error is the first failing check's code."""
    error = F.coalesce(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(code)) for code, ok in checks.items()))
    return F.struct(F.when(error.isNull(), F.struct(*(c.alias(k) for k, c in fields.items()))).alias("value"), error.alias("error"))


def hash_version(version: Column, has_source_data: Column) -> Column:
    """1 or 2, or null where the stated version and the presence of source data contradict each other."""
    stated = F.coalesce(version, F.lit(1))
    return F.when(stated.isin(1, 2) & (has_source_data == (stated == 2)), stated)


def same_contract(previous: Column, current: Column) -> Column:
    """Whether two hash versions may be compared; a change of version is a migration, never an update."""
    return previous.isNotNull() & previous.eqNullSafe(current)


def finalize(candidates: DataFrame, source: Column, fields: dict[str, Column], official_id: Column | None = None, url: Column | None = None, money: tuple[str, ...] = (), sets: tuple[str, ...] = (), detected: Column | None = None, checked: Column | None = None, version: Column | None = None) -> DataFrame:
    """``candidates`` with record_id, identity_strategy, content_hash_version, content_hash and codes.

    ``fields`` carry the meaning; those in ``money`` are put as canonical decimals and those in ``sets`` as canonical
    sets before they are hashed. Rows with codes have no id and no hash. The result depends on the row alone.
    """
    shaped = {k: canonical_decimal(c) if k in money else canonical_set(c) if k in sets else c for k, c in fields.items()}
    codes = observation_codes(detected, checked) if detected is not None and checked is not None else F.array().cast("array<string>")
    rows = identify(candidates.withColumn("codes", codes), source, official_id=official_id, url=url, fingerprint=[F.to_json(F.struct(*(c.alias(k) for k, c in sorted(shaped.items()))))])
    rows = rows.withColumns({"content_hash_version": F.coalesce(version, F.lit(1)) if version is not None else F.lit(1), "content_hash": sha256(canonical_json(shaped))})
    sound = F.size("codes") == 0
    return rows.withColumns({c: F.when(sound, F.col(c)) for c in ("record_id", "identity_strategy", "content_hash_version", "content_hash")})


def digest(*parts: Column, most: int | None = None) -> Column:
    """An opaque key of its parts."""
    out = sha256(F.concat_ws(UNIT, *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)))
    return F.substring(out, 1, most) if most else out
