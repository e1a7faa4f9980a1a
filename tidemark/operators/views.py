"""Listings, facets, groups, feeds and coverage over records and events."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def matching(df: DataFrame, selection: dict[str, object]) -> DataFrame:
    """Rows that equal every chosen value; empty choices restrict nothing."""
    chosen = [F.col(k) == F.lit(v) for k, v in selection.items() if v not in (None, "")]
    return df.where(reduce(lambda a, b: a & b, chosen)) if chosen else df


def known_value(value: object, domain: list[object]) -> object | None:
    """The value if the domain has it; unknown choices are ignored."""
    return value if value in domain else None


def listing(df: DataFrame, order: list[Column], most: int) -> DataFrame:
    """The first rows in a total order: a heap for each task, never a full sort."""
    return df.orderBy(*order).limit(most)


def facets(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """facet, bucket and n for each value of each column in one pass; nulls count as none."""
    cells = F.array(*(F.struct(F.lit(k).alias("facet"), F.coalesce(c.cast("string"), F.lit("none")).alias("bucket")) for k, c in columns.items()))
    return df.select(F.explode(cells).alias("x")).groupBy("x.facet", "x.bucket").agg(F.count("*").alias("n"))


def facet_order(counted: DataFrame, locale: str = "es") -> DataFrame:
    """Facets with their place: buckets as the locale sorts them, "none" last."""
    order = Window.partitionBy("facet").orderBy(F.col("bucket") == "none", F.collate("bucket", locale), "bucket")
    return counted.withColumn("place", F.row_number().over(order))


def group_order(groups: DataFrame, of: str = "n", locale: str = "es") -> list[Column]:
    """The order of groups: the largest first, then names as the locale sorts them."""
    return [F.desc(of), F.collate("name", locale), F.asc("name")]


def grouped(df: DataFrame, name: Column, of: str = "n") -> DataFrame:
    """name, count and share of the largest group in hundredths, blank names left out."""
    groups = df.select(name.alias("name")).where(F.trim("name") != "").groupBy("name").agg(F.count("*").alias(of))
    most = groups.agg(F.greatest(F.max(of), F.lit(1)).alias("_most"))  # one row
    return groups.crossJoin(F.broadcast(most)).withColumn("share", F.round(100 * F.col(of) / F.col("_most")).cast("long")).drop("_most")


def window_counts(df: DataFrame, day: Column, as_of: Column, days: int, kind: Column) -> DataFrame:
    """kind and n of rows in the ``days`` up to a day."""
    return df.where((day > F.date_sub(as_of, days)) & (day <= as_of)).groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


def changes_feed(events: DataFrame, records: DataFrame, key: str, labels: dict[str, str], paths: str) -> DataFrame:
    """Events with their records and a sentence of labels for the changed paths; unknown paths are "other data"."""
    table = F.create_map(*(F.lit(x) for pair in labels.items() for x in pair))
    named = F.array_distinct(F.transform(paths, lambda p: F.coalesce(F.try_element_at(table, p), F.lit("other data"))))
    said = F.when(F.size(named) > 1, F.concat(F.array_join(F.slice(named, 1, F.size(named) - 1), ", "), F.lit(" and "), F.element_at(named, -1))).otherwise(F.array_join(named, ", "))
    return events.join(records, key).withColumn("description", said)


def with_history(records: DataFrame, events: DataFrame, key: str) -> DataFrame:
    """``records`` with has_history: whether there is an event of the key."""
    known = events.select(key).distinct().withColumn("has_history", F.lit(True))
    return records.join(known, key, "left").withColumn("has_history", F.coalesce("has_history", F.lit(False)))


def orphans(events: DataFrame, records: DataFrame, key: str) -> DataFrame:
    """Events whose record is not there."""
    return events.join(records.select(key), key, "left_anti")


def coverage(sources: DataFrame, counts: DataFrame, key: str) -> DataFrame:
    """Every known source with its count, 0 where it has none, and counted sources that nobody knows."""
    known = sources.select(key).distinct().withColumn("known", F.lit(True))
    return known.join(counts, key, "full_outer").select(key, F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("known", F.lit(False)).alias("known"))


def symmetric_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys that only one side has, and which one."""
    left, right = a.select(key).distinct().withColumn("l", F.lit(1)), b.select(key).distinct().withColumn("r", F.lit(1))
    both = left.join(right, key, "full_outer").where("l is null or r is null")
    return both.select(key, F.when(F.col("r").isNull(), "left").otherwise("right").alias("side"))


def primary_date(published: Column, received: Column, detected: Column, source: Column) -> Column:
    """value and label of the date to show: publication, then a grant's reception, then the own detection."""
    got = F.when(source == "bdns", received)
    label = F.when(published.isNotNull(), "Publicado").when(got.isNotNull(), "Recibida en BDNS").otherwise("Detectado")
    return F.struct(F.coalesce(published, got, detected).alias("value"), label.alias("label"))


def official_deadline(source: Column, end_date: Column, end_text: Column) -> Column:
    """The end of an application as the source gives it; it is never compared with today."""
    text = F.when(F.trim(end_text) != "", end_text)
    return F.when((source == "bdns") & (end_date.isNotNull() | text.isNotNull()), F.struct(end_date.alias("date"), text.alias("text")))


def authority_label(source: Column, name: Column) -> Column:
    """label and value of who speaks: a gazette's heading is not the issuing body."""
    return F.when(name.isNotNull(), F.struct(F.when(source == "boe", "Sección del BOE").otherwise("Organismo").alias("label"), name.alias("value")))


def shows_level(source: Column, level: Column) -> Column:
    return ~source.eqNullSafe(F.lit("boe")) & level.isNotNull()


def geography_labels(municipality: Column, province: Column) -> Column:
    """The labels of the places that are known, the smaller first."""
    said = lambda label, c: F.when(c != "", F.concat(F.lit(f"{label}: "), c))
    return F.array_compact(F.array(said("Municipio", municipality), said("Provincia", province)))


#: How a title says that a council issued it.
ISSUER = r"^(?:Resolución de \d{1,2} de [a-záéíóú]+ de \d{4}, del|Anuncio del|Edicto del) Ayuntamiento de "


def derived_municipality(source: Column, title: Column, matches: Column) -> Column:
    """code, name and role of the one municipality that a gazette title names by an official variant, else null."""
    sound = F.filter(matches, lambda m: (m["reason"] == "municipality_exact") & (m["field"] == "title") & m["method"].startswith("official_variant") & m["entity_code"].rlike(r"^12\d{3}$") & (F.trim(m["matched_text"]) != "") & F.array_contains(F.transform(F.split(m["entity_name"], "/"), lambda v: F.trim(v)), m["matched_text"]))
    rest = F.regexp_replace(title, ISSUER, "")
    issues = lambda m: title.rlike(ISSUER) & rest.startswith(m["matched_text"]) & ~F.substring(rest, F.length(m["matched_text"]) + 1, F.lit(1)).rlike(r"(?U)^[\p{L}\p{N}]")
    only = (source == "boe") & (F.size(F.array_distinct(F.transform(sound, lambda m: m["entity_code"]))) == 1)
    first = F.try_element_at(sound, F.lit(1))
    return F.when(only, F.struct(first["entity_code"].alias("code"), first["entity_name"].alias("name"), F.when(F.exists(sound, issues), "convocante").otherwise("relacionado").alias("role")))


def extracts_view(extracts: Column, title: Column) -> Column:
    """The extracts that say something; a title that only repeats the page's goes."""
    same = lambda t: F.trim(F.regexp_replace(t, r"(?U)\s+", " ")) == F.trim(F.regexp_replace(title, r"(?U)\s+", " "))
    shown = F.transform(extracts, lambda e: F.struct(e["diary"].alias("diary"), e["publication_date"].alias("publication_date"), F.when(~F.coalesce(same(e["title"]), F.lit(False)), e["title"]).alias("title"), e["cve"].alias("cve")))
    return F.filter(shown, lambda e: e["diary"].isNotNull() | e["publication_date"].isNotNull() | e["title"].isNotNull() | e["cve"].isNotNull())


def timeline(events: DataFrame, key: str, at: str, event_id: str) -> DataFrame:
    """Events with their place in their record's history, the latest first."""
    order = Window.partitionBy(key).orderBy(F.desc(at), event_id)
    return events.withColumn("place", F.row_number().over(order))


def by_primary_date(df: DataFrame, most: int, value: str = "value", detected: str = "detected_at", key: str = "record_id") -> DataFrame:
    """The first rows by displayed date, then detection (both latest first), then id."""
    return listing(df, [F.desc(value), F.desc(detected), F.asc(key)], most)


def public_only(df: DataFrame, sources: DataFrame, source: str = "source_id") -> DataFrame:
    """Rows of sources that publish their records."""
    return df.join(sources.where("public_records").select(source), source, "left_semi")


def portal_status(sources: DataFrame, health: DataFrame, runs: DataFrame, queue: DataFrame, source: str = "source_id") -> DataFrame:
    """Each source with its health, its latest run, how many runs there are and how many entries wait; absent is null or 0."""
    last = runs.groupBy(source).agg(F.count("*").alias("runs"), F.max_by("status", F.struct("finished_at", "run_id")).alias("latest_status"), F.max("finished_at").alias("latest_finished"))
    waiting = queue.groupBy(source).agg(F.count("*").alias("waiting"))
    out = sources.select(source).distinct().join(health, source, "left").join(last, source, "left").join(waiting, source, "left")
    return out.withColumns({"runs": F.coalesce("runs", F.lit(0)), "waiting": F.coalesce("waiting", F.lit(0))})


def publishable(checks: dict[str, Column]) -> Column:
    """Whether a row meets every condition, and the first that it does not: unknown counts as not met."""
    first = F.coalesce(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(k)) for k, ok in checks.items()))
    return F.struct(first.isNull().alias("publishable"), first.alias("reason"))


def count_label(shown: Column, total: Column) -> Column:
    """"n of m" for a filtered list, "m" for a whole one."""
    return F.when(shown == total, F.format_string("%d registros", total)).otherwise(F.format_string("%d de %d registros", shown, total))
