"""A reference catalogue against a registry: entities, and every issue as a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.canon import fold, sha256, squeeze, url_part
from .staging import staged

#: Forms of codes and hosts, and what an entry's official type makes it.
INE, DIR3 = r"^12\d{3}$", r"^L[0-9]{8}$"
HOST = r"^(?=.{1,253}$)[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?(?:\.[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?)+$"
ISSUE = "issue string, blocking boolean, ine string, dir3 string"


def checked_link(link: Column) -> Column:
    """official, url, transform and reason of a link: only a missing https:// may be put before it."""
    schemed = link.contains("://")
    full = F.when(schemed, link).otherwise(F.concat(F.lit("https://"), link))
    authority = url_part(full, "host")
    host = F.lower(F.regexp_replace(F.regexp_replace(authority, "^.*@", ""), r":\d*$", ""))
    port = F.regexp_extract(authority, r":(\d+)$", 1).try_cast("int")
    reason = (
        F.when(link != F.trim(link), "whitespace_or_control_characters")
        .when(full.rlike(r"[\x00-\x20\x7f]"), "whitespace_or_control_characters")
        .when(~F.lower(url_part(full, "scheme")).isin("http", "https"), "scheme_not_allowed")
        .when(authority.contains("@"), "userinfo_not_allowed")
        .when(~host.rlike(HOST), "invalid_host")
        .when((port <= 0) | (port >= 65536), "invalid_port")
    )
    absent = link.isNull() | (F.trim(link) == "")
    transform = F.when(absent, "absent").when(reason.isNotNull(), "rejected").when(schemed, "none").otherwise("prefix_https_scheme")
    return F.struct(F.when(~absent, link).alias("official"), F.when(~absent & reason.isNull(), full).alias("url"), transform.alias("transform"), F.when(~absent, reason).alias("reason"))


def registry_violations(registry: DataFrame, code: str = "code", name: str = "name", pattern: str = INE) -> DataFrame:
    """Codes of a registry that are malformed, unnamed or there twice, and folded names of several codes."""
    rows = registry.select(F.col(code).alias("code"), F.col(name).alias("name"))
    bad = rows.select("code", F.when(~F.coalesce(F.col("code").rlike(pattern), F.lit(False)), "code_invalid").when(F.coalesce(F.trim("name"), F.lit("")) == "", "name_missing").alias("violation")).where("violation is not null")
    twice = rows.groupBy("code").agg(F.count("*").alias("n")).where("n > 1").select("code", F.lit("code_duplicated").alias("violation"))
    shared = rows.withColumn("folded", fold(squeeze(F.col("name")))).groupBy("folded").agg(F.min("code").alias("code"), F.max("code").alias("other")).where("code <> other").select("code", F.lit("name_ambiguous").alias("violation"))
    return bad.unionByName(twice).unionByName(shared)


def build_catalog(raw: DataFrame, registry: DataFrame, kinds: dict[str, str], ine: str = INE, dir3: str = DIR3) -> tuple[DataFrame, DataFrame]:
    """Entities and issues of raw entries (ine, dir3, name, type, web, office) against a registry of code and name.

    An entry is invalid without dir3, name or type or with a malformed code. Codes that stand twice are issues, and
    conflicts where their partners differ; their entries are left out. Types without a kind, municipalities without a
    known code and smaller entities with one are issues; so are registry codes that no entry has. Rejected links are
    issues that block nothing.
    """
    issue = lambda df, name, blocking=True, i="ine", d="dir3": df.select((name if isinstance(name, Column) else F.lit(name)).alias("issue"), F.lit(blocking).alias("blocking"), (F.col(i) if i else F.lit(None).cast("string")).alias("ine"), (F.col(d) if d else F.lit(None).cast("string")).alias("dir3"))
    some = lambda c: F.when(F.trim(c) != "", F.col(c))
    rows = staged(raw.select(some("ine").alias("ine"), some("dir3").alias("dir3"), some("name").alias("name"), some("type").alias("type"), checked_link(F.col("web")).alias("web"), checked_link(F.col("office")).alias("office")), "catalog")  # read again for every kind of issue
    sound = F.col("dir3").isNotNull() & F.col("name").isNotNull() & F.col("type").isNotNull() & (F.col("ine").isNull() | F.col("ine").rlike(ine)) & F.coalesce(F.col("dir3").rlike(dir3), F.lit(False))
    parsed = rows.where(sound)
    twice_ine = parsed.where("ine is not null").groupBy("ine").agg(F.count("*").alias("n"), F.min("dir3").alias("a"), F.max("dir3").alias("b")).where("n > 1")
    twice_dir3 = parsed.groupBy("dir3").agg(F.count("*").alias("n"), F.min(F.coalesce("ine", F.lit(""))).alias("a"), F.max(F.coalesce("ine", F.lit(""))).alias("b")).where("n > 1")
    kind = F.try_element_at(F.create_map(*(F.lit(x) for pair in kinds.items() for x in pair)), F.col("type"))
    single = parsed.join(twice_ine.select("ine"), "ine", "left_anti").join(twice_dir3.select("dir3"), "dir3", "left_anti").withColumn("kind", kind)
    known = registry.select(F.col("code").alias("ine"), F.col("name").alias("registry_name"))
    placed = single.join(known, "ine", "left")
    town = F.col("kind") == "municipality"
    problem = F.when(F.col("kind").isNull(), "unknown_entity_type").when(town & F.col("ine").isNull(), "municipality_without_ine").when(town & F.col("registry_name").isNull(), "unknown_ine").when((F.col("kind") == "sub_municipal") & F.col("ine").isNotNull(), "sub_municipal_with_ine")
    placed = placed.withColumn("problem", problem)
    entities = placed.where("problem is null").select("kind", "ine", "dir3", F.col("name").alias("source_name"), "registry_name", "web", "office")
    missing = known.join(parsed.where("ine is not null").select("ine"), "ine", "left_anti")
    links = parsed.select("ine", "dir3", F.explode(F.array(F.struct(F.lit("web").alias("f"), F.col("web.reason").alias("r")), F.struct(F.lit("office").alias("f"), F.col("office.reason").alias("r")))).alias("x")).where("x.r is not null")
    parts = [
        issue(rows.where(~sound), "invalid_record"), issue(links, F.concat(F.lit("link_rejected:"), F.col("x.f"), F.lit(":"), F.col("x.r")), False),
        issue(twice_ine, "duplicate_ine", d=None), issue(twice_dir3, "duplicate_dir3", i=None),
        issue(twice_ine.where("a <> b"), "ine_dir3_conflict", d=None), issue(twice_dir3.where("a <> b"), "ine_dir3_conflict", i=None),
        issue(placed.where("problem is not null"), F.col("problem")), issue(missing, "missing_in_dataset", d=None),
    ]
    issues = parts[0]
    for p in parts[1:]:
        issues = issues.unionByName(p)
    return entities, issues


def baseline_drift(entities: DataFrame, raw: DataFrame, expected: dict[str, int]) -> DataFrame:
    """How many entries and municipalities there are against how many an audit found, where they differ."""
    counts = entities.agg(F.count_if(F.col("kind") == "municipality").alias("municipalities")).select(F.explode(F.create_map(F.lit("municipalities"), "municipalities")).alias("what", "n"))
    counts = counts.unionByName(raw.agg(F.count("*").alias("n")).select(F.lit("entries").alias("what"), "n"))
    wanted = F.create_map(*(F.lit(x) for pair in expected.items() for x in pair))
    return counts.withColumn("expected", F.try_element_at(wanted, "what").cast("long")).where("n <> expected")


def snapshot_summary(entities: DataFrame) -> DataFrame:
    """Entities and their sound and rejected links by kind."""
    valid = F.col("web.transform").isin("none", "prefix_https_scheme").cast("long") + F.col("office.transform").isin("none", "prefix_https_scheme").cast("long")
    rejected = (F.col("web.transform") == "rejected").cast("long") + (F.col("office.transform") == "rejected").cast("long")
    return entities.groupBy("kind").agg(F.count("*").alias("entities"), F.sum(valid).alias("valid_links"), F.sum(rejected).alias("rejected_links"))


def snapshot(entities: DataFrame, issues: DataFrame, provenance: dict[str, str]) -> DataFrame:
    """The entities as JSON with their own hash and provenance; nothing while an issue blocks."""
    if not {"source", "license", "retrieved_at"} <= {k for k, v in provenance.items() if v}:
        raise ValueError("snapshot: source, license and retrieval date must be stated")
    blocked = issues.where("blocking").select(F.lit(True).alias("blocked")).limit(1)
    body = F.to_json(F.struct(*sorted(entities.columns)))
    rows = entities.select(body.alias("entity"), sha256(body).alias("entity_hash"), *(F.lit(v).alias(k) for k, v in sorted(provenance.items())))
    return rows.join(F.broadcast(blocked), F.lit(True), "left_anti")


def forbidden_fields(df: DataFrame, names: tuple[str, ...]) -> list[str]:
    """Paths of a table's schema, at any depth, whose last name is forbidden."""
    from pyspark.sql.types import ArrayType, MapType, StructType

    def walk(kind, path: str) -> list[str]:
        if isinstance(kind, StructType):
            return [p for f in kind.fields for p in ([f"{path}{f.name}"] if f.name.lower() in names else []) + walk(f.dataType, f"{path}{f.name}.")]
        if isinstance(kind, ArrayType):
            return walk(kind.elementType, path)
        return walk(kind.valueType, path) if isinstance(kind, MapType) else []

    return walk(df.schema, "")


def registry_map(spark: SparkSession, path: str) -> DataFrame:
    """code and name of the municipalities in a registry's JSON file."""
    read = spark.read.schema("municipalities array<struct<code: string, official_name: string>>").option("multiLine", True).json(path)
    return read.select(F.explode("municipalities").alias("m")).select("m.code", F.col("m.official_name").alias("name"))
