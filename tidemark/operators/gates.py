"""Privacy, review and publication decisions as columns. Values that were found are never put in a result."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.canon import decoded_url, tax_class, unclassified_tax_shape, url_part, valid_iban, valid_person_id

#: What the text rules look for. Identifiers may be grouped by blanks, points or hyphens.
_SEP = r"[ .\-]"
_EIGHT, _SEVEN = rf"(?:\d{{8}}|\d{{2}}{_SEP}\d{{3}}{_SEP}\d{{3}})", rf"(?:\d{{7}}|\d{{2}}{_SEP}\d{{3}}{_SEP}\d{{2}})"
PERSON_ID = rf"(?i)(?<![A-Za-z0-9])(?:[XYZKLM]{_SEP}?{_SEVEN}{_SEP}?[A-Z]|{_EIGHT}{_SEP}?[A-Z])(?![A-Za-z0-9])"
IBAN = r"(?i)(?<![A-Z0-9])[A-Z]{2}\d{2}(?:[ -]?[A-Z0-9]){11,34}(?![A-Z0-9])"
#: A run of mailbox characters is tried once, from its start, and never given back.
EMAIL = r"(?<![A-Za-z0-9.!#$%&'*+/=?^_`{|}~\-])[A-Za-z0-9.!#$%&'*+/=?^_`{|}~\-]++@([A-Za-z0-9](?:[A-Za-z0-9\-]{0,61}[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9\-]{0,61}[A-Za-z0-9])?)+)"
PHONE = r"(?:\+34[ .-]?[6789](?:[ .-]?\d){8}|(?<!\d)[6789](?:[ .-]?\d){2}[ .-]\d{3}[ .-]\d{3})(?!\d)"
ADDRESS = r"(?i)\b(?:domicilio|direcci[oó]n)\s+(?:de\s+)?(?:uso\s+)?(?:particular|personal)\s*:\s*[^,\n]{3,120}\s+\d{1,4}\b"
#: What says that the number behind it is a private one.
PHONE_TERMS = (
    "telefono particular", "teléfono particular", "movil particular", "móvil particular",
    "telefono personal", "teléfono personal", "movil personal", "móvil personal",
)
MAIL_DOMAINS = ("gmail.com", "googlemail.com", "hotmail.com", "outlook.com", "yahoo.com", "yahoo.es", "icloud.com", "proton.me", "protonmail.com")
SEVERITY = ("allow", "quarantine", "reject")
RULES = ("personal_identifier", "ambiguous_tax_identifier", "bank_account", "consumer_email", "contextual_phone", "private_address")


@dataclass(frozen=True)
class PrivacyRules:
    """Which rules are on, with their decision, and the lists they use. Rules without a decision are off."""

    decisions: dict[str, str] = field(default_factory=lambda: dict.fromkeys(RULES, "quarantine"))
    mail_domains: tuple[str, ...] = MAIL_DOMAINS
    phone_terms: tuple[str, ...] = PHONE_TERMS

    def __post_init__(self):
        if not set(self.decisions.values()) <= set(SEVERITY) or not set(self.decisions) <= set(RULES) or not self.mail_domains or not self.phone_terms:
            raise ValueError("privacy rules: unknown rule or decision, or an empty list")

    def predicates(self, text: Column, contact: bool = True) -> dict[str, Column]:
        """Whether each rule for plain text finds something; only texts that may hold contacts are asked for them."""
        some = lambda pattern, check: F.exists(F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1)), check)
        out = {
            "personal_identifier": text.rlike(r"\d") & some(PERSON_ID, lambda x: F.coalesce(valid_person_id(x), F.lit(False))),
            "bank_account": text.rlike(r"[A-Za-z]{2}\d{2}") & some(IBAN, lambda x: F.coalesce(valid_iban(x), F.lit(False))),
        }
        if contact:
            domains = F.transform(F.regexp_extract_all(text, F.lit(EMAIL), F.lit(1)), lambda d: F.regexp_replace(F.lower(d), r"\.$", ""))
            near = rf"(?i)(?:{'|'.join(self.phone_terms)})[\s:;,(.\-]{{0,12}}{PHONE}"
            out |= {
                "consumer_email": text.contains("@") & F.arrays_overlap(domains, F.array(*map(F.lit, self.mail_domains))),
                "contextual_phone": text.rlike(r"[6789](?:[ .-]?\d){2}") & F.lower(text).rlike(near),
                "private_address": text.rlike(ADDRESS),
            }
        return out

    def tax_predicates(self, text: Column, kind: Column | None = None) -> dict[str, Column]:
        """The rules for a field that holds a tax identifier: its class decides; what has none is looked at as text.
        ``kind`` is the class where a column has it already."""
        kind, plain = tax_class(text) if kind is None else kind, self.predicates(text, contact=False)
        free = kind.isNull()
        return {
            "personal_identifier": (kind == "personal_identifier") | (free & plain["personal_identifier"]),
            "ambiguous_tax_identifier": (kind == "ambiguous_tax_identifier") | (free & unclassified_tax_shape(text)),
            "bank_account": free & plain["bank_account"],
        }


def privacy_decision(df: DataFrame, fields: dict[str, Column], rules: PrivacyRules = PrivacyRules()) -> DataFrame:
    """``df`` with privacy (allow, quarantine or reject) and privacy_reasons: sorted rule:field pairs, no values.

    Fields whose name ends in tax_identifier are judged by class; title, description and source_data fields are also
    asked for contacts and addresses. URLs among the fields should be given decoded (see url_surfaces). Null fields
    hold nothing.
    """
    apart = "_" * max(map(len, df.columns), default=0)  # longer than any name there
    kinds = {name: f"_{k}{apart}" for k, name in enumerate(fields) if name.endswith("tax_identifier")}

    def asked(name: str, c: Column) -> dict[str, Column]:
        if name.endswith("tax_identifier"):
            return rules.tax_predicates(c, F.col(kinds[name]))
        return rules.predicates(c, contact=name in ("title", "description", "text") or name.startswith("source_data."))

    found = [F.when(F.coalesce(p, F.lit(False)), F.struct(F.lit(SEVERITY.index(rules.decisions[r])).alias("level"), F.lit(f"{r}:{name}").alias("reason"))) for name, c in fields.items() for r, p in asked(name, c).items() if rules.decisions.get(r, "allow") != "allow"]
    reasons = F.array_compact(F.array(*found)) if found else F.array().cast("array<struct<level: int, reason: string>>")
    classed = df.withColumns({kind: tax_class(fields[name]) for name, kind in kinds.items()})  # once, for all rules
    told = classed.withColumn("privacy_reasons", reasons).drop(*kinds.values())  # once, for both columns
    level = F.coalesce(F.array_max(F.transform("privacy_reasons", lambda x: x["level"])), F.lit(0))
    return told.withColumn("privacy", F.element_at(F.array(*map(F.lit, SEVERITY)), level + 1)).withColumn("privacy_reasons", F.array_sort(F.array_distinct(F.transform("privacy_reasons", lambda x: x["reason"]))))


def url_surfaces(url: Column, rounds: int = 4) -> Column:
    """All texts a URL may hide, line by line: it and its parts, after each of up to ``rounds`` percent decodings.

    Null where even then something is left to decode, or where it can't be decoded: such a row must not pass.
    """
    start = F.array(url, url_part(url, "path"), url_part(url, "query"), F.regexp_extract(url, "#(.*)$", 1), F.replace(url_part(url, "query"), F.lit("+"), F.lit(" ")))
    decode = lambda u: F.try_url_decode(F.replace(u, F.lit("+"), F.lit("%2B")))
    layers = [start]
    for _ in range(rounds):
        layers.append(F.transform(layers[-1], decode))
    last = layers[-1]
    settled = F.forall(last, lambda u: u.isNotNull() & decode(u).eqNullSafe(u))
    return F.when(url.isNotNull() & settled, F.array_join(F.array_distinct(F.filter(F.flatten(F.array(*layers)), lambda u: u != "")), "\n"))


def inspected_fields(df: DataFrame, plain: dict[str, Column], lists: dict[str, Column], urls: dict[str, Column]) -> DataFrame:
    """``df`` with inspected: a map from field path to text, elements of lists by their place, URLs by all their surfaces,
    and undecodable: the URL fields that could not be read and must be held."""
    pair = lambda k, v: F.struct(k.alias("key"), v.alias("value"))
    entries = [F.array(*(pair(F.lit(k), v) for k, v in (plain | {k: url_surfaces(v) for k, v in urls.items()}).items()))]
    placed = lambda k: lambda x, i: pair(F.concat(F.lit(f"{k}["), i.cast("string"), F.lit("]")), x)
    entries += [F.transform(v, placed(k)) for k, v in lists.items()]
    filled = F.filter(F.flatten(F.array(*(F.coalesce(e, F.array().cast("array<struct<key: string, value: string>>")) for e in entries))), lambda e: e["value"].isNotNull())
    bad = F.array_compact(F.array(*(F.when(v.isNotNull() & url_surfaces(v).isNull(), F.lit(k)) for k, v in urls.items()))) if urls else F.array().cast("array<string>")
    return df.withColumns({"inspected": F.map_from_entries(filled), "undecodable": bad})


def scan_fields(df: DataFrame, rules: PrivacyRules = PrivacyRules(), fields: str = "inspected") -> DataFrame:
    """``df`` (with the columns of inspected_fields) with privacy and privacy_reasons over all fields of the map."""
    def reasons(name: Column, text: Column) -> Column:
        tax = name.endswith("tax_identifier")
        contact = name.isin("title", "description") | name.startswith("source_data.")
        plain, by_class = rules.predicates(text), rules.tax_predicates(text)
        told = []
        for r in RULES:
            if rules.decisions.get(r, "allow") == "allow":
                continue
            here = plain.get(r, F.lit(False)) if r in ("personal_identifier", "bank_account") else contact & plain.get(r, F.lit(False))
            hit = F.when(tax, by_class.get(r, F.lit(False))).otherwise(here)
            told.append(F.when(F.coalesce(hit, F.lit(False)), F.struct(F.lit(SEVERITY.index(rules.decisions[r])).alias("level"), F.concat(F.lit(f"{r}:"), name).alias("reason"))))
        return F.array_compact(F.array(*told))

    found = F.flatten(F.transform(F.map_entries(fields), lambda e: reasons(e["key"], e["value"])))
    held = F.transform("undecodable", lambda k: F.struct(F.lit(1).alias("level"), F.concat(F.lit("url_encoding_invalid:"), k).alias("reason")))
    told = df.withColumn("privacy_reasons", F.concat(found, held))
    level = F.coalesce(F.array_max(F.transform("privacy_reasons", lambda x: x["level"])), F.lit(0))
    return told.withColumn("privacy", F.element_at(F.array(*map(F.lit, SEVERITY)), level + 1)).withColumn("privacy_reasons", F.array_sort(F.array_distinct(F.transform("privacy_reasons", lambda x: x["reason"]))))


def review_allowlist(df: DataFrame, listed: DataFrame, key: str, decision: str, default: str = "hold") -> DataFrame:
    """``df`` with review: the list's decision for the key, or the default. Contradictions are told, not resolved."""
    reviews = listed.groupBy(key).agg(F.min(decision).alias("a"), F.max(decision).alias("b"))
    said = F.when(F.col("a") != F.col("b"), "conflict").otherwise(F.coalesce("a", F.lit(default)))
    return df.join(reviews, key, "left").withColumn("review", said).drop("a", "b")


def approvals_against_privacy(reviewed: DataFrame, approved: str = "approved") -> DataFrame:
    """Rows approved by hand that privacy does not allow: a publication with any must stop."""
    return reviewed.where((F.col("review") == approved) & (F.col("privacy") != "allow"))


@dataclass(frozen=True)
class Rule:
    """One positive publication rule: where it applies and what it demands."""

    name: str
    section: Column
    demands: tuple[tuple[str, Column], ...]


def rule_policy(integrity: Column, privacy: Column, excluded: Column, rules: list[Rule]) -> Column:
    """The first reason that decides: integrity, privacy, exclusion, then the first rule that holds, else the first
    failure of the first rule whose section fits."""
    out = F.when(~integrity, "hold:integrity").when(privacy != "allow", F.concat(F.lit("hold:privacy_"), privacy)).when(excluded, "hold:excluded")
    for rule in rules:
        holds = rule.section
        for _, demand in rule.demands:
            holds = holds & demand
        out = out.when(holds, f"candidate:{rule.name}")
    for rule in rules:
        for reason, demand in rule.demands:
            out = out.when(rule.section & ~demand, f"hold:{reason}")
    return out.otherwise("hold:no_rule")


def url_verdict(url: Column, hosts: tuple[str, ...], schemes: tuple[str, ...] = ("https",)) -> Column:
    """ok, or why a link may not be followed: blank, control, percent, scheme, credentials, host or address."""
    host = F.lower(F.regexp_replace(url_part(url, "host"), r":\d+$", ""))
    ends = F.lit(False)
    for h in hosts:
        ends = ends | (host == h) | host.endswith(f".{h}")
    return (
        F.when(url.isNull() | (F.trim(url) == ""), "blank")
        .when(url.rlike(r"[\x00-\x20\x7f]"), "control")
        .when(url.rlike(r"%(?![0-9A-Fa-f]{2})"), "percent")
        .when(~F.lower(url_part(url, "scheme")).isin(*schemes), "scheme")
        .when(url_part(decoded_url(url), "host").contains("@"), "credentials")
        .when(host.rlike(r"^[0-9.]+$|^\["), "address")
        .when(~ends, "host")
        .otherwise("ok")
    )


def normal_link(link: Column) -> Column:
    """The link, with https:// before one that has no scheme; null for blanks and mail addresses."""
    text = F.trim(link)
    return F.when((text == "") | text.contains("@"), None).when(text.rlike("(?i)^[a-z][a-z0-9+.-]*://"), text).otherwise(F.concat(F.lit("https://"), text))


def authorised(df: DataFrame, grants: DataFrame, keys: tuple[str, ...] = ("record_id", "source_id", "content_hash")) -> DataFrame:
    """The rows that a grant for exactly their record, source and hash covers."""
    return df.join(grants.select(*keys).distinct(), list(keys), "left_semi")
