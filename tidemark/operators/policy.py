"""Publication policies: ordered decisions as columns, rules as a small table, authorisations, and simulations of them."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What an evaluation may come to.
OUTCOMES = ("candidate", "hold", "deny", "unresolved", "manual_approved")
_RULE_ID, _SECTION = re.compile(r"[a-z0-9][a-z0-9._-]*"), re.compile(r"[0-9][A-Z]?")


def contains_term(folded: Column, term: Column | str) -> Column:
    """Whether folded text holds the term as whole words, also with a plural s or es."""
    said = F.lit(re.sub(r"([^\w\s])", r"\\\1", term)) if isinstance(term, str) else F.regexp_replace(term, r"([^\w\s])", r"\\$1")
    return F.regexp(folded, F.concat(F.lit(r"(?U)(?<!\w)"), said, F.lit(r"(?:e?s)?(?!\w)")))


def contains_any(folded: Column, terms: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, (contains_term(folded, t) for t in terms), F.lit(False))


@dataclass(frozen=True)
class PublicationRule:
    """One positive rule; terms and department names are given folded."""

    rule_id: str
    enabled: bool
    section: str
    category: str
    departments: tuple[str, ...]
    fields: tuple[str, ...]
    reasons_all: tuple[str, ...] = ()
    reasons_any: tuple[str, ...] = ()
    title_any: tuple[str, ...] = ()
    title_not: tuple[str, ...] = ()

    def __post_init__(self):
        if not _RULE_ID.fullmatch(self.rule_id) or not _SECTION.fullmatch(self.section):
            raise ValueError("rule: id or section not valid")
        if not self.departments or not self.title_any or not (self.reasons_all or self.reasons_any):
            raise ValueError("rule: departments, title terms and territorial evidence are needed")


@dataclass(frozen=True)
class PublicationPolicy:
    """Rules with two keys: the policy must be enabled and its activation recorded, else no rule is active."""

    policy_id: str
    enabled: bool
    activation: str | None
    rules: tuple[PublicationRule, ...]
    excluded_sections: tuple[str, ...] = ()
    excluded_terms: tuple[str, ...] = ()

    def __post_init__(self):
        if self.enabled != bool(self.activation):
            raise ValueError("policy: enabled needs a recorded activation, and only then")
        if not self.enabled and any(r.enabled for r in self.rules):
            raise ValueError("policy: a disabled policy has no enabled rule")
        if any(r.section in self.excluded_sections for r in self.rules) or len({r.rule_id for r in self.rules}) != len(self.rules):
            raise ValueError("policy: rules of excluded sections, or ids used twice")

    def active(self, shadow: bool) -> tuple[PublicationRule, ...]:
        return self.rules if shadow else tuple(r for r in self.rules if r.enabled and self.enabled)


def rule_failure(rule: PublicationRule, category: Column, department: Column, title: Column, matches: Column) -> Column:
    """Why a rule does not hold, or null: texts are folded, ``matches`` are structs with reason and field."""
    reasons = F.transform(F.filter(matches, lambda m: m["field"].isin(*rule.fields)), lambda m: m["reason"])
    texts = lambda values: F.array(*map(F.lit, values)).cast("array<string>")
    return (
        F.when(~category.eqNullSafe(F.lit(rule.category)), "category_mismatch")
        .when(~F.coalesce(department.isin(*rule.departments), F.lit(False)), "department_not_allowed")
        .when(F.size(F.array_except(texts(rule.reasons_all), reasons)) > 0, "territorial_requirements_not_met")
        .when(F.lit(bool(rule.reasons_any)) & ~F.arrays_overlap(texts(rule.reasons_any), reasons), "territorial_requirements_not_met")
        .when(contains_any(title, rule.title_not), "rule_title_exclusion")
        .when(~contains_any(title, rule.title_any), "title_pattern_not_matched")
    )


def evaluate(policy: PublicationPolicy, *, integrity: Column, privacy: Column, section: Column, title: Column, category: Column, department: Column, matches: Column, manual: Column, manual_reason: Column, shadow: bool = False) -> Column:
    """outcome, reason, rule_id and active of each row: the first that decides of integrity, privacy, missing evidence,
    decisions by hand, exclusions, rules in order; a section's first failing rule says why it is held.

    ``manual`` is approved, rejected, hold or null. Shadow evaluates rules that are not active, and never activates.
    """
    live = policy.enabled and not shadow
    told = lambda outcome, reason, rule=None: F.struct(F.lit(outcome).alias("outcome"), (reason if isinstance(reason, Column) else F.lit(reason)).alias("reason"), F.lit(rule).cast("string").alias("rule_id"), F.lit(live).alias("active"))
    code, blank = F.upper(F.trim(section)), lambda c: F.coalesce(F.trim(c) == "", F.lit(True))
    out = (
        F.when(~F.coalesce(integrity, F.lit(False)), told("deny", "record_integrity_failure"))
        .when(privacy != "allow", told("deny", F.concat(F.lit("privacy_"), privacy)))
        .when(blank(section), told("unresolved", "missing_section"))
        .when(blank(title), told("unresolved", "missing_title"))
        .when(category.isNull(), told("unresolved", "missing_category"))
        .when(F.coalesce(F.size(matches), F.lit(0)) <= 0, told("unresolved", "missing_territorial_inclusion"))
        .when(manual == "rejected", told("deny", "manual_rejected"))
        .when(manual == "hold", told("hold", F.concat(F.lit("manual_hold_"), manual_reason)))
        .when(manual == "approved", told("manual_approved", "manual_approved"))
        .when(code.isin(*policy.excluded_sections) if policy.excluded_sections else F.lit(False), told("hold", "excluded_section"))
        .when(contains_any(title, policy.excluded_terms), told("hold", "excluded_title_term"))
    )
    rules = policy.active(shadow)
    for rule in rules:
        out = out.when((code == rule.section) & rule_failure(rule, category, department, title, matches).isNull(), told("candidate", "rule_matched", rule.rule_id))
    for rule in rules:
        out = out.when(code == rule.section, told("hold", rule_failure(rule, category, department, title, matches)))
    return out.otherwise(told("hold", "no_rule_for_section"))


def publication_decision(evaluation: Column, manual: Column) -> Column:
    """approved, rejected or hold with a reason: obligatory limits go before what was decided by hand, which goes before
    rules; evaluations that are not active change nothing. Integrity failures abort."""
    told = lambda decision, reason: F.struct(decision.alias("decision") if isinstance(decision, Column) else F.lit(decision).alias("decision"), F.lit(reason).cast("string").alias("reason"))
    reason, outcome = evaluation["reason"], evaluation["outcome"]
    barred = outcome.isin("deny", "unresolved") & ~manual.eqNullSafe(F.lit("rejected"))
    return (
        F.when(~evaluation["active"], told(F.coalesce(manual, F.lit("hold")), None))
        .when(reason == "record_integrity_failure", told("abort", "record_integrity_failure"))
        .when(barred & reason.startswith("privacy_"), told("hold", "personal_content_review"))
        .when(barred & (reason == "missing_territorial_inclusion"), told("hold", "territorial_review_required"))
        .when(barred & (outcome == "unresolved"), told("hold", "not_in_allowlist"))
        .when(manual.isNotNull(), told(manual, None))
        .when(outcome == "candidate", told("approved", "reviewed_rule"))
        .when(reason.isin("excluded_section", "excluded_title_term", "rule_title_exclusion"), told("hold", "personal_content_review"))
        .when(reason == "territorial_requirements_not_met", told("hold", "territorial_review_required"))
        .otherwise(told("hold", "not_in_allowlist"))
    )


def authorisation(allowed: Column, decision: Column, manual: Column, evaluation: Column, policy_id: str) -> Column:
    """The id of the policy that lets an event be written, or null: privacy allows and the row is approved, by hand or by
    an active rule."""
    by_hand, by_rule = manual.eqNullSafe(F.lit("approved")), evaluation["active"] & (evaluation["outcome"] == "candidate")
    return F.when(allowed & (decision == "approved") & by_hand, "manual-review").when(allowed & (decision == "approved") & by_rule, policy_id)


def source_eligibility(df: DataFrame, source: str, held: dict[str, str]) -> DataFrame:
    """``df`` with eligibility (eligible or hold) and hold_reason of its source: a switch for whole sources."""
    switch = F.create_map(*(F.lit(x) for pair in held.items() for x in pair)) if held else F.create_map().cast("map<string,string>")
    reason = F.try_element_at(switch, F.col(source))
    return df.withColumns({"eligibility": F.when(reason.isNull(), "eligible").otherwise("hold"), "hold_reason": reason})


def metadata_decision(privacy: Column, eligible: Column, publishable: Column) -> Column:
    """privacy, source and metadata decisions in that order; a later one is null where an earlier one stops."""
    allowed = privacy == "allow"
    source = F.when(allowed, F.when(eligible, "eligible").otherwise("hold"))
    metadata = F.when(source == "eligible", F.when(publishable, "publishable_metadata").otherwise("hold"))
    reason = F.when(metadata == "hold", "metadata_scope_not_publishable")
    return F.struct(privacy.alias("privacy"), source.alias("source"), metadata.alias("metadata"), reason.alias("reason"))


def always_held(privacy: Column, reason: str = "source_publication_hold") -> Column:
    """The decision of a source that publishes nothing: allowed rows are held, others keep what privacy said."""
    return F.struct(F.when(privacy == "allow", "hold").otherwise(privacy).alias("decision"), F.when(privacy == "allow", reason).alias("reason"), F.lit(False).alias("authorised"))


def outcome_totals(rows: DataFrame, outcome: str = "outcome", n: str = "n") -> DataFrame:
    """outcome and n for every outcome there is, 0 where no row has it."""
    domain = rows.sparkSession.createDataFrame([(x,) for x in OUTCOMES], "outcome string")
    counted = rows.groupBy(F.col(outcome).alias("outcome")).agg(F.sum(n).alias("n"))
    return domain.join(counted, "outcome", "left").select("outcome", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def simulate(evaluated: DataFrame, group: list[Column], outcome: Column, reason: Column) -> DataFrame:
    """How many rows of each group come to each outcome and first reason."""
    return evaluated.groupBy(*group, outcome.alias("outcome"), reason.alias("reason")).agg(F.count("*").alias("n"))


def simulation_totals(evaluated: DataFrame, section: Column, outcome: Column, reason: Column, measures: dict[str, Column]) -> DataFrame:
    """All totals of a simulation in one pass: total (rows, outcomes, sections or all), section, outcome, reason, n and how
    many rows met each of ``measures``. Sections are trimmed capitals, "?" where there is none; no reason is "none"."""
    name = F.upper(F.trim(section))
    rows = evaluated.select(F.when(name == "", "?").otherwise(F.coalesce(name, F.lit("?"))).alias("section"), outcome.alias("outcome"), F.coalesce(reason, F.lit("none")).alias("reason"), *(c.alias(k) for k, c in measures.items()))
    keys = [F.col(c) for c in ("section", "outcome", "reason")]
    sets = [keys, [keys[1]], [keys[0]], []]
    level = F.grouping_id(*keys)
    total = F.when(level == 0, "rows").when(level == 5, "outcomes").when(level == 3, "sections").otherwise("all")
    return rows.groupingSets(sets, *keys).agg(total.alias("total"), F.count("*").alias("n"), *(F.count_if(F.col(k)).alias(k) for k in measures))


def queue_outcome(manual: Column, manual_reason: Column) -> Column:
    """What a queue entry would come to with the evidence that the queue holds."""
    told = lambda outcome, reason: F.struct(F.lit(outcome).alias("outcome"), (reason if isinstance(reason, Column) else F.lit(reason)).alias("reason"))
    return (
        F.when(manual.isNull(), told("unresolved", "queue_lacks_section_title_category"))
        .when(manual == "approved", told("manual_approved", "manual_approved"))
        .when(manual == "rejected", told("deny", "manual_rejected"))
        .otherwise(told("hold", F.concat(F.lit("manual_hold_"), manual_reason)))
    )
