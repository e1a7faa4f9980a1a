"""Closed contracts over JSON: which members are missing, undeclared or wrong, and where, at any depth.

A contract is a JSON Schema document. It is turned into one expression over a VARIANT, so every text is parsed once and
only members that are there are looked at; keys that nobody declared are found by walking those that are there.
"""

from __future__ import annotations

import json
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.summaries import let, opened

VIOLATION = "array<struct<path: string, rule: string>>"
#: Words of a schema that are checked; a schema with others is refused rather than half obeyed.
WORDS = frozenset(
    "type required properties additionalProperties unevaluatedProperties enum const pattern minLength maxLength minItems maxItems uniqueItems minimum maximum format items "
    "allOf anyOf oneOf not if then else $ref".split()
)
NOTES = frozenset("$id $schema $defs title description default examples $comment".split())
#: Forms of texts.
FORMATS = {
    "date": r"^\d{4}-\d{2}-\d{2}$",
    "date-time": r"^\d{4}-\d{2}-\d{2}[Tt]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})$",
    "uri": r"^[A-Za-z][A-Za-z0-9+.-]*:[^\s<>\"{}|\\^`]+$",
}


def _wrong(bad: Column, path: Column, rule: str) -> Column:
    return F.when(F.coalesce(bad, F.lit(False)), F.array(F.struct(path.alias("path"), F.lit(rule).alias("rule")))).otherwise(F.array().cast(VIOLATION))


def _all(parts: list[Column]) -> Column:
    return F.concat(*parts) if parts else F.array().cast(VIOLATION)


def _member(path: Column, name: Column) -> Column:
    return F.concat(path, F.when(path == "", "").otherwise("."), name)


def _kind(value: Column) -> Column:
    """object, array, string, integer, number, boolean or null."""
    told = F.regexp_extract(F.schema_of_variant(value), r"^(\w+(?:\(\d+,0\))?)", 1)
    whole = told.rlike(r"^(BIGINT|DECIMAL\(\d+,0\))$") | ((told == "DOUBLE") & (F.try_variant_get(value, "$", "double") % 1 == 0))
    return (
        F.when(told == "OBJECT", "object").when(told == "ARRAY", "array").when(told == "STRING", "string").when(told == "BOOLEAN", "boolean")
        .when(F.is_variant_null(value), "null").when(whole, "integer").otherwise("number")
    )


class Contract:
    """A JSON Schema as an expression."""

    def __init__(self, schema: dict[str, Any], defs: dict[str, Any] | None = None) -> None:
        self.schema = schema
        self.defs = defs if defs is not None else {"#": schema} | {f"#/$defs/{k}": v for k, v in schema.get("$defs", {}).items()}

    def resolved(self, schema: dict[str, Any]) -> dict[str, Any]:
        while "$ref" in schema:
            if schema["$ref"] not in self.defs:
                raise ValueError(f"contract: unknown reference {schema['$ref']}")
            schema = {**self.defs[schema["$ref"]], **{k: v for k, v in schema.items() if k != "$ref"}}
        if more := schema.keys() - WORDS - NOTES:
            raise ValueError(f"contract: words that are not checked: {sorted(more)}")
        return schema

    def declared(self, schema: dict[str, Any]) -> dict[str, Any]:
        """The members that an object may have by the schema and all that it is made of."""
        found = dict(schema.get("properties", {}))
        for part in [*schema.get("allOf", ()), *(schema[k] for k in ("if", "then", "else") if k in schema)]:
            found |= self.declared(self.resolved(part))
        return found

    def violations(self, value: Column, path: Column, schema: dict[str, Any] | None = None, depth: int = 0) -> Column:
        """What a variant that is there breaks, in the order of the schema, undeclared members last."""
        schema = self.resolved(self.schema if schema is None else schema)
        if depth > 32:
            raise ValueError("contract: references without end")
        return let(F.struct(value.alias("v"), _kind(value).alias("kind")), lambda x: self._checks(x["v"], x["kind"], path, schema, depth))

    def _checks(self, value: Column, kind: Column, path: Column, schema: dict[str, Any], depth: int) -> Column:
        out, words = [], schema.keys()
        if "type" in words:
            kinds = [schema["type"]] if isinstance(schema["type"], str) else list(schema["type"])
            out.append(_wrong(~kind.isin(*kinds, *(["integer"] if "number" in kinds else [])), path, "type"))
        told = F.to_json(value)
        if "enum" in words or "const" in words:
            allowed = [json.dumps(v, ensure_ascii=False, separators=(",", ":"), sort_keys=True) for v in schema.get("enum", [schema.get("const")])]
            out.append(_wrong(~told.isin(*allowed), path, "enum" if "enum" in words else "const"))
        text = F.when(kind == "string", F.try_variant_get(value, "$", "string"))
        for word, bad in (("minLength", lambda n: F.char_length(text) < n), ("maxLength", lambda n: F.char_length(text) > n), ("pattern", lambda p: ~text.rlike(p))):
            if word in words:
                out.append(_wrong(bad(schema[word]), path, word))
        if "format" in words:
            sound = text.rlike(FORMATS[schema["format"]])
            if schema["format"] != "uri":
                sound = sound & F.substring(text, 1, 10).try_cast("date").isNotNull()
            out.append(_wrong(text.isNotNull() & ~sound, path, "format"))
        number = F.when(kind.isin("integer", "number"), F.try_variant_get(value, "$", "double"))
        for word, bad in (("minimum", lambda n: number < n), ("maximum", lambda n: number > n)):
            if word in words:
                out.append(_wrong(bad(schema[word]), path, word))
        if words & {"minItems", "maxItems", "uniqueItems", "items"}:
            out.append(let(F.try_variant_get(value, "$", "array<variant>"), lambda a: self._items(a, path, schema, depth)))
        if words & {"required", "properties", "additionalProperties", "unevaluatedProperties"}:
            out.append(F.when(kind == "object", let(opened(value), lambda m: self._members(m, path, schema, depth))).otherwise(F.array().cast(VIOLATION)))
        below = lambda part: self.violations(value, path, part, depth + 1)
        out += [below(part) for part in schema.get("allOf", ())]
        fits = lambda part: F.size(below(part)) == 0
        for word in ("anyOf", "oneOf"):
            if word in words:
                n = reduce(lambda a, b: a + b, [fits(part).cast("int") for part in schema[word]])
                out.append(_wrong(n == 0 if word == "anyOf" else n != 1, path, word))
        if "not" in words:
            out.append(_wrong(fits(schema["not"]), path, "not"))
        if "if" in words:
            then, other = (below(schema[k]) if k in words else F.array().cast(VIOLATION) for k in ("then", "else"))
            out.append(F.when(fits(schema["if"]), then).otherwise(other))
        return _all(out)

    def _items(self, items: Column, path: Column, schema: dict[str, Any], depth: int) -> Column:
        out, n = [], F.size(items)
        if "minItems" in schema:
            out.append(_wrong(n < schema["minItems"], path, "minItems"))
        if "maxItems" in schema:
            out.append(_wrong(n > schema["maxItems"], path, "maxItems"))
        if schema.get("uniqueItems"):
            out.append(_wrong(F.size(F.array_distinct(F.transform(items, lambda x: F.to_json(x)))) < n, path, "uniqueItems"))
        if isinstance(schema.get("items"), dict):
            place = lambda i: F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))
            out.append(F.flatten(F.transform(items, lambda x, i: self.violations(x, place(i), schema["items"], depth + 1))))
        return F.when(items.isNotNull(), _all(out)).otherwise(F.array().cast(VIOLATION))

    def _members(self, members: Column, path: Column, schema: dict[str, Any], depth: int) -> Column:
        out = [_wrong(~F.map_contains_key(members, name), _member(path, F.lit(name)), "required") for name in schema.get("required", ())]
        for name, part in schema.get("properties", {}).items():
            if part is not True:
                here = members[name]
                out.append(F.when(F.map_contains_key(members, name), self.violations(here, _member(path, F.lit(name)), part, depth + 1)).otherwise(F.array().cast(VIOLATION)))
        if schema.get("additionalProperties") is False or schema.get("unevaluatedProperties") is False:
            known = self.declared(schema) if schema.get("unevaluatedProperties") is False else schema.get("properties", {})
            others = F.array_sort(F.array_except(F.map_keys(members), F.array(*map(F.lit, sorted(known))).cast("array<string>")))
            out.append(F.transform(others, lambda k: F.struct(_member(path, k).alias("path"), F.lit("undeclared").alias("rule"))))
        elif isinstance(schema.get("additionalProperties"), dict):
            known, rest = F.array(*map(F.lit, sorted(schema.get("properties", {})))).cast("array<string>"), schema["additionalProperties"]
            others = F.array_sort(F.array_except(F.map_keys(members), known))
            out.append(F.flatten(F.transform(others, lambda k: self.violations(members[k], _member(path, k), rest, depth + 1))))
        return _all(out)


def contract_violations(df: DataFrame, payload: str, schema: dict[str, Any], column: str = "violations") -> DataFrame:
    """``df`` with violations: path and rule of all that the JSON text in ``payload`` breaks; none for a payload that fits.

    Rules are named by the words of the schema; ``undeclared`` is a member that a closed object doesn't declare. A text
    that is absent or no JSON (repeated keys included) breaks ``json``. An old column of this name is replaced.
    """
    contract = Contract(schema)
    broken = F.array(F.struct(F.lit("").alias("path"), F.lit("json").alias("rule")))
    told = let(F.try_parse_json(payload), lambda v: F.when(v.isNull(), broken).otherwise(contract.violations(v, F.lit(""))))
    return df.withColumn(column, told)
