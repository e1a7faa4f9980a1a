"""Closed contracts against a plain validator over random payloads."""

import json
import random
import re

import pytest

from tidemark.operators import contracts

SCHEMA = {
    "$schema": "x", "type": "object", "additionalProperties": False, "required": ["id", "kind", "props"],
    "properties": {
        "id": {"type": "integer", "minimum": 0}, "kind": {"enum": ["a", "b", 3, None]}, "title": {"type": ["string", "null"], "minLength": 2, "maxLength": 4, "pattern": "^[a-z]"},
        "day": {"type": "string", "format": "date"}, "web": {"format": "uri"}, "ok": {"type": "boolean"}, "amount": {"$ref": "#/$defs/amount"},
        "tags": {"type": "array", "minItems": 1, "maxItems": 3, "uniqueItems": True, "items": {"type": "string", "minLength": 1}},
        "props": {"type": "object", "additionalProperties": False, "properties": {"k": {"type": "integer", "maximum": 50}, "deep": {"type": "array", "items": {"$ref": "#/$defs/amount"}}}},
        "free": {"type": "object", "additionalProperties": {"type": "integer"}}, "one": {"oneOf": [{"type": "string"}, {"enum": ["s", 1]}]}, "any": {"anyOf": [{"type": "number"}, {"const": "x"}]},
    },
    "if": {"properties": {"kind": {"const": "a"}}, "required": ["kind"]}, "then": {"required": ["title"]}, "allOf": [{"not": {"required": ["ok", "web"]}}],
    "$defs": {"amount": {"type": "object", "additionalProperties": False, "required": ["value"], "properties": {"value": {"type": "string", "pattern": r"^\d+$"}, "currency": {"const": "EUR"}}}},
}


def kind(v):
    return "null" if v is None else "boolean" if isinstance(v, bool) else "integer" if isinstance(v, int) or isinstance(v, float) and v == int(v) else "number" if isinstance(v, float) else {str: "string", list: "array", dict: "object"}[type(v)]


def plain(v, s, path=""):
    if "$ref" in s:
        s = SCHEMA["$defs"][s["$ref"].rsplit("/", 1)[1]]
    out, say = [], lambda bad, rule, p=path: out.append((p, rule)) if bad else None
    at = lambda k: f"{path}.{k}" if path else k
    same = lambda a, b: json.dumps(a, sort_keys=True) == json.dumps(b, sort_keys=True)
    if "type" in s:
        kinds = [s["type"]] if isinstance(s["type"], str) else s["type"]
        say(kind(v) not in kinds and not (kind(v) == "integer" and "number" in kinds), "type")
    for word in ("enum", "const"):
        if word in s:
            say(not any(same(v, x) for x in (s[word] if word == "enum" else [s[word]])), word)
    if isinstance(v, str):
        say(len(v) < s.get("minLength", 0), "minLength")
        say(len(v) > s.get("maxLength", 99), "maxLength")
        say("pattern" in s and not re.search(s["pattern"], v), "pattern")
        say(s.get("format") == "date" and v not in ("2024-02-29",), "format")
        say(s.get("format") == "uri" and v != "https://a.example/x", "format")
    if kind(v) in ("integer", "number"):
        say(v < s.get("minimum", v), "minimum")
        say(v > s.get("maximum", v), "maximum")
    if isinstance(v, list):
        say(len(v) < s.get("minItems", 0), "minItems")
        say(len(v) > s.get("maxItems", 99), "maxItems")
        say(s.get("uniqueItems") and len({json.dumps(x, sort_keys=True) for x in v}) < len(v), "uniqueItems")
        for i, x in enumerate(v) if "items" in s else ():
            out += plain(x, s["items"], f"{path}[{i}]")
    if isinstance(v, dict):
        for k in s.get("required", ()):
            say(k not in v, "required", at(k))
        for k, part in s.get("properties", {}).items():
            if k in v:
                out += plain(v[k], part, at(k))
        for k in sorted(v.keys() - s.get("properties", {}).keys()):
            if s.get("additionalProperties") is False:
                out.append((at(k), "undeclared"))
            elif isinstance(s.get("additionalProperties"), dict):
                out += plain(v[k], s["additionalProperties"], at(k))
    for part in s.get("allOf", ()):
        out += plain(v, part, path)
    say("anyOf" in s and all(plain(v, p, path) for p in s.get("anyOf", ())), "anyOf")
    say("oneOf" in s and sum(not plain(v, p, path) for p in s.get("oneOf", ())) != 1, "oneOf")
    say("not" in s and not plain(v, s.get("not", {}), path), "not")
    if "if" in s and not plain(v, s["if"], path):
        out += plain(v, s["then"], path)
    return out


def payload(rng):
    scalar = lambda: rng.choice([None, True, 0, 3, 51, -1, 2.5, "", "a", "abc", "ABCDE", "x", "s", "12", "2024-02-29", "2023-02-29", "https://a.example/x", "EUR", [], {}])
    amount = lambda: rng.choice([{"value": "12"}, {"value": "12", "currency": "EUR"}, {"value": 12}, {"currency": "USD", "other": 1}, scalar()])
    good = {"id": 3, "kind": "b", "title": "abc", "day": "2024-02-29", "web": "https://a.example/x", "ok": True, "amount": {"value": "1"}, "tags": ["x", "y"], "props": {"k": 7, "deep": [{"value": "1"}]}, "free": {"z": 1}, "one": "q", "any": 2.5}
    v = {k: x for k, x in good.items() if rng.random() < 0.8}
    for _ in range(rng.randint(0, 3)):
        v[rng.choice([*good, "new", "é"])] = rng.choice([scalar(), amount(), [scalar(), scalar()], {"k": scalar(), "more": scalar()}, {"deep": [amount(), amount()]}])
    return v


def test_violations_equal_plain_validator(spark):
    rng = random.Random(3)
    made = [payload(rng) for _ in range(400)] + [7, [], None, "x"]
    said = [json.dumps(v, ensure_ascii=False) for v in made]
    df = spark.createDataFrame([*((k, s, "old") for k, s in enumerate(said)), (-1, None, ""), (-2, "{", ""), (-3, '{"id":1,"id":2}', "")], "id int, p string, violations string")
    got = {r["id"]: sorted(tuple(x) for x in r["violations"]) for r in contracts.contract_violations(df, "p", SCHEMA).collect()}
    assert got.pop(-1) == got.pop(-2) == got.pop(-3) == [("", "json")]
    wrong = [(said[k], got[k], sorted(plain(v, SCHEMA))) for k, v in enumerate(made) if got[k] != sorted(plain(v, SCHEMA))]
    assert not wrong, wrong[:3]
    assert len({rule for v in got.values() for _, rule in v}) >= 12


def test_unknown_words_are_refused():
    with pytest.raises(ValueError):
        contracts.Contract({"dependentRequired": {}}).resolved({"dependentRequired": {}})
