"""Located matches against a plain version: every name by itself, then what overlaps."""

import re
import unicodedata

from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import match

PLACES = [
    ("province", "12", "Castellón/Castelló", "Castelló", "official_variant"), ("province", "12", "Castellón/Castelló", "Castellón", "official_variant"),
    ("municipality", "12040", "Castelló de la Plana", "Castelló de la Plana", "official_variant"), ("municipality", "12040", "Castelló de la Plana", "Castellón de la Plana", "technical_alias"),
    ("municipality", "12138", "Vinaròs", "Vinaròs", "official_variant"), ("municipality", "12085", "Orpesa", "Oropesa del Mar", "official_variant"), ("municipality", "12085", "Orpesa", "Oropesa", "technical_alias"),
    ("authority", "a1", "Diputación de Castellón", "Diputación de Castellón", "official_variant"), ("municipality", "12999", "Straße", "straße a", "official_variant"), ("authority", "a2", "x", None, "official_variant"),
]
TEXTS = [
    "Anuncio de VINARÒS y Vinaros", "vinarosa, Castellon de la plana y Castellón", "Diputación de Castellón", "castelló", "Oropesa del Mar/Oropesa; oropesa",
    "STRASSE A strasse a straße", "_Vinaròs_ Vinaròs2", "", None, "ﬁn Vinaròś!", "Castelló de la Plana de la Plana",
]


def fold(text):
    return "".join(c for c in unicodedata.normalize("NFKD", text).casefold() if not unicodedata.combining(c))


def plain(fields):
    out = []
    for field, text in fields:
        if not text:
            continue
        low, at = "", []
        for k, c in enumerate(text):
            low += fold(c)
            at += [k] * len(fold(c))
        hits = []
        for kind, code, name, variant, method in PLACES:
            if variant:
                for m in re.finditer(rf"(?<!\w){re.escape(fold(variant))}(?!\w)", low):
                    hits.append((m.start(), m.end(), kind, code, method != "official_variant", name, method))
        strong = sorted(h for h in hits if h[2] != "province")
        weak = sorted(h for h in hits if h[2] == "province" and not any(s[0] <= h[0] and h[1] <= s[1] for s in strong))
        seen = set()
        for start, end, kind, code, _, name, method in strong + weak:
            if (kind, code) not in seen:
                seen.add((kind, code))
                a, b = at[start], at[end - 1] + 1
                out.append((f"{kind}_exact", code, name, field, text[a:b], method, a, b))
    return out


def test_located_matches(spark):
    made = [(k, a, b, "kept") for k, (a, b) in enumerate(zip(TEXTS, reversed(TEXTS)))]
    df = spark.createDataFrame(made, "id int, heading string, title string, matches string").withColumn("_field0", F.lit("clash"))
    entities = spark.createDataFrame(PLACES, "kind string, code string, name string, variant string, method string")
    got = match.located_matches(df.drop("_field0"), {"heading": F.col("heading"), "title": F.col("title")}, entities).collect()
    assert {r["id"]: [tuple(m) for m in r["matches"]] for r in got} == {k: plain([("heading", a), ("title", b)]) for k, a, b, _ in made}
    none = match.located_matches(df, {"heading": F.col("heading")}, entities.where("false")).collect()
    assert [r["matches"] for r in none] == [[]] * len(TEXTS)


def test_dictionary_in_blocks(spark, monkeypatch):
    texts = spark.createDataFrame([(k % 5, t) for k, t in enumerate(TEXTS * 3)], "id int, t string")
    names = spark.createDataFrame([(f"{k}", p[3]) for k, p in enumerate(PLACES)] + [("p", "de la plana")], "c string, n string")
    whole = rows(match.dictionary_match(texts, "id", F.col("t"), names, "c", F.col("n")))
    monkeypatch.setattr(match, "MOST_NAMES", 3)
    assert whole and rows(match.dictionary_match(texts, "id", F.col("t"), names, "c", F.col("n"))) == whole
