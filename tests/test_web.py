"""Web addresses and stated places: hard cases, and a plain version over random texts."""

import ipaddress
import random
import re
from urllib.parse import unquote, urlsplit

from pyspark.sql import functions as F

from tidemark.functions import web


def plain_url(url):
    """Whether a supplied address may be linked."""
    if not url or len(url) > 2048 or any(c.isspace() or ord(c) < 32 or ord(c) == 127 for c in url) or "\\" in url or re.search(r"%(?![0-9a-fA-F]{2})", url):
        return False
    try:
        at = urlsplit(url)
        if at.scheme not in ("http", "https") or not at.hostname or at.username is not None or at.password is not None or at.port == -1:
            return False
        try:
            ipaddress.ip_address(at.hostname)
            return False
        except ValueError:
            pass
        host = at.hostname.encode("idna").decode("ascii")
    except ValueError:
        return False
    labels = host.split(".")
    if re.fullmatch(r"0x[0-9a-f]*|[0-9]+", labels[-1]):
        return False
    return len(labels) >= 2 and len(host) <= 253 and not host.endswith((".local", ".localhost")) and all(re.fullmatch(r"[a-zA-Z0-9](?:[a-zA-Z0-9-]{0,61}[a-zA-Z0-9])?", x) for x in labels)


def plain_place(text):
    """Whether a stated place may be kept."""
    if not text or len(text) > 2048 or text[0] == " " or text[-1] == " " or "\\" in text or re.search(r"%(?![0-9a-fA-F]{2})", text):
        return False
    if any(c != " " and c.isspace() or ord(c) < 32 or 127 <= ord(c) <= 159 for c in text):
        return False
    found = [text]
    try:
        for _ in range(5):
            found.append(unquote(found[-1], errors="strict"))
    except UnicodeError:
        return False
    scheme = re.match(r"([a-zA-Z][a-zA-Z0-9+.-]*):", text)
    if found[5] != found[4] or scheme and scheme[1].lower() not in ("http", "https"):
        return False
    return not any("@" in re.split("[/?#]", u.split("://", 1)[-1].removeprefix("//"), maxsplit=1)[0] for u in found[:5])


URLS = {
    "https://a.example/x?y=1": "ok", "http://españa.example/ñ": "ok", "HTTPS://A.example:443/": "ok", "https://a.example:/": "ok", "": "blank", None: "blank", "https://a.example/ x": "character", "https://a.example/\\x": "character",
    "https://a.example/%4": "percent", "ftp://a.example/": "scheme", "a.example": "scheme", "https://u@a.example/": "credentials", "https://u:p@a.example/": "credentials", "https://a.example:x/": "port", "https://a.example:70000/": "port",
    "https://10.0.0.1/": "address", "https://[::1]/": "address", "https://2130706433/": "address", "https://0x7f.0x1/": "address", "https://127.1/": "address", "https://localhost/": "host", "https://printer.local/": "host",
    "https://a..example/": "host", "https://-a.example/": "host", "https:///x": "host", f"https://{'a' * 64}.example/": "host", "https://a.example/" + "x" * 2048: "long",
}
PLACES = {
    "DOGV 1234, página 5": "ok", "https://a.example/x?m=a@b": "ok", "www.a.example/100%25": "ok", " x": "outer_blank", "x y": "character", "x\\y": "character", "50%": "percent", "%ff": "undecodable", "mailto:a@b.example": "scheme",
    "javascript:x": "scheme", "//u@a.example/": "credentials", "u:p@a.example": "scheme", "https://a.example%40b.example/": "credentials", "https://u%2540a.example": "credentials", "%2525252525252531": "endless", None: "blank",
}


def test_hard_cases(spark):
    urls, places = spark.createDataFrame([(u,) for u in URLS], "u string"), spark.createDataFrame([(p,) for p in PLACES], "u string")
    assert {r[0]: r[1] for r in urls.select("u", web.web_verdict(F.col("u"))).collect()} == URLS
    assert {r[0]: r[1] for r in places.select("u", web.locator_verdict(F.col("u"))).collect()} == PLACES
    assert all(plain_url(u) == (v == "ok") for u, v in URLS.items()) and all(plain_place(p) == (v == "ok") for p, v in PLACES.items())


def test_random_texts_equal_plain_versions(spark):
    rng = random.Random(4)
    bits = ["https://", "http:", "//", "a", "b.example", ".", ":", "80", "@", "%40", "%25", "40", "%", "/", "?", "#", "ü", " ", "\t", "+", "%C3%A9", "1.2.3.4", "[", "]", "-", "%2525"]
    made = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 7))) for _ in range(1500)] + ["https://" + "".join(rng.choice(bits) for _ in range(rng.randint(1, 5))) for _ in range(1500)]
    got = spark.createDataFrame([(x,) for x in made], "x string").select("x", web.web_verdict(F.col("x")).alias("u"), web.locator_verdict(F.col("x")).alias("p")).collect()
    assert not [r for r in got if (r["p"] == "ok") != plain_place(r["x"])][:5]
    assert not [r for r in got if (r["u"] == "ok") != plain_url(r["x"])][:5]
