"""Whether a web address or a stated place of a source may be kept or linked, and if not, why."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

MOST = 2048
DECODINGS = 4


@F.pandas_udf(StringType())
def ascii_host(host: pd.Series) -> pd.Series:
    """The host as IDNA writes it in ASCII, or null where that can't be done."""

    def one(x: str | None) -> str | None:
        try:
            return x.encode("idna").decode("ascii") if x else None
        except UnicodeError:
            return None

    return host.map(one, na_action="ignore")


def _bare(authority: Column) -> Column:
    """The host of an authority without credentials and port, brackets kept."""
    return F.regexp_replace(F.regexp_replace(authority, "^.*@", ""), r":[0-9]*$", "")


def web_verdict(url: Column, schemes: tuple[str, ...] = ("http", "https"), most: int = MOST) -> Column:
    """ok, or the first of: blank, long, character, percent, scheme, credentials, port, address, host.

    Hosts are judged in ASCII: two labels at least, none of them odd, not local. Addresses are IPv6 in brackets and hosts
    that end in a number in any notation, as browsers read those as addresses too.
    """
    parts = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)"
    authority = F.regexp_extract(url, parts, 2)
    port = F.regexp_extract(F.regexp_replace(authority, "^.*@", ""), r":([^\]:]*)$", 1)
    host = F.lower(_bare(authority))
    plain = ascii_host(host)
    label = "[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?"
    sound = plain.rlike(rf"^{label}(?:\.{label})+$") & (F.length(plain) <= 253) & ~plain.rlike(r"\.(local|localhost)$")
    return (
        F.when(url.isNull() | (url == ""), "blank").when(F.char_length(url) > most, "long").when(url.rlike(r"(?U)[\s\x00-\x1f\x7f\\]"), "character")
        .when(url.rlike("%(?![0-9A-Fa-f]{2})"), "percent").when(~F.lower(F.regexp_extract(url, parts, 1)).isin(*schemes), "scheme").when(authority.contains("@"), "credentials")
        .when(~port.rlike("^[0-9]*$") | F.coalesce(port.try_cast("int") > 65535, F.lit(False)) | (F.length(port) > 9), "port")
        .when(host.rlike(r"^\[|(^|\.)(0x[0-9a-f]*|[0-9]+)\.?$"), "address").when(~F.coalesce(sound, F.lit(False)), "host").otherwise("ok")
    )


def locator_verdict(text: Column, most: int = MOST) -> Column:
    """ok, or why a stated place, which may be no address at all, may not even be kept as it is: blank, long, outer_blank,
    character, percent, undecodable, endless (still encoded after DECODINGS rounds), scheme or credentials.

    Credentials are looked for in the text and in all its decodings, also behind // and without a scheme.
    """
    # a sign of percent that encodes nothing stands for itself
    decode = lambda u: F.try_url_decode(F.replace(F.regexp_replace(u, "%(?![0-9A-Fa-f]{2})", "%25"), F.lit("+"), F.lit("%2B")))
    layers = reduce(lambda found, _: [*found, decode(found[-1])], range(DECODINGS + 1), [text])
    lost = reduce(lambda a, b: a | b, [u.isNull() | (u.contains("�") & ~text.contains("�")) for u in layers[1:]])
    authority = lambda u: F.regexp_extract(u, r"(?s)^(?:(?:(?!://).)*://)?(?://)?([^/?#]*)", 1)
    named = reduce(lambda a, b: a | b, [F.coalesce(authority(u).contains("@"), F.lit(False)) for u in layers[:-1]])
    scheme = F.lower(F.regexp_extract(text, "^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    return (
        F.when(text.isNull() | (text == ""), "blank").when(F.char_length(text) > most, "long").when(text.startswith(" ") | text.endswith(" "), "outer_blank")
        .when(text.rlike(r"(?U)[\x00-\x1f\x7f-\x9f\\]|(?! )\s"), "character").when(text.rlike("%(?![0-9A-Fa-f]{2})"), "percent").when(F.coalesce(lost, F.lit(True)), "undecodable")
        .when(layers[-1] != layers[-2], "endless").when((scheme != "") & ~scheme.isin("http", "https"), "scheme").when(named, "credentials").otherwise("ok")
    )
