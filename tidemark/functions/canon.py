"""Canonical forms as column expressions: texts, decimals, sets, JSON, URLs, dates and check digits."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Query parameters that only track visits.
TRACKING = "^(utm_[^=]*|gclid|fbclid)(=|$)"
#: Letters that check personal numbers modulo 23, check letters of company numbers, and what these begin with.
PERSON_LETTERS, COMPANY_LETTERS, COMPANY_FIRST = "TRWAGMYFPDXBNJZSQVHLCKE", "JABCDEFGHI", "ABCDEFGHJNPQRSUVW"
#: Spanish month names in order.
MONTHS = ("enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre")


def squeeze(text: Column) -> Column:
    """One blank for each run of white space, none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def slug(text: Column, most: int | None = None) -> Column:
    """Small letters and digits, with a hyphen for each run of anything else."""
    out = F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.substring(out, 1, most) if most else out


@F.pandas_udf(StringType())
def fold(text: pd.Series) -> pd.Series:
    """Case-folded text without accents (compatibility decomposition)."""
    plain = lambda x: "".join(c for c in unicodedata.normalize("NFKD", x).casefold() if not unicodedata.combining(c))
    return text.map(plain, na_action="ignore")


def fold_latin(text: Column) -> Column:
    """Small letters without the accents of Western European languages, inside the JVM."""
    return F.translate(F.lower(text), "áàâäãéèêëíìîïóòôöõúùûüñç", "aaaaaeeeeiiiiooooouuuunc")


def authority_slug(name: Column) -> Column:
    """A page name for an authority: folded, hyphenated, 80 characters at most."""
    return slug(fold(name), 80)


def canonical_decimal(text: Column) -> Column:
    """One text for each number: no trailing zeros, no bare point, 0 without a sign."""
    cut = F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    return F.when(cut.rlike(r"^-?0$"), F.lit("0")).otherwise(cut)


def grouped_decimal(text: Column) -> Column:
    """Thousands apart by points and the fraction after a comma, from exact decimal text."""
    whole, part = F.split_part(text, F.lit("."), F.lit(1)), F.split_part(text, F.lit("."), F.lit(2))
    return F.concat(F.regexp_replace(whole, r"\B(?=(\d{3})+$)", "."), F.when(part != "", F.concat(F.lit(","), part)).otherwise(""))


def canonical_set(items: Column) -> Column:
    """Distinct items in the order of their JSON texts; nulls go."""
    keyed = F.transform(F.array_compact(items), lambda x: F.struct(F.to_json(F.array(x)).alias("k"), x.alias("v")))
    return F.transform(F.array_sort(F.array_distinct(keyed)), lambda x: x["v"])


def canonical_json(fields: dict[str, Column]) -> Column:
    """Compact JSON with sorted keys; null fields are left out."""
    return F.to_json(F.struct(*(fields[k].alias(k) for k in sorted(fields))))


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def url_part(url: Column, part: str) -> Column:
    """scheme, host, path or query of a URL, empty where it has none; never fails."""
    pattern = {
        "scheme": r"^([A-Za-z][A-Za-z0-9+.-]*)://",
        "host": r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)",
        "path": r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)",
        "query": r"^[^?#]*\?([^#]*)",
    }[part]
    return F.regexp_extract(url, pattern, 1)


def canonical_url(url: Column) -> Column:
    """Small scheme and host, single slashes, no end slash or fragment, no tracking parameters; the rest in order."""
    kept = F.array_join(F.filter(F.split(url_part(url, "query"), "&"), lambda x: (x != "") & ~x.rlike(TRACKING)), "&")
    path = F.regexp_replace(F.regexp_replace(url_part(url, "path"), "/+", "/"), "/$", "")
    return F.concat(F.lower(url_part(url, "scheme")), F.lit("://"), F.lower(url_part(url, "host")), path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""))


def decoded_url(url: Column, rounds: int = 4) -> Column:
    """The URL after up to ``rounds`` percent decodings; one that can't be decoded stays."""
    return reduce(lambda u, _: F.coalesce(F.try_url_decode(F.replace(u, F.lit("+"), F.lit("%2B"))), u), range(rounds), url)


def utc_text(instant: Column) -> Column:
    """ISO text of an instant in UTC with Z; text without a zone gives null."""
    zoned = F.when(instant.rlike(r"(Z|[+-]\d\d:?\d\d)$"), F.try_to_timestamp(instant))
    return F.date_format(zoned, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def spanish_date(text: Column) -> Column:
    """The date in "3 de mayo de 2024", or null where there is none or it doesn't exist."""
    pattern = r"(?i)(\d{1,2}) de ([a-zñ]+) de (\d{4})"
    month = F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.regexp_extract(text, pattern, 2)))
    parts = F.format_string("%s-%02d-%s", F.regexp_extract(text, pattern, 3), month, F.lpad(F.regexp_extract(text, pattern, 1), 2, "0"))
    return F.when(text.rlike(pattern) & (month > 0), parts.try_cast("date"))


def person_letter(number: Column) -> Column:
    """The letter that checks a personal number."""
    return F.substring(F.lit(PERSON_LETTERS), (number % 23 + 1).cast("int"), F.lit(1))


def mod97(text: Column) -> Column:
    """A digit text's remainder by 97, digit by digit, so any length fits."""
    return F.aggregate(F.split(text, ""), F.lit(0), lambda a, x: F.when(x == "", a).otherwise((a * 10 + x.cast("int")) % 97))


def compact_id(text: Column) -> Column:
    """An identifier without the separators it may have, in capitals."""
    return F.upper(F.translate(text, " .-", ""))


def valid_iban(text: Column) -> Column:
    """Whether the text has an account number's shape (15 to 34 characters) and its remainder by 97 is 1."""
    compact = F.upper(F.regexp_replace(text, r"[\s-]", ""))
    moved = F.concat(F.substring(compact, 5, 34), F.substring(compact, 1, 4))
    numbers = F.array_join(F.transform(F.split(moved, ""), lambda c: F.when(c.rlike("[A-Z]"), (F.ascii(c) - 55).cast("string")).otherwise(c)), "")
    return compact.rlike("^[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}$") & (F.when(numbers.rlike("^[0-9]+$"), mod97(numbers)) == 1)


def valid_person_id(text: Column) -> Column:
    """Whether the text is a personal number with the right letter; X, Y, Z stand for 0, 1, 2 and K, L, M for none."""
    compact = compact_id(text)
    return _person_shape(compact) & _person_fits(compact)


def _person_shape(compact: Column) -> Column:
    return compact.rlike("^[0-9XYZKLM][0-9]{7}[A-Z]$")


def _person_fits(compact: Column) -> Column:
    """Whether the letter of a compact personal number fits; only asked where the shape does."""
    number = F.concat(F.translate(F.substring(compact, 1, 1), "XYZKLM", "012"), F.substring(compact, 2, 7))
    return person_letter(number.try_cast("bigint")) == F.substring(compact, 9, 1)


def tax_class(text: Column) -> Column:
    """personal_identifier, legal_entity_tax_identifier, ambiguous_tax_identifier or null, by form and check characters."""
    sure = lambda c: F.coalesce(c, F.lit(False))
    told = lambda compact: (
        F.when(_person_shape(compact), F.when(sure(_person_fits(compact)), "personal_identifier").otherwise("ambiguous_tax_identifier"))
        .when(_company_shape(compact), F.when(_company_fits(compact), "legal_entity_tax_identifier").otherwise("ambiguous_tax_identifier"))
    )
    return _let(compact_id(F.trim(text)), told)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def unclassified_tax_shape(text: Column) -> Column:
    """Whether a text that has no class still looks like an identifier: 8 to 12 plain letters and digits, one a digit."""
    return F.trim(text).rlike("^(?=.*[0-9])[A-Za-z0-9]{8,12}$")


def valid_company_id(text: Column) -> Column:
    """Whether the text is a company number whose check character fits its first letter."""
    compact = compact_id(text)
    return _company_shape(compact) & _company_fits(compact)


def _company_shape(compact: Column) -> Column:
    return compact.rlike(f"^[{COMPANY_FIRST}][0-9]{{7}}[0-9A-J]$")


def _company_fits(compact: Column) -> Column:
    """Whether the check character of a compact company number fits; only asked where the shape does."""
    digit = lambda k: F.ascii(F.substring(compact, k, 1)) - 48
    doubled = lambda k: digit(k) * 2 - F.when(digit(k) > 4, 9).otherwise(0)  # noqa: E731  the sum of the two digits
    total = doubled(2) + doubled(4) + doubled(6) + doubled(8) + digit(3) + digit(5) + digit(7)
    first, last = F.substring(compact, 1, 1), F.substring(compact, 9, 1)

    def fits(check: Column) -> Column:
        by_digit = last == check.cast("string")
        by_letter = last == F.substring(F.lit(COMPANY_LETTERS), check + 1, F.lit(1))
        return F.when(first.isin(*"PQRSNW"), by_letter).when(first.isin(*"ABEH"), by_digit).otherwise(by_digit | by_letter)

    return _let((10 - total % 10) % 10, fits)


def encoded_id(text: Column) -> Column:
    """A reversible name for files and addresses: r- and the hex of the UTF-8 bytes."""
    return F.concat(F.lit("r-"), F.lower(F.hex(F.encode(text, "UTF-8"))))


def decoded_id(name: Column) -> Column:
    """The text that encoded_id gave this name, or null."""
    return F.when(name.rlike("^r-([0-9a-f]{2})+$"), F.decode(F.unhex(F.substring(name, 3, 1 << 20)), "UTF-8"))


def is_upper_title(text: Column) -> Column:
    return (text != F.lower(text)) & (text == F.upper(text))


def date_display(day: Column) -> Column:
    """A day as "3 de mayo de 2024"."""
    return F.concat_ws(" de ", F.day(day).cast("string"), F.element_at(F.array(*map(F.lit, MONTHS)), F.month(day)), F.date_format(day, "yyyy"))


def instant_display(text: Column, zone: str = "Europe/Madrid") -> Column:
    """An instant that declares its zone as day and time there; other texts as they are, "No disponible" for none."""
    sound = text.rlike(r"(?i)^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:Z|[+-]\d{2}:?\d{2})$") & F.substring(text, 1, 10).try_cast("date").isNotNull()
    there = F.from_utc_timestamp(F.to_utc_timestamp(F.try_to_timestamp(text), F.current_timezone()), zone)
    said = F.concat(date_display(there), F.lit(", "), F.date_format(there, "HH:mm"))
    return F.when(text.isNull() | (F.trim(text) == ""), "No disponible").when(F.coalesce(sound, F.lit(False)), F.coalesce(said, text)).otherwise(text)


#: Names of authorities that say nothing.
GENERIC_AUTHORITIES = ("LOCAL", "AUTONOMICA", "ESTADO", "OTROS")


def search_text(title: Column, organisms: list[Column]) -> Column:
    """What to ask a search engine: the title and the most specific name that says something; null without a title."""
    plain = [squeeze(c) for c in organisms]
    best = F.coalesce(*(F.when((c != "") & ~F.upper(c).isin(*GENERIC_AUTHORITIES), c) for c in plain))
    return F.when(squeeze(title) != "", F.concat_ws(" ", squeeze(title), best))


def search_url(base: str, text: Column) -> Column:
    """The text as the query of an address, encoded as forms are."""
    return F.concat(F.lit(f"{base}?q="), F.url_encode(text))


def joined_url(base: Column, link: Column) -> Column:
    """A link as it stands on a page: absolute ones as they are, others from the page's host or folder."""
    root = F.concat(url_part(base, "scheme"), F.lit("://"), url_part(base, "host"))
    folder = F.regexp_extract(url_part(base, "path"), "^(.*/)", 1)
    return (
        F.when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(url_part(base, "scheme"), F.lit(":"), link))
        .when(link.startswith("/"), F.concat(root, link))
        .otherwise(F.concat(root, F.when(folder == "", "/").otherwise(folder), link))
    )


def safe_name(text: Column) -> Column:
    """A text as one path part: percent-encoded, points too, so no part is special to a file system."""
    return F.replace(F.replace(F.url_encode(text), F.lit("+"), F.lit("%20")), F.lit("."), F.lit("%2E"))


def slug_collisions(df, name: str, page: Column):
    """Page names that several names share; none may."""
    return df.select(F.col(name).alias("_n"), page.alias("slug")).groupBy("slug").agg(F.count_distinct("_n").alias("names")).where("names > 1")
