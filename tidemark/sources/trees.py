"""Readers of official publications: JSON trees, Atom feeds and HTML lists."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ITEM = "struct<id: string, title: string, url: string>"
#: A day's summary: sections hold departments, which hold items directly or under headings.
SUMMARY = f"struct<number: string, sections: array<struct<code: string, departments: array<struct<code: string, name: string, items: array<{ITEM}>, headings: array<struct<name: string, items: array<{ITEM}>>>>>>>>"
PAGE = "struct<content: array<struct<id: bigint, code: string, title: string, received: string>>, pageNumber: bigint, totalPages: bigint, totalElements: bigint, first: boolean, last: boolean>"
ENTRY = "id string, updated string, title string, summary string, link struct<_href: string>"


def summary_items(df: DataFrame, json: str) -> DataFrame:
    """One row per item of each summary, in document order: section, department, heading (or null), item fields.

    JSON that doesn't parse gives no rows and is told apart by ``malformed``.
    """
    tree = df.select("*", F.from_json(json, SUMMARY).alias("s"))
    sections = tree.select(F.col("s.number").alias("number"), F.posexplode("s.sections").alias("section_at", "x"))
    departments = sections.select("number", "section_at", F.col("x.code").alias("section"), F.posexplode("x.departments").alias("department_at", "d"))
    own = F.transform(F.coalesce("d.items", F.array().cast(f"array<{ITEM}>")), lambda i: F.struct(F.lit(None).cast("string").alias("heading"), i.alias("item")))
    under = F.flatten(F.transform(F.coalesce("d.headings", F.array().cast(f"array<struct<name: string, items: array<{ITEM}>>>")), lambda h: F.transform(h["items"], lambda i: F.struct(h["name"].alias("heading"), i.alias("item")))))
    rows = departments.select("number", "section_at", "section", "department_at", F.col("d.code").alias("department"), F.posexplode(F.concat(own, under)).alias("item_at", "x"))
    return rows.select("number", "section", "department", "x.heading", "x.item.*", "section_at", "department_at", "item_at")


def malformed(df: DataFrame, json: str, schema: str) -> DataFrame:
    """The rows whose JSON is there but doesn't parse."""
    return df.where(F.col(json).isNotNull() & F.from_json(json, schema).isNull())


def page_violations(page: Column, wanted: Column) -> Column:
    """Names of what a result page contradicts: its number, first and last flags, and how many it holds."""
    checks = {
        "number": page["pageNumber"] == wanted,
        "first": page["first"] == (page["pageNumber"] == 0),
        "last": page["last"] == (page["pageNumber"] + 1 >= page["totalPages"]),
        "total": F.size(page["content"]) <= page["totalElements"],
    }
    return F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items())))


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """Entries of Atom pages as text columns. Pages that declare a document type are refused, not read as empty."""
    whole = spark.read.text(path, wholetext=True)
    if not whole.where(F.col("value").rlike(r"(?i)<!(DOCTYPE|ENTITY)")).isEmpty():
        raise ValueError("feed pages must not declare a document type")
    return spark.read.format("xml").option("rowTag", "entry").schema(ENTRY).load(path)


def latest_entries(entries: DataFrame, id_: str = "id", updated: str = "updated") -> tuple[DataFrame, DataFrame]:
    """The newest version of each entry by instant, and the ids whose newest versions differ."""
    rows = entries.withColumn("instant", F.try_to_timestamp(updated)).withColumn("body", F.to_json(F.struct(*(c for c in entries.columns if c != updated))))
    newest = rows.groupBy(id_).agg(F.max("instant").alias("instant"))
    tied = rows.join(newest, [id_, "instant"])
    state = tied.groupBy(id_).agg(F.count_distinct("body").alias("versions"), F.max_by(F.struct(*entries.columns), "body").alias("entry"))
    return state.where("versions = 1").select("entry.*"), state.where("versions > 1").select(id_)


class _List(HTMLParser):
    """Anchors with the headings above them, by nearest level."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[tuple[str, str, list[str]]] = []
        self.headings: dict[int, str] = {}
        self.level, self.href, self.text, self.skip = 0, None, [], 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.skip += 1
        elif len(tag) == 2 and tag[0] == "h" and tag[1].isdigit():
            self.level, self.text = int(tag[1]), []
        elif tag == "a" and (href := dict(attrs).get("href")):
            self.href, self.text = href, []

    def handle_endtag(self, tag):
        said = " ".join("".join(self.text).split())
        if tag in ("script", "style"):
            self.skip = max(0, self.skip - 1)
        elif self.level and tag == f"h{self.level}":
            self.headings = {k: v for k, v in self.headings.items() if k < self.level} | {self.level: said}
            self.level = 0
        elif tag == "a" and self.href is not None:
            self.rows.append((said, self.href, [v for _, v in sorted(self.headings.items())]))
            self.href = None

    def handle_data(self, data):
        if not self.skip and (self.level or self.href is not None):
            self.text.append(data)


def html_links(df: DataFrame, key: str, html: str) -> DataFrame:
    """key, position, title, url and heading_path for every link of a page; null pages have none."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for k, page in zip(batch[key], batch[html]):
                if page:
                    reader = _List()
                    reader.feed(page)
                    reader.close()
                    out += [(k, at, *row) for at, row in enumerate(reader.rows)]
            yield pd.DataFrame(out, columns=[key, "position", "title", "url", "heading_path"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, html).mapInPandas(parse, f"`{key}` {kind}, position int, title string, url string, heading_path array<string>")
