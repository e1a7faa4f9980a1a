"""Announcements of a bulletin page: every download link belongs to the title right beside it.

A small reader walks a page once and tells what stands in it: download blocks with their links, the title that follows
each as its next sibling, the headings above, and how many of each there are. Whether that is a page to trust is decided
by expressions: one that pairs badly gives no announcement but one row of counts, without any text of the page.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .summaries import let, official_url

#: A plain tag and the text behind it: all attributes quoted, without a reference in any.
_PLAIN = re.compile(r"""<(/?)([A-Za-z][A-Za-z0-9]*)((?:[ \t\n\r\f]+[A-Za-z][A-Za-z0-9-]*=(?:'[^'<>&]*'|"[^"<>&]*"))*)[ \t\n\r\f]*(/?)>([^<]*)""")
_ATTRIBUTE = re.compile(r"""([A-Za-z][A-Za-z0-9-]*)=(?:'([^']*)'|"([^"]*)")""")
#: Elements whose text the parser reads by rules of its own; a plain script holds no tag.
_RAW = frozenset("style title textarea xmp iframe noembed noframes noscript plaintext".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCK = "struct<links: array<string>, title: string, title_number: int, heading_path: array<string>>"


@dataclass(frozen=True)
class Layout:
    """What the parts of a page are told by: an id and class names."""

    container: str = "announcements"
    block: str = "download"
    title: str = "title4"
    headings: dict[str, int] = field(default_factory=lambda: {"accordion-header": 1, "title1": 1, "title2": 2, "title3": 3})
    parameter: str = "id"


class _Open:
    """An element that isn't closed yet."""

    __slots__ = ("tag", "classes", "active", "text", "waiting", "block", "title", "titled")

    def __init__(self, tag: str, classes: frozenset[str], active: dict[int, str]) -> None:
        self.tag, self.classes, self.active = tag, classes, active
        self.text: list[str] = []
        self.waiting: int | None = None  # the block whose title the next child may be
        self.block: int | None = None
        self.title: int | None = None
        self.titled: int | None = None  # the block whose title this is


@lru_cache(1024)
def _words(names: str) -> frozenset[str]:
    return frozenset(names.split())


class _Reader(HTMLParser):
    def __init__(self, layout: Layout) -> None:
        super().__init__(convert_charrefs=True)
        self.layout, self.stack = layout, [_Open("", frozenset(), {})]
        self.containers, self.inside, self.titles = 0, 0, 0
        self.links, self.parameter = 0, f"{layout.parameter}="
        self.blocks: list[dict] = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        known, up = dict(attrs), self.stack[-1]
        at = _Open(tag, _words(known.get("class") or ""), up.active)
        if known.get("id") == self.layout.container:
            self.containers += 1
            self.inside = self.inside or len(self.stack)
        waiting, skipped = up.waiting, tag in ("br", "script")
        if self.inside:
            if tag == "span" and self.layout.title in at.classes:
                at.title = self.titles
                self.titles += 1
                if waiting is not None:
                    self.blocks[waiting]["title_number"], at.titled = at.title, waiting
            if tag == "span" and self.layout.block in at.classes:
                at.block = len(self.blocks)
                path = [v for _, v in sorted(up.active.items())]
                self.blocks.append({"links": [], "title": None, "title_number": None, "heading_path": path})
            if tag == "a" and self.parameter in (href := known.get("href") or ""):
                self.links += 1
                for b in self.stack:
                    if b.block is not None:
                        self.blocks[b.block]["links"].append(href)
        if not skipped:
            up.waiting = None
        if tag not in VOID:
            self.stack.append(at)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if self.stack[-1].tag != tag and not any(e.tag == tag for e in self.stack[1:]):
            return
        while len(self.stack) > 1:
            at = self.stack.pop()
            up = self.stack[-1]
            up.text += at.text if at.tag not in ("script", "style") else []
            level = min((n for c, n in self.layout.headings.items() if c in at.classes), default=None) if at.classes else None
            said = " ".join("".join(at.text).split()) if level is not None or at.titled is not None else ""
            if at.titled is not None:
                self.blocks[at.titled]["title"] = said
            if at.block is not None:
                up.waiting = at.block
            if level is not None and said:
                up.active = {k: v for k, v in up.active.items() if k < level} | {level: said}
            if self.inside == len(self.stack):
                self.inside = 0
            if at.tag == tag:
                return

    def handle_data(self, data: str) -> None:
        self.stack[-1].text.append(data)


def read_page(page: str, layout: Layout) -> _Reader:
    """A page that was read to its end. Pages of plain tags alone are cut up by one pattern, which gives what the parser
    would; any other page goes through the parser."""
    reader = _Reader(layout)
    if not _read_plain(reader, page):
        reader = _Reader(layout)
        reader.feed(page)
        reader.close()
    return reader


def _read_plain(reader: _Reader, page: str) -> bool:
    parts = _PLAIN.findall(page)
    if len(parts) != page.count("<"):
        return False
    script = False
    if before := page.partition("<")[0]:
        reader.handle_data(unescape(before))
    for ends, tag, attributes, alone, text in parts:
        tag = tag.lower()
        if tag in _RAW or (ends and (attributes or alone)) or (script and not (ends and tag == "script")):
            return False
        if ends:
            script = False
            reader.handle_endtag(tag)
        else:
            found = [(k.lower(), a or b) for k, a, b in _ATTRIBUTE.findall(attributes)] if attributes else []
            script = tag == "script"
            if script and alone:
                return False
            (reader.handle_startendtag if alone else reader.handle_starttag)(tag, found)
        if text:
            reader.handle_data(unescape(text) if "&" in text and not script else text)
    return not script


def page_parts(pages: DataFrame, key: str, html: str, layout: Layout = Layout()) -> DataFrame:
    """key, containers, titles, links and blocks of every page; null pages have none of them."""
    def lists(found: list[list], kind: pa.DataType) -> pa.Array:
        ends = list(accumulate(map(len, found), initial=0))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array([x for one in found for x in one], kind))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [read_page(page or "", layout) for page in batch.column(1).to_pylist()]
            numbers = [pa.array([getattr(f, name) for f in found], pa.int32()) for name in ("containers", "titles", "links")]
            each = [b for f in found for b in f.blocks]
            fields = [lists([b["links"] for b in each], pa.string()), pa.array([b["title"] for b in each], pa.string()), pa.array([b["title_number"] for b in each], pa.int32()), lists([b["heading_path"] for b in each], pa.string())]
            blocks = pa.StructArray.from_arrays(fields, ["links", "title", "title_number", "heading_path"])
            ends = pa.array(list(accumulate((len(f.blocks) for f in found), initial=0)), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), *numbers, pa.ListArray.from_arrays(ends, blocks)], names=["key", "containers", "titles", "links", "blocks"])

    kind = pages.schema[key].dataType.simpleString()
    found = pages.select(F.col(key).alias("key"), F.col(html).alias("html")).mapInArrow(read, f"key {kind}, containers int, titles int, links int, blocks array<{BLOCK}>")
    return found.withColumnRenamed("key", key)


def announcement_rows(parts: DataFrame, hosts: tuple[str, ...], base: str, layout: Layout = Layout()) -> DataFrame:
    """The announcements of pages (position, id, title, url, heading_path), or one row with code, at (the block that is
    wrong) and the counts of a page that breaks the pairing.

    Codes, the first that holds: container_invalid, empty, structure_invalid, then block by block link_cardinality,
    no_title_after_download, title_already_paired, url_invalid, id_missing, duplicate_id, title_empty, and at last
    unpaired_elements. ``base`` is what relative links are joined to.
    """
    number = lambda u: F.regexp_extract(u, rf"[?&]{layout.parameter}=([^&#]*)", 1)
    joined = lambda u: F.when(u.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), u).otherwise(F.concat(F.lit(base), F.regexp_replace(u, "^/+", "")))
    block = lambda b, u: F.struct(
        F.size(b["links"]).alias("n"), F.size(F.filter(F.split(F.regexp_extract(u, r"\?([^#]*)", 1), "&"), lambda p: p.startswith(f"{layout.parameter}="))).alias("ids"),
        u.alias("url"), number(u).alias("id"), b["title"].alias("title"), b["title_number"].alias("title_number"), b["heading_path"].alias("heading_path"),
    )
    told = parts.withColumn("blocks", F.transform("blocks", lambda b: let(joined(F.get(b["links"], F.lit(0))), lambda u: block(b, u))))

    def wrong(b: Column, i: Column) -> Column:
        before = lambda name: F.array_position(F.col("blocks")[name], b[name]) <= i  # noqa: E731  the first that has it stands before
        return (
            F.when(b["n"] != 1, "link_cardinality").when(b["title_number"].isNull(), "no_title_after_download").when(before("title_number"), "title_already_paired")
            .when(~official_url(b["url"], hosts), "url_invalid").when((b["ids"] != 1) | ~b["id"].rlike("^[0-9]+$"), "id_missing")
            .when(before("id"), "duplicate_id").when(b["title"] == "", "title_empty")
        )

    first = F.get(F.filter(F.transform("blocks", lambda b, i: F.struct(wrong(b, i).alias("code"), i.alias("at"))), lambda w: w["code"].isNotNull()), F.lit(0))
    n = F.size("blocks")
    whole = lambda c: F.struct(F.lit(c).alias("code"), F.lit(None).cast("int").alias("at"))
    issue = F.coalesce(
        F.when(F.col("containers") != 1, whole("container_invalid")), F.when(F.col("titles") == 0, whole("empty")), F.when(n == 0, whole("structure_invalid")), first,
        F.when((F.col("titles") != n) | (F.col("links") != n), whole("unpaired_elements")),
    )
    none = F.array().cast("array<struct<n: int, ids: int, url: string, id: string, title: string, title_number: int, heading_path: array<string>>>")
    rest = [c for c in parts.columns if c not in ("containers", "titles", "links", "blocks")]
    out = told.withColumn("issue", issue).select(
        *rest, F.struct("containers", "titles", "links", n.alias("blocks")).alias("counts"), "issue", F.posexplode_outer(F.when(F.col("issue").isNull(), F.col("blocks")).otherwise(none)).alias("position", "b")
    )
    bad = F.col("issue").isNotNull()
    return out.select(*rest, "position", "b.id", "b.title", "b.url", "b.heading_path", "issue.code", "issue.at", F.when(bad, F.col("counts")).alias("counts"))
