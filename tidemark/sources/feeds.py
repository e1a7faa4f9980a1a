"""Atom pages of procurement notices: a page is read once, and either its entries, removals and own fields become rows or
one row tells why the page is refused. A small reader keeps the declared fields of each entry and its limits; what the
fields mean (single values, sets, contradictions, dates) is expressions over them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# fixed values: name spaces and the names they go by here
SPACES = {
    "http://www.w3.org/2005/Atom": "atom",
    "http://purl.org/atompub/tombstones/1.0": "tomb",
    "urn:dgpe:names:draft:codice:schema:xsd:CommonBasicComponents-2": "cbc",
    "urn:oasis:names:specification:ubl:schema:xsd:CommonBasicComponents-2": "cbc",
    "urn:dgpe:names:draft:codice:schema:xsd:CommonAggregateComponents-2": "cac",
    "urn:oasis:names:specification:ubl:schema:xsd:CommonAggregateComponents-2": "cac",
    "urn:dgpe:names:draft:codice-place-ext:schema:xsd:CommonAggregateComponents-2": "ext",
    "urn:dgpe:names:draft:codice-place-ext:schema:xsd:CommonBasicComponents-2": "bext",
}
_S = "atom:feed/atom:entry/ext:ContractFolderStatus"
#: The fields that are kept, by path; all else is left out as it is read.
FIELDS = {
    "atom:feed/atom:id": "feed_id", "atom:feed/atom:updated": "feed_updated", "atom:feed/atom:link": "feed_link", "atom:feed/tomb:deleted-entry": "deleted", "atom:feed/tomb:deleted-entry/tomb:comment": "comment",
    "atom:feed/atom:entry/atom:id": "id", "atom:feed/atom:entry/atom:updated": "updated", "atom:feed/atom:entry/atom:title": "title", _S: "status_group", f"{_S}/cac:ProcurementProjectLot": "lot",
    f"{_S}/cbc:ContractFolderID": "folder", f"{_S}/bext:ContractFolderStatusCode": "status", f"{_S}/ext:LocatedContractingParty/cac:Party/cac:PartyIdentification/cbc:ID": "party",
    f"{_S}/cac:ProcurementProject/cbc:TypeCode": "contract_type", f"{_S}/cac:ProcurementProject/cac:RequiredCommodityClassification/cbc:ItemClassificationCode": "cpv",
    f"{_S}/cac:ProcurementProject/cac:RealizedLocation/cbc:CountrySubentityCode": "place", f"{_S}/cac:TenderingProcess/cbc:ProcedureCode": "procedure",
    f"{_S}/cac:TenderingProcess/cac:TenderSubmissionDeadlinePeriod/cbc:EndDate": "deadline", f"{_S}/ext:ValidNoticeInfo": "notice", f"{_S}/ext:ValidNoticeInfo/bext:NoticeTypeCode": "notice_type",
    f"{_S}/ext:ValidNoticeInfo/bext:NoticeIssueDate": "notice_date",
}
RECORDS = {"atom:feed/atom:entry": "entry", "atom:feed/tomb:deleted-entry": "deleted"}
ATTRIBUTES = ("schemeName", "listURI", "listVersionID", "rel", "href", "ref", "when", "type")
LEAF = "struct<field: string, part: int, text: string, attributes: map<string,string>>"
MOST_ATTRIBUTE = 300


@dataclass(frozen=True)
class Limits:
    """What one page may hold; a page beyond any of these is refused whole."""

    size: int = 32 << 20
    depth: int = 64
    nodes: int = 2_000_000
    text: int = 20_000
    entries: int = 5_000


class Refused(ValueError):
    """Why a page is not read."""


class _Page:
    """Collects the kept fields of a page: (record kind, number, [(field, part, text, attributes)])."""

    def __init__(self, limits: Limits) -> None:
        self.limits, self.nodes, self.entries, self.parts = limits, 0, 0, 0
        self.path: list[str] = []
        self.open: list[list] = []  # number of its part, own text, its length, attributes
        self.feed: list[tuple] = []
        self.rows: list[tuple[str, int, list]] = []
        self.own: list[tuple] = self.feed

    def begin(self, name: str, attributes: dict[str, str]) -> None:
        uri, _, local = name.rpartition("}")
        here = f"{SPACES.get(uri, 'other')}:{local}"
        self.path.append(f"{self.path[-1]}/{here}" if self.path else here)
        self.nodes += 1
        if len(self.path) > self.limits.depth or self.nodes > self.limits.nodes:
            raise Refused("limits_exceeded")
        if self.path[0] != "atom:feed":
            raise Refused("invalid_atom_root")
        if self.path[-1] in RECORDS:
            self.entries += RECORDS[self.path[-1]] == "entry"
            if self.entries > self.limits.entries:
                raise Refused("limits_exceeded")
            self.own, self.parts = [], 0
        self.parts += 1
        self.open.append([self.parts, [], 0, {k: attributes[k] for k in ATTRIBUTES if k in attributes}])

    def said(self, data: str) -> None:
        top, kept = self.open[-1], self.path[-1] in FIELDS
        if kept or not data.isspace():
            top[2] += len(data)
            if top[2] > self.limits.text:
                raise Refused("limits_exceeded")
        if kept:
            top[1].append(data)

    def end(self, _: str) -> None:
        path = self.path.pop()
        _, text, _, attributes = self.open.pop()
        if (field := FIELDS.get(path)) and (field != "party" or attributes.get("schemeName") in ("ID_PLATAFORMA", "DIR3")):
            self.own.append((field, self.open[-1][0], "".join(text), attributes))
        if path in RECORDS:
            self.rows.append((RECORDS[path], self.entries - 1, self.own))
            self.own = self.feed

    def refuse(self, *_: object) -> None:
        raise Refused("xml_security_rejection")


def read_page(page: str | None, limits: Limits) -> list[tuple[str, int | None, list, str | None]]:
    """The rows of a page: its records, then its own fields; or one row of kind ``refused`` with the reason."""
    data = (page or "").encode()
    reader = _Page(limits)
    try:
        if not data:
            raise Refused("invalid_xml")
        if len(data) > limits.size:
            raise Refused("limits_exceeded")
        head = page[:200].lower()
        if head.lstrip("﻿").startswith("<?xml") and "encoding" in head.split("?>")[0] and "utf-8" not in head.split("?>")[0].split("encoding", 1)[1]:
            raise Refused("xml_encoding_unsupported")
        parser = expat.ParserCreate(namespace_separator="}")
        parser.buffer_text = True
        parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = reader.begin, reader.end, reader.said
        parser.StartDoctypeDeclHandler = parser.EntityDeclHandler = parser.ExternalEntityRefHandler = reader.refuse
        parser.Parse(data, True)
        links = {a.get("href", "") for f, _, _, a in reader.feed if f == "feed_link" and a.get("rel") == "next"}
        if len(links) > 1:
            raise Refused("pagination_ambiguous")
    except Refused as why:
        return [("refused", None, [], str(why))]
    except expat.ExpatError:
        return [("refused", None, [], "invalid_xml")]
    return [*((k, n, leaves, None) for k, n, leaves in reader.rows), ("feed", None, reader.feed, None)]


def feed_rows(pages: DataFrame, key: str, xml: str, limits: Limits = Limits()) -> DataFrame:
    """key, kind (entry, deleted, feed or refused), number, leaves and code of every page, each read once.

    A page with a document type, bad XML, another encoding or root, several next pages, or beyond a limit is one row of
    kind refused. Null and empty pages are bad XML. Stage the result where several views of it are asked.
    """
    leaf = pa.struct([("field", pa.string()), ("part", pa.int32()), ("text", pa.string()), ("attributes", pa.map_(pa.string(), pa.string()))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0)
            for k in range(batch.num_rows):  # a page may be tens of megabytes
                found = read_page(batch.column(1)[k].as_py(), limits)
                leaves = [[{"field": f, "part": p, "text": t, "attributes": list(a.items())} for f, p, t, a in own] for _, _, own, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array([k] * len(found))), pa.array([r[0] for r in found]), pa.array([r[1] for r in found], pa.int32()), pa.array(leaves, pa.list_(leaf)), pa.array([r[3] for r in found], pa.string())],
                    names=["key", "kind", "number", "leaves", "code"],
                )

    kind = pages.schema[key].dataType.simpleString()
    found = pages.select(F.col(key).alias("key"), F.col(xml).alias("xml")).mapInArrow(read, f"key {kind}, kind string, number int, leaves array<{LEAF}>, code string")
    return found.withColumnRenamed("key", key)


def instant(text: Column) -> Column:
    """An instant that says its offset, else null; digits beyond microseconds go."""
    sound = text.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?(Z|[+-]\d{2}:\d{2})$")
    return F.when(sound, F.try_to_timestamp(F.regexp_replace(text, r"(\.\d{6})\d+", "$1")))


def temporal(text: Column) -> Column:
    """precision (date or date_time) and value of an official date, as it is written, else null."""
    day = text.rlike(r"^\d{4}-\d{2}-\d{2}(Z|[+-]\d{2}:\d{2})?$") & F.substring(text, 1, 10).try_cast("date").isNotNull()
    kind = F.when(text.contains("T"), F.when(instant(text).isNotNull(), "date_time")).when(day, "date")
    return F.when(kind.isNotNull(), F.struct(kind.alias("precision"), text.alias("value")))


def _untrimmed(text: Column) -> Column:
    return (text == "") | text.rlike(r"(?U)^\s|\s$")


def single(nodes: Column) -> Column:
    """value and bad: the one text that all nodes have; several, empty ones and outer blanks contradict each other."""
    texts = F.array_distinct(F.transform(nodes, lambda n: n["text"]))
    value = F.get(texts, F.lit(0))
    bad = (F.size(texts) > 1) | F.coalesce(_untrimmed(value), F.lit(False))
    return F.struct(F.when(~bad, value).alias("value"), bad.alias("bad"))


def code_reference(nodes: Column) -> Column:
    """ref (value, list_uri, list_version) and code: invalid_code, structured_fields_inconsistent or null."""
    refs = F.array_distinct(F.transform(nodes, lambda n: F.struct(n["text"].alias("value"), n["attributes"]["listURI"].alias("list_uri"), n["attributes"]["listVersionID"].alias("list_version"))))
    long = lambda c: F.coalesce(F.char_length(c) > MOST_ATTRIBUTE, F.lit(False))
    invalid = F.exists(refs, lambda r: _untrimmed(r["value"]) | long(r["value"]) | long(r["list_uri"]) | long(r["list_version"]))
    code = F.when(invalid, "invalid_code").when(F.size(refs) > 1, "structured_fields_inconsistent")
    return F.struct(F.when(code.isNull(), F.get(refs, F.lit(0))).alias("ref"), code.alias("code"))


def entries(rows: DataFrame) -> DataFrame:
    """The entries of feed rows with their fields and ``codes``: what makes an entry unfit, sorted, empty for a sound one.

    Single values that contradict each other, codes and dates that are none, and missing identities are codes; sets are
    sorted. Fields of an entry with codes are as far as they could be read.
    """
    of = lambda name: F.filter("leaves", lambda n: n["field"] == name)
    party = lambda scheme: F.filter("leaves", lambda n: (n["field"] == "party") & (n["attributes"]["schemeName"] == scheme))
    got = rows.where("kind = 'entry'").withColumns({
        "_id": single(of("id")), "_updated": single(of("updated")), "_folder": single(of("folder")), "_platform": single(party("ID_PLATAFORMA")), "_dir3": single(party("DIR3")), "_deadline": single(of("deadline")),
        "_status": code_reference(of("status")), "_type": code_reference(of("contract_type")), "_procedure": code_reference(of("procedure")), "_cpv": of("cpv"), "_place": of("place"), "_titles": of("title"),
        "_groups": F.size(of("status_group")),
        "_notices": F.transform(_notice_parts(), lambda p: F.struct(
            code_reference(F.filter("leaves", lambda n: (n["field"] == "notice_type") & (n["part"] == p))).alias("type"), single(F.filter("leaves", lambda n: (n["field"] == "notice_date") & (n["part"] == p))).alias("date"),
        )),
    })
    title = F.get("_titles", F.lit(0))["text"]
    state = F.when(F.size("_titles") == 0, "absent").when(F.size("_titles") > 1, "multiple").when(title == "", "empty").when(title.rlike(r"(?U)^\s*$"), "blank").otherwise("present")
    bad = lambda *names: reduce_or([F.col(f"{n}.bad") for n in names])
    told = lambda c, code: F.when(F.coalesce(c, F.lit(False)), F.array(F.lit(code))).otherwise(F.array().cast("array<string>"))
    inconsistent, missing = "structured_fields_inconsistent", "identity_missing"
    wrong_date = lambda s: s["value"].isNotNull() & temporal(s["value"]).isNull()
    no_cpv = F.exists("_cpv", lambda n: ~n["text"].rlike(r"^\d{8}(-\d)?$"))
    no_place = F.exists("_place", lambda n: ~n["text"].rlike("^[A-Z]{2}[A-Z0-9]{0,3}$"))
    refs = F.array_compact(F.concat(F.array("_status.code", "_type.code", "_procedure.code"), F.transform("_notices", lambda x: x["type"]["code"])))
    outer = [told(bad("_id", "_updated"), inconsistent), told(F.col("_id.value").isNull() & ~F.col("_id.bad"), missing), told(instant(F.col("_updated.value")).isNull(), "invalid_updated")]
    inner = [
        told(bad("_folder", "_platform", "_dir3", "_deadline") | F.exists("_notices", lambda x: x["date"]["bad"]), inconsistent), told(F.col("_folder.value").isNull() & ~bad("_id", "_updated", "_folder"), missing),
        told(F.col("_platform.value").isNull() & F.col("_dir3.value").isNull() & ~bad("_id", "_updated", "_folder", "_platform", "_dir3"), missing), refs,
        told(no_cpv, "invalid_cpv_code"), told(no_place, "invalid_nuts_code"), told(wrong_date(F.col("_deadline")) | F.exists("_notices", lambda x: wrong_date(x["date"])), "invalid_administrative_date"),
    ]
    codes = F.array_sort(F.array_distinct(F.when(F.col("_groups") == 1, F.concat(*outer, *inner)).otherwise(F.concat(*outer, F.array(F.lit("entry_structure_unrecognized"))))))
    notices = F.transform("_notices", lambda x: F.struct(x["type"]["ref"].alias("notice_type"), temporal(x["date"]["value"]).alias("issue_date")))
    place = lambda n: F.struct(n["text"].alias("value"), n["attributes"]["listURI"].alias("list_uri"), n["attributes"]["listVersionID"].alias("list_version"))
    taken = {"kind", "leaves", "code", "number"}
    return got.select(
        *(c for c in rows.columns if c not in taken), "number", F.col("_id.value").alias("atom_id"), F.col("_updated.value").alias("updated_text"), instant(F.col("_updated.value")).alias("updated"),
        F.when(state.isin("blank", "present"), title).alias("title"), state.alias("title_state"), F.col("_folder.value").alias("folder_id"), F.col("_platform.value").alias("platform_id"), F.col("_dir3.value").alias("dir3"),
        F.col("_status.ref").alias("status"), F.col("_type.ref").alias("contract_type"), F.col("_procedure.ref").alias("procedure"), F.array_sort(F.array_distinct(F.transform("_cpv", lambda n: n["text"]))).alias("cpv_codes"),
        F.array_sort(F.array_distinct(F.transform("_place", place))).alias("places"), temporal(F.col("_deadline.value")).alias("deadline"),
        F.array_sort(F.array_distinct(F.filter(notices, lambda n: n["notice_type"].isNotNull() | n["issue_date"].isNotNull()))).alias("notices"), F.exists("leaves", lambda n: n["field"] == "lot").alias("has_lots"), codes.alias("codes"),
    )


def _notice_parts() -> Column:
    """The parts that notices of an entry are in."""
    return F.array_distinct(F.transform(F.filter("leaves", lambda n: n["field"].isin("notice_type", "notice_date")), lambda n: n["part"]))


def reduce_or(flags: list[Column]) -> Column:
    out = flags[0]
    for f in flags[1:]:
        out = out | f
    return out


def removals(rows: DataFrame) -> DataFrame:
    """Deleted entries of feed rows: ref, when_text, removed_at, kind (ANULADA, CERRADA or null) and code for those that
    say no entry or no instant."""
    leaf = lambda name: F.get(F.filter("leaves", lambda n: n["field"] == name), F.lit(0))["attributes"]
    got = rows.where("kind = 'deleted'").withColumns({"_d": leaf("deleted"), "_c": leaf("comment")["type"]})
    ref, when = F.col("_d")["ref"], F.col("_d")["when"]
    bad = F.coalesce(_untrimmed(ref), F.lit(True)) | instant(when).isNull()
    taken = {"kind", "leaves", "code", "number"}
    return got.select(
        *(c for c in rows.columns if c not in taken), ref.alias("ref"), when.alias("when_text"), instant(when).alias("removed_at"), F.when(F.col("_c").isin("ANULADA", "CERRADA"), F.col("_c")).alias("kind"),
        F.when(bad, "tombstones_discarded").when(F.col("_c").isNotNull() & ~F.col("_c").isin("ANULADA", "CERRADA"), "tombstone_kind_unknown").alias("code"),
    )
