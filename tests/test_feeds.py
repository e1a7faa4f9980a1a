"""Feed pages: entries with contradictions, limits and refusals, by hand-made pages."""

from tidemark.sources import feeds

HEAD = (
    '<feed xmlns="http://www.w3.org/2005/Atom" xmlns:at="http://purl.org/atompub/tombstones/1.0" xmlns:b="urn:dgpe:names:draft:codice:schema:xsd:CommonBasicComponents-2" '
    'xmlns:a="urn:dgpe:names:draft:codice:schema:xsd:CommonAggregateComponents-2" xmlns:e="urn:dgpe:names:draft:codice-place-ext:schema:xsd:CommonAggregateComponents-2" '
    'xmlns:x="urn:dgpe:names:draft:codice-place-ext:schema:xsd:CommonBasicComponents-2">'
)
PARTY = '<e:LocatedContractingParty><a:Party><a:PartyIdentification><b:ID schemeName="ID_PLATAFORMA">99</b:ID></a:PartyIdentification><a:PartyIdentification><b:ID schemeName="NIF">secret</b:ID></a:PartyIdentification></a:Party></e:LocatedContractingParty>'


def page(*entries, root=HEAD, extra=""):
    return f"<?xml version='1.0' encoding='UTF-8'?>{root}<id>f</id>{extra}{''.join(entries)}</feed>"


def entry(id_="<id>u:1</id>", updated="<updated>2024-03-01T10:00:00.1234567+02:00</updated>", title="<title> A  é </title>", folder="<b:ContractFolderID>F/1</b:ContractFolderID>", party=PARTY, more="", groups=1):
    status = f"<e:ContractFolderStatus>{folder}{party}{more}</e:ContractFolderStatus>"
    return f"<entry>{id_}{updated}{title}{status * groups}<summary>left out</summary></entry>"


def codes(spark, *made):
    df = spark.createDataFrame([(1, page(*made))], "page int, xml string")
    return [r["codes"] for r in feeds.entries(feeds.feed_rows(df, "page", "xml")).orderBy("number").collect()]


def test_entry_fields(spark):
    project = "<a:ProcurementProject><b:TypeCode listURI='u'>2</b:TypeCode><a:RequiredCommodityClassification><b:ItemClassificationCode>45000000-7</b:ItemClassificationCode><b:ItemClassificationCode>12345678</b:ItemClassificationCode></a:RequiredCommodityClassification><a:RealizedLocation><b:CountrySubentityCode>ES522</b:CountrySubentityCode></a:RealizedLocation></a:ProcurementProject>"
    process = "<a:TenderingProcess><a:TenderSubmissionDeadlinePeriod><b:EndDate>2024-02-29</b:EndDate></a:TenderSubmissionDeadlinePeriod></a:TenderingProcess>"
    notice = lambda t, d: f"<e:ValidNoticeInfo><x:NoticeTypeCode>{t}</x:NoticeTypeCode><x:NoticeIssueDate>{d}</x:NoticeIssueDate></e:ValidNoticeInfo>"
    text = page(entry(more="<x:ContractFolderStatusCode>PUB</x:ContractFolderStatusCode>" + project + process + notice("B", "2024-01-02") + notice("A", "2024-01-01T00:00:00Z") + notice("A", "2024-01-01T00:00:00Z") + "<a:ProcurementProjectLot><b:ID>1</b:ID></a:ProcurementProjectLot>"), extra='<at:deleted-entry ref="u:0" when="2024-01-01T00:00:00Z"><at:comment type="ANULADA"/></at:deleted-entry><at:deleted-entry ref="" when="x"/>')
    rows = feeds.feed_rows(spark.createDataFrame([(7, text)], "page int, xml string"), "page", "xml")
    got = feeds.entries(rows).collect()[0].asDict(True)
    assert got["codes"] == [] and got["page"] == 7 and got["atom_id"] == "u:1" and got["title"] == " A  é " and got["title_state"] == "present" and got["has_lots"]
    assert got["updated"].isoformat().startswith("2024-03-01T") and got["platform_id"] == "99" and got["dir3"] is None and got["folder_id"] == "F/1"
    assert got["status"] == {"value": "PUB", "list_uri": None, "list_version": None} and got["contract_type"]["list_uri"] == "u" and got["procedure"] is None
    assert got["cpv_codes"] == ["12345678", "45000000-7"] and [p["value"] for p in got["places"]] == ["ES522"] and got["deadline"] == {"precision": "date", "value": "2024-02-29"}
    assert [(n["notice_type"]["value"], n["issue_date"]["precision"]) for n in got["notices"]] == [("A", "date_time"), ("B", "date")]
    assert [(r["ref"], r["kind"], r["code"]) for r in feeds.removals(rows).collect()] == [("u:0", "ANULADA", None), ("", None, "tombstones_discarded")]
    assert "secret" not in str(rows.collect())


def test_entries_that_contradict_themselves(spark):
    twice = "<b:ContractFolderID>F/1</b:ContractFolderID><b:ContractFolderID>F/2</b:ContractFolderID>"
    same = "<b:ContractFolderID>F/1</b:ContractFolderID>" * 2
    ref = lambda v: f"<x:ContractFolderStatusCode>{v}</x:ContractFolderStatusCode>"
    got = codes(
        spark, entry(folder=twice), entry(folder=same), entry(id_=""), entry(id_="<id> u</id>"), entry(updated="<updated>2024-03-01T10:00:00</updated>"), entry(party=""), entry(folder=""), entry(groups=0), entry(groups=2),
        entry(more=ref("")), entry(more=ref("a") + ref("b")), entry(more="<a:TenderingProcess><a:TenderSubmissionDeadlinePeriod><b:EndDate>2024-13-01</b:EndDate></a:TenderSubmissionDeadlinePeriod></a:TenderingProcess>"),
        entry(updated="", id_="", folder="", party=""),
    )
    unclear, missing = "structured_fields_inconsistent", "identity_missing"
    assert got == [[unclear], [], [missing], [unclear], ["invalid_updated"], [missing], [missing], ["entry_structure_unrecognized"], ["entry_structure_unrecognized"], ["invalid_code"], [unclear], ["invalid_administrative_date"], [missing, "invalid_updated"]]


def test_titles(spark):
    df = spark.createDataFrame([(1, page(*(entry(title=t) for t in ("", "<title/>", "<title>  </title>", "<title>a</title><title>a</title>", "<title>a<b>x</b>c</title>"))))], "page int, xml string")
    got = feeds.entries(feeds.feed_rows(df, "page", "xml")).orderBy("number").collect()
    assert [(r["title"], r["title_state"]) for r in got] == [(None, "absent"), (None, "empty"), ("  ", "blank"), (None, "multiple"), ("ac", "present")]


def test_pages_that_are_refused(spark):
    deep = "<z>" * 9 + "</z>" * 9
    made = {
        "xml_security_rejection": "<!DOCTYPE feed [<!ENTITY x 'y'>]>" + page(root=HEAD)[38:], "invalid_xml": page(entry())[:-9], "invalid_atom_root": "<rss/>", "xml_encoding_unsupported": page().replace("UTF-8", "ISO-8859-1"),
        "pagination_ambiguous": page(extra='<link rel="next" href="a"/><link rel="next" href="b"/>'),
    }
    df = spark.createDataFrame([*((k, v) for k, v in made.items()), ("null", None), ("deep", page(deep)), ("long", page(entry(title=f"<title>{' ' * 301}</title>"))), ("other", page(f"<z>{'y' * 301}</z>")), ("blank", page(f"<z>{' ' * 301}</z>")), ("many", page(*[entry()] * 4))], "page string, xml string")
    got = {r["page"]: (r["kind"], r["code"]) for r in feeds.feed_rows(df, "page", "xml", feeds.Limits(depth=8, text=300, entries=3)).where("kind in ('refused', 'feed')").collect()}
    assert {k: got[k] for k in made} == {k: ("refused", k) for k in made}
    assert {k: got[k][1] for k in ("null", "deep", "long", "other", "many", "blank")} == {"null": "invalid_xml", "deep": "limits_exceeded", "long": "limits_exceeded", "other": "limits_exceeded", "many": "limits_exceeded", "blank": None}
    assert feeds.feed_rows(df.where("false"), "page", "xml").count() == 0


def test_events_without_a_value_still_have_a_title(spark, tmp_path):
    from pyspark.sql import functions as F

    from tidemark.plans.queries import QUERIES

    made = spark.range(50).select(F.col("id").alias("event_id"), F.current_timestamp().alias("ts"), F.col("id").alias("user_id"), F.lit("view").alias("event_type"), F.when(F.col("id") % 2 == 0, 0.0).otherwise(7.5).alias("value"), F.lit('{"k": 9}').alias("props"))
    made.write.parquet(f"{tmp_path}/events.parquet")
    assert [(r["title_state"], r["codes"]) for r in QUERIES["feed_entries"](spark, str(tmp_path)).collect()] == [("present", "")] * 50
