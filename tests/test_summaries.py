"""Summary trees against a plain reader, over random trees with faults anywhere."""

import copy
import json
import random

from tidemark.plans.queries import QUERIES
from tidemark.sources import summaries

HOSTS = ("gazette.example.org",)
LINK = "https://gazette.example.org/a"
ITEM = {"identificador": "I", "titulo": "t", "url_xml": LINK, "url_html": LINK, "url_pdf": {"texto": LINK}}


class Bad(Exception):
    pass


def plain(said):
    """The items of a summary, or what is wrong first and where."""
    def node(v, path):
        if not isinstance(v, dict):
            raise Bad("not_object", path)
        return v

    def many(v, path, needed=False):
        v = [] if v is None else v if isinstance(v, list) else [v]
        if needed and not v:
            raise Bad("node_missing", path)
        return [(x, f"{path}[{i}]") for i, x in enumerate(v)]

    def text(v, name, path):
        if not isinstance(v.get(name), str) or not v[name]:
            raise Bad("text_missing", f"{path}.{name}")
        return v[name]

    def url(v, name, path):
        if not text(v, name, path).startswith("https://gazette.example.org/"):
            raise Bad("url_refused", f"{path}.{name}")

    out = []

    def items(v, path, above):
        for x, at in many(v.get("item"), f"{path}.item"):
            x = node(x, at)
            pdf = node(x.get("url_pdf"), f"{at}.url_pdf")
            url(x, "url_xml", at), url(x, "url_html", at), url(pdf, "texto", f"{at}.url_pdf")
            n = pdf.get("szBytes")
            if n is not None and not (type(n) is int and n >= 0 or isinstance(n, str) and n.isdigit()):
                raise Bad("number_invalid", f"{at}.url_pdf.szBytes")
            if x.get("control") is not None and not isinstance(x["control"], str):
                raise Bad("control_not_text", f"{at}.control")
            out.append((*above, text(x, "identificador", at), text(x, "titulo", at), None if n is None else int(n)))

    try:
        if said is None:
            raise Bad("absent", "")
        try:
            top = json.loads(said)
        except ValueError:
            raise Bad("json", "") from None
        top = node(top, "")
        if node(top.get("status"), "status").get("code") != "200":
            raise Bad("status", "status.code")
        summary = node(node(top.get("data"), "data").get("sumario"), "data.sumario")
        meta = node(summary.get("metadatos"), "data.sumario.metadatos")
        if meta.get("publicacion") != "GAZ":
            raise Bad("publication", "data.sumario.metadatos.publicacion")
        if meta.get("fecha_publicacion") != "20240229":
            raise Bad("date", "data.sumario.metadatos.fecha_publicacion")
        for d, dp in many(summary.get("diario"), "data.sumario.diario", True):
            text(node(d, dp), "numero", dp)
            for s, sp in many(d.get("seccion"), f"{dp}.seccion", True):
                code = text(node(s, sp), "codigo", sp)
                text(s, "nombre", sp)
                for p, pp in many(s.get("departamento"), f"{sp}.departamento", True):
                    department = text(node(p, pp), "codigo", pp)
                    text(p, "nombre", pp)
                    items(p, pp, (code, department, None))
                    for h, hp in many(p.get("epigrafe"), f"{pp}.epigrafe"):
                        items(node(h, hp), hp, (code, department, text(h, "nombre", hp)))
    except Bad as bad:
        return [(None, *[None] * 6, *bad.args)]
    return [(k, *row, None, None) for k, row in enumerate(out)]


def tree(rng):
    some = lambda make, least=1: rng.choice([lambda: make(), lambda: [make() for _ in range(rng.randint(least, 3))]])()
    link = "https://gazette.example.org/a"
    item = lambda: {"identificador": f"I{rng.randint(0, 99)}", "titulo": "t \"é\"", "url_xml": link, "url_html": link, "url_pdf": {"texto": link, "szBytes": rng.choice([5, "07", None])}, "control": rng.choice([None, "c"])}
    heading = lambda: {"nombre": "H", "item": some(item)}
    department = lambda: {"codigo": "D", "nombre": "N", **({"item": some(item)} if rng.random() < 0.6 else {}), **({"epigrafe": some(heading)} if rng.random() < 0.6 else {})}
    section = lambda: {"codigo": "S", "nombre": "N", "departamento": some(department)}
    return {"status": {"code": "200"}, "data": {"sumario": {"metadatos": {"publicacion": "GAZ", "fecha_publicacion": "20240229"}, "diario": some(lambda: {"numero": "1", "seccion": some(section)})}}}


def spoilt(rng, top):
    """One member somewhere is taken away or becomes something else."""
    places = []

    def walk(v):
        for k in v if isinstance(v, dict) else range(len(v)) if isinstance(v, list) else ():
            places.append((v, k))
            walk(v[k])

    walk(top)
    v, k = rng.choice(places)
    v[k] = rng.choice([None, 7, "", "x", [], {}, [None], True, 1.5, -3, "-1"])
    return top


def test_summaries_equal_plain_reader(spark):
    rng = random.Random(11)
    said = [None, "", "{", "[]", "7", "null", '{"status":{"code":200}}']
    for k in range(150):
        top = tree(rng)
        said.append(json.dumps(top if k % 3 == 0 else spoilt(rng, copy.deepcopy(top))))
    for change in ({"szBytes": -3}, {"szBytes": True}, {"szBytes": 1.5}, {"szBytes": "1e3"}, {"texto": "http://gazette.example.org/"}, {"texto": "https://a@gazette.example.org/"}):
        top = tree(random.Random(1))
        top["data"]["sumario"]["diario"] = {"numero": "1", "seccion": {"codigo": "S", "nombre": "N", "departamento": {"codigo": "D", "nombre": "N", "item": json.loads(json.dumps(ITEM | {"url_pdf": ITEM["url_pdf"] | change}))}}}
        said.append(json.dumps(top))
    top["data"]["sumario"]["diario"] = []
    said.append(json.dumps(top))
    df = spark.createDataFrame([(k, s, "clash", "kept") for k, s in enumerate(said)], "id int, json string, title string, own string")
    got = {}
    for r in summaries.summary_rows(df, "json", HOSTS, "GAZ").collect():
        assert r["own"] == "kept"
        got.setdefault(r["id"], []).append((r["position"], r["section"], r["department"], r["heading"], r["official_id"], r["title"], r["size_bytes"], r["code"], r["path"]))
    want = {k: w for k, s in enumerate(said) if (w := plain(s))}
    wrong = [(said[k], got.get(k), want.get(k)) for k in range(len(said)) if sorted(got.get(k, []), key=repr) != sorted(want.get(k, []), key=repr)]
    assert not wrong, wrong[:2]
    assert {c for rows in want.values() for *_, c, _ in rows} >= {"absent", "json", "not_object", "status", "node_missing", "text_missing", "url_refused", "number_invalid", None}


def test_days_are_written_where_their_lines_meet(spark):
    """Lines are dealt by day once; no level of a day's tree is shuffled again with the texts made so far."""
    plan = QUERIES["summary_trees"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("Join")]
    assert above.count("Exchange hashpartitioning(") == 1 and "ObjectHashAggregate" in above, above.count("Exchange hashpartitioning(")


def test_a_long_list_reads_as_a_short_one(spark):
    """Positions and the first fault of trees with a thousand departments, whose nodes are lists or single ones by turns."""
    item = lambda k: ITEM | {"identificador": f"I{k}"}
    department = lambda k: {"codigo": f"D{k}", "nombre": "N", "item": item(k) if k % 2 else [item(k), item(k)], "epigrafe": {"nombre": "H", "item": item(-k)}}

    def top(*changed):
        of = [department(k) for k in range(1000)]
        for k, member, value in changed:
            of[k]["epigrafe"]["item"][member] = value
        return {"status": {"code": "200"}, "data": {"sumario": {"metadatos": {"publicacion": "GAZ", "fecha_publicacion": "20240229"}, "diario": {"numero": "1", "seccion": {"codigo": "S", "nombre": "N", "departamento": of}}}}}

    said = [json.dumps(top()), json.dumps(top((998, "titulo", 7), (901, "url_html", "http://gazette.example.org/a")))]
    got = {0: [], 1: []}
    for r in summaries.summary_rows(spark.createDataFrame(list(enumerate(said)), "id int, json string"), "json", HOSTS, "GAZ").collect():
        got[r["id"]].append((r["position"], r["section"], r["department"], r["heading"], r["official_id"], r["title"], r["size_bytes"], r["code"], r["path"]))
    assert sorted(got[0]) == sorted(plain(said[0])) and len(got[0]) == 2500
    assert got[1] == plain(said[1]) and got[1][0][-2:] == ("url_refused", "data.sumario.diario[0].seccion[0].departamento[901].epigrafe[0].item[0].url_html")
