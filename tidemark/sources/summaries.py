"""Daily summaries as VARIANT trees: every text is parsed once, nodes may be one object or a list of them.

A tree that breaks the contract gives one row with the first thing that is wrong and where it stands, in the order of the
document; no item of such a tree is passed on. All checks are expressions over the row, so nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ITEM = (
    "number string, section string, section_name string, department string, department_name string, heading string, official_id string, title string, control string, "
    "url_xml string, url_html string, url_pdf string, size_bytes bigint, size_kbytes bigint, first_page bigint, last_page bigint"
)
_NAMES = [c.split()[0] for c in ITEM.split(", ")]
_TYPES = [c.split()[1] for c in ITEM.split(", ")]


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def opened(tree: Column) -> Column:
    """All members by name, each still a variant; null where a node is no object."""
    return F.try_variant_get(tree, "$", "map<string,variant>")


def _object(*members: str) -> str:
    """The type of an object of which some members are read, each still a variant."""
    return f"struct<{', '.join(f'{m}: variant' for m in members)}>"


def nodes(member: Column, kind: str) -> Column:
    """The elements of a list, or what is no list alone, each read as an object of this type (null where it is none);
    what is absent or a JSON null has none. All elements come out of one pass over the member."""
    alone = F.when(member.isNotNull() & ~F.is_variant_null(member), F.array(F.try_variant_get(member, "$", kind)))
    return F.coalesce(F.try_variant_get(member, "$", f"array<{kind}>"), alone, F.array().cast(f"array<{kind}>"))


def text(value: Column) -> Column:
    """A variant that is a text; numbers are no texts."""
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))


def count(value: Column) -> Column:
    """A whole number that isn't negative, also as digits in a text; -1 for anything else but a null."""
    kind, said = F.schema_of_variant(value), F.try_variant_get(value, "$", "string")
    digits = F.when(kind.rlike(r"^(STRING|DECIMAL\(\d+,0\))$") & said.rlike("^[0-9]+$"), said.try_cast("bigint"))
    number = F.when(kind == "BIGINT", F.greatest(F.try_variant_get(value, "$", "bigint"), F.lit(-1))).otherwise(F.coalesce(digits, F.lit(-1)))
    return F.when(value.isNotNull() & ~F.is_variant_null(value), number)


def official_url(url: Column, hosts: tuple[str, ...]) -> Column:
    """Whether a URL is https, of one of the hosts, without credentials or a port of its own."""
    names = "|".join(h.replace(".", r"\.") for h in hosts)
    return F.coalesce(url.rlike(rf"^(?i:https://(?:{names}))\.?(?::(?:0*443)?)?(?:[/?#]|$)"), F.lit(False))


#: An entry is an item, or has what is wrong instead.
_FAULT = "struct<code: string, path: string>"
_ENTRY = f"struct<item: struct<{ITEM}>, fault: {_FAULT}>"


def _issue(fault: Column) -> Column:
    """An entry that is no item."""
    return F.struct(F.lit(None).cast(f"struct<{ITEM}>").alias("item"), fault.alias("fault"))


def _told(code: str, path: Column) -> Column:
    return F.struct(F.lit(code).alias("code"), path.alias("path"))


def _first(*wrong: tuple[Column, str, Column]) -> Column:
    """The first (is wrong, code, path) that holds, unknown counting as wrong; else null."""
    return F.coalesce(*(F.when(F.coalesce(bad, F.lit(True)), _told(code, path)) for bad, code, path in wrong))


def _at(path: Column, name: str) -> Column:
    return F.concat(path, F.lit(f".{name}"))


def _place(path: Column, name: str, i: Column) -> Column:
    return F.concat(path, F.lit(f".{name}["), i.cast("string"), F.lit("]"))


def _checked(wrong: list[tuple[Column, str, Column]], found: Column) -> Column:
    """The entries found, or what is wrong alone. What is wrong is worked out again only where there is something: entries
    are not bound to a name on the way, as that copies all of them."""
    fault = _first(*wrong)
    return F.when(fault.isNull(), found).otherwise(F.array(_issue(fault)))


def _empty(said: Column) -> Column:
    return said.isNull() | (said == "")


def _missing(node: Column, path: Column, *names: str) -> list[tuple[Column, str, Column]]:
    return [(_empty(node[n]), "text_missing", _at(path, n)) for n in names]


def _each(node: Column, path: Column, name: str, texts: tuple[str, ...], lists: tuple[str, ...], read: Callable[[Column, Column], Column], needed: bool = False) -> Column:
    """What ``read`` gives for every element of a member, one after another; elements that are no objects are issues. An
    element is handed on with its texts read once and its lists as they are."""
    element = lambda x, i: F.when(x.isNull(), F.array(_issue(_told("not_object", _place(path, name, i))))).otherwise(read(x, _place(path, name, i)))
    found = F.transform(nodes(node[name], _object(*texts, *lists)), lambda x: F.when(x.isNotNull(), F.struct(*(text(x[t]).alias(t) for t in texts), *(x[n].alias(n) for n in lists))))
    every = F.flatten(F.transform(found, element))
    if not needed:
        return every
    none = F.size(nodes(node[name], _object("none"))) == 0  # a pass that reads no member
    return F.when(none, F.array(_issue(_told("node_missing", _at(path, name))))).otherwise(every)


_URLS = {"url_xml": ("", "url_xml"), "url_html": ("", "url_html"), "url_pdf": (".url_pdf", "texto")}
_NUMBERS = {"size_bytes": "szBytes", "size_kbytes": "szKBytes", "first_page": "pagina_inicial", "last_page": "pagina_final"}
_PDF = _object("texto", *_NUMBERS.values())
_LEAF = f"struct<identificador: variant, titulo: variant, control: variant, url_xml: variant, url_html: variant, url_pdf: {_PDF}>"


def _items(node: Column, path: Column, above: dict[str, Column], hosts: tuple[str, ...]) -> Column:
    """The items of a node: each is taken apart once, then judged by what was found."""

    def parts(x: Column) -> Column:
        pdf = x["url_pdf"]
        return F.struct(
            x.isNotNull().alias("is_item"), pdf.isNotNull().alias("has_pdf"), text(x["identificador"]).alias("official_id"), text(x["titulo"]).alias("title"),
            *(text((pdf if inner else x)[name]).alias(out) for out, (inner, name) in _URLS.items()), *(count(pdf[name]).alias(out) for out, name in _NUMBERS.items()),
            (x["control"].isNull() | F.is_variant_null(x["control"])).alias("uncontrolled"), text(x["control"]).alias("control"),
        )

    def read(x: Column, i: Column) -> Column:
        at = _place(path, "item", i)
        pdf = _at(at, "url_pdf")
        wrong = [(~x["is_item"], "not_object", at), (~x["has_pdf"], "not_object", pdf)]
        for out, (inner, name) in _URLS.items():
            place = _at(pdf if inner else at, name)
            wrong += [(_empty(x[out]), "text_missing", place), (~official_url(x[out], hosts), "url_refused", place)]
        wrong += [(F.coalesce(x[out] < 0, F.lit(False)), "number_invalid", _at(pdf, name)) for out, name in _NUMBERS.items()]
        wrong += [(~x["uncontrolled"] & x["control"].isNull(), "control_not_text", _at(at, "control"))]
        wrong += [(_empty(x[out]), "text_missing", _at(at, name)) for out, name in (("official_id", "identificador"), ("title", "titulo"))]
        known = above | {n: x[n] for n in ("official_id", "title", "control", *_URLS, *_NUMBERS)}
        item = F.struct(*(known.get(n, F.lit(None)).cast(t).alias(n) for n, t in zip(_NAMES, _TYPES)))
        return F.struct(item.alias("item"), _first(*wrong).alias("fault"))

    return F.transform(F.transform(nodes(node["item"], _LEAF), parts), read)


def summary_rows(df: DataFrame, json: str, hosts: tuple[str, ...], publication: str) -> DataFrame:
    """The items of every summary in the order of the document, with the columns of ``df`` but ``json``, published_on,
    position (from 0) and the fields of ITEM; a bad tree is one row with code and path and without a position.

    Departments hold items directly or under headings, which come after the direct ones. Codes: absent, json, not_object,
    status, publication, date, node_missing, text_missing, url_refused, number_invalid, control_not_text. Columns of ``df``
    that have a name of the result are left out. A tree is one row until its items are: Spark parses up to 128 MB of it.
    """
    taken = {*_NAMES, "published_on", "position", "code", "path"}
    kept = [c for c in df.columns if c != json and c not in taken]
    parsed = df.select(F.struct(*kept).alias("row") if kept else F.struct(F.lit(1)).alias("row"), F.col(json).isNotNull().alias("given"), F.try_parse_json(json).alias("tree"))
    root, tree = F.lit("data.sumario"), F.col("tree")

    def heading(above: dict[str, Column]) -> Callable[[Column, Column], Column]:
        return lambda x, path: _checked(_missing(x, path, "nombre"), _items(x, path, above | {"heading": x["nombre"]}, hosts))

    def department(above: dict[str, Column]) -> Callable[[Column, Column], Column]:
        def read(x: Column, path: Column) -> Column:
            own = above | {"department": x["codigo"], "department_name": x["nombre"]}
            return _checked(_missing(x, path, "codigo", "nombre"), F.concat(_items(x, path, own, hosts), _each(x, path, "epigrafe", ("nombre",), ("item",), heading(own))))

        return read

    def section(above: dict[str, Column]) -> Callable[[Column, Column], Column]:
        def read(x: Column, path: Column) -> Column:
            own = above | {"section": x["codigo"], "section_name": x["nombre"]}
            return _checked(_missing(x, path, "codigo", "nombre"), _each(x, path, "departamento", ("codigo", "nombre"), ("item", "epigrafe"), department(own), True))

        return read

    def diary(x: Column, path: Column) -> Column:
        return _checked(_missing(x, path, "numero"), _each(x, path, "seccion", ("codigo", "nombre"), ("departamento",), section({"number": x["numero"]}), True))

    is_object = lambda path: F.try_variant_get(tree, path, _object("code")).isNotNull()
    said = lambda path: text(F.try_variant_get(tree, path, "variant"))
    told = said("$.data.sumario.metadatos.fecha_publicacion")
    day = F.when(told.rlike("^[0-9]{8}$"), F.concat_ws("-", F.substring(told, 1, 4), F.substring(told, 5, 2), F.substring(told, 7, 2)).try_cast("date"))
    wrong = [
        (~F.col("given"), "absent", F.lit("")), (tree.isNull(), "json", F.lit("")), (~is_object("$"), "not_object", F.lit("")), (~is_object("$.status"), "not_object", F.lit("status")),
        (said("$.status.code") != "200", "status", F.lit("status.code")), (~is_object("$.data"), "not_object", F.lit("data")),
        (~is_object("$.data.sumario"), "not_object", root), (~is_object("$.data.sumario.metadatos"), "not_object", _at(root, "metadatos")),
        (said("$.data.sumario.metadatos.publicacion") != publication, "publication", F.lit("data.sumario.metadatos.publicacion")),
        (day.isNull(), "date", F.lit("data.sumario.metadatos.fecha_publicacion")),
    ]
    summary = F.try_variant_get(tree, "$.data.sumario", _object("diario"))
    tops = parsed.select("row", day.alias("published_on"), _first(*wrong).alias("fault"), summary.alias("summary"))
    inner = _each(F.col("summary"), root, "diario", ("numero",), ("seccion",), diary, True)
    entries = F.when(F.col("fault").isNull(), inner).otherwise(F.array(_issue(F.col("fault")))).cast(f"array<{_ENTRY}>")
    found = tops.select("row", "published_on", entries.alias("entries")).select("*", F.filter("entries", lambda e: e["fault"].isNotNull()).alias("bad"))
    read = found.select("row", "published_on", F.posexplode(F.when(F.size("bad") == 0, F.col("entries")).otherwise(F.slice("bad", 1, 1))).alias("position", "e"))
    fine = F.col("e.fault").isNull()
    fields = [F.when(fine, F.col("e.item")[n]).alias(n) for n in _NAMES]
    return read.select(*(F.col("row")[c].alias(c) for c in kept), "published_on", F.when(fine, F.col("position")).alias("position"), *fields, F.col("e.fault.code").alias("code"), F.col("e.fault.path").alias("path"))


def rendered(parts: list[tuple[str, Column]]) -> Column:
    """A JSON object of members that are JSON texts already; null ones are left out."""
    said = [F.when(v.isNotNull(), F.concat(F.lit(f'"{k}":'), v)) for k, v in parts]
    return F.concat(F.lit("{"), F.concat_ws(",", *said), F.lit("}"))
