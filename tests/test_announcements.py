"""Pairing of download links with the titles beside them, over hand-made pages."""

from tidemark.sources import announcements

HOSTS, BASE = ("b.example",), "https://b.example/x/"
TITLE = "<span class='t title4'> A <b>b</b>\n c </span>"


def down(n=1, href=None):
    return f"<span class='z download'><i><a href='{href or f'get?id={n}&v=1'}'>pdf</a></i></span>"


def box(*parts):
    return f"<div id='announcements'>{''.join(parts)}</div>"


def told(spark, *pages):
    df = spark.createDataFrame(list(enumerate(pages)), "page int, html string")
    out = {}
    for r in announcements.announcement_rows(announcements.page_parts(df, "page", "html"), HOSTS, BASE).collect():
        out.setdefault(r["page"], []).append((r["code"], r["at"]) if r["code"] else (r["position"], r["id"], r["title"], r["url"], r["heading_path"]))
    return [sorted(out[k]) for k in range(len(pages))]


def test_pairs(spark):
    heads = "<h2 class='accordion-header'>One</h2><div><p class='title2'> Two  x</p>" + down(5) + "<br/><script>a<b</script>" + TITLE + "<p class='title1'>Three</p>" + down(6) + TITLE + "</div>" + down(7) + TITLE
    url = lambda n: f"https://b.example/x/get?id={n}&v=1"
    assert told(spark, box(heads), box(down(1) + TITLE)) == [
        [(0, "5", "A b c", url(5), ["One", "Two x"]), (1, "6", "A b c", url(6), ["Three"]), (2, "7", "A b c", url(7), ["One"])], [(0, "1", "A b c", url(1), [])]
    ]


def test_pages_that_pair_badly(spark):
    cases = {
        ("container_invalid", None): [None, "", box(down() + TITLE) * 2, down() + TITLE], ("empty", None): [box(down())], ("structure_invalid", None): [box(TITLE)],
        ("link_cardinality", 0): [box("<span class='download'></span>" + TITLE), box("<span class='download'><a href='?id=1'></a><a href='?id=2'></a></span>" + TITLE)],
        ("no_title_after_download", 1): [box(down(1) + TITLE + down(2)), box(down(1) + TITLE + down(2) + "<b></b>" + TITLE), box(down(1) + TITLE + "<p>" + down(2) + "</p>" + TITLE)],
        ("url_invalid", 0): [box(down(href="http://b.example/?id=1") + TITLE), box(down(href="https://c.example/?id=1") + TITLE)], ("id_missing", 0): [box(down(href="?id=x") + TITLE), box(down(href="?id=1&id=2") + TITLE)],
        ("duplicate_id", 1): [box(down(1) + TITLE + down(1) + TITLE)], ("title_empty", 0): [box(down(1) + "<span class='title4'> </span>")],
        ("unpaired_elements", None): [box(down(1) + TITLE + TITLE), box(down(1) + TITLE + "<a href='?id=3'>y</a>")],
    }
    pages = [p for group in cases.values() for p in group]
    assert told(spark, *pages) == [[k] for k, group in cases.items() for _ in group]
    df = spark.createDataFrame([(1, box(TITLE))], "page int, html string")
    counts = announcements.announcement_rows(announcements.page_parts(df, "page", "html"), HOSTS, BASE).first()["counts"]
    assert counts.asDict() == {"containers": 1, "titles": 1, "links": 0, "blocks": 0}


def test_plain_pages_are_read_as_the_parser_reads_them():
    import random

    layout, rng, plain = announcements.Layout(), random.Random(7), 0
    parts = [
        "<div>", "</div>", "<DIV id='announcements'>", "<span class='download'>", "</span>", "<span class=\"t title4\">", "<a href='x?id=1'>", "<a href='x?id=1&amp;v=2'>", "</a>", "<br>", "<br/>", "<i />", "<p class='title1'>", "</p >",
        " A &amp; b", "&lt;p", "&copy", "x\n y", "<script>", "<script>a&amp;</script>", "</script>", "<!-- <b> -->", "<style>", "<a href=x?id=2>", "<b title='1 > 0'>", "a < b", "<", "<title>", "</b/>", "<é>", "&#65;", "<script/>",
    ]
    for _ in range(4000):
        usual = rng.random() < 0.7
        page = "".join(rng.choice(parts[:18] if usual else parts) for _ in range(rng.randrange(1, 25)))
        page = box(page) if rng.random() < 0.5 else page
        slow = announcements._Reader(layout)
        slow.feed(page)
        slow.close()
        told = lambda r: (r.containers, r.titles, r.links, r.blocks)
        assert told(announcements.read_page(page, layout)) == told(slow), page
        plain += announcements._read_plain(announcements._Reader(layout), page)
    assert plain > 1000
