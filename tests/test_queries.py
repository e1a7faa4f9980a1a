import pytest

from tidemark.plans.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(name, spark, sf_dir, same):
    same(QUERIES[name](spark, sf_dir), SQL[name])


def test_html_flatten(spark, sf_dir):
    found = QUERIES["html_flatten"](spark, sf_dir)
    assert found.columns == ["page_id", "position", "title", "url", "heading_path"]
    assert found.count() > 0


def test_search_excerpt(spark, sf_dir):
    found = QUERIES["search_excerpt"](spark, sf_dir).collect()
    assert all("icense" in r["excerpt"] and len(r["excerpt"]) <= 242 for r in found)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_no_other_part_imports_the_corpus_operators():
    import pathlib

    for path in pathlib.Path(__file__).parent.parent.glob("tidemark/**/*.py"):
        if "llm" not in path.parts:
            assert ".llm" not in path.read_text() and "from . import llm" not in path.read_text()
