import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [p for p in [ROOT] if p not in sys.path]
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, [os.environ.get("PYTHONPATH")])])


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    work = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").config("spark.local.dir", work)
        .config("spark.sql.warehouse.dir", f"{work}/warehouse").config("spark.checkpoint.dir", f"file://{work}/shared").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


def rows(df):
    """Rows as tuples in an order that no run changes."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="session")
def sql():
    """Runs SQL over the smallest tables and gives names and rows."""
    import duckdb

    con = duckdb.connect()
    for name in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '/root/testdata/sf0.001/{name}.parquet'")

    def run(text):
        found = con.sql(text)
        return found.columns, found.fetchall()

    return run


@pytest.fixture(scope="session")
def same(sql):
    """Whether a query's rows equal those of its SQL, columns by name, floats to nine digits."""

    def plain(v):
        if isinstance(v, bool) or v is None:
            return str(v)
        if isinstance(v, float):
            return f"{v:.9g}"
        return v.replace(tzinfo=None).isoformat() if hasattr(v, "hour") else str(v)

    def check(df, text):
        names, found = sql(text)
        assert sorted(names) == sorted(df.columns)
        order = sorted(names)
        want = sorted([plain(r[names.index(c)]) for c in order] for r in found)
        got = sorted([plain(r[c]) for c in order] for r in df.collect())
        assert got == want

    return check
