"""Every query with SQL against DuckDB on the same tables."""

import decimal
import os

import pytest

duckdb = pytest.importorskip("duckdb")
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def catalog():
    from ledgerloom.plans import catalog

    return catalog


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for f in os.listdir(SF):
        if f.endswith(".parquet"):
            c.execute(f"create view {f[:-8]} as select * from '{SF}/{f}'")
    return c


def plain(v):
    return format(v.normalize(), "f") if isinstance(v, decimal.Decimal) else repr(v)


@pytest.mark.parametrize("name", sorted(catalog().oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = catalog().queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(map(plain, r)) for r in df.select(*cols).collect())
    cur = duck.execute(catalog().oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    order = [names.index(c) for c in cols]
    want = sorted(tuple(plain(r[i]) for i in order) for r in cur.fetchall())
    assert got == want


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
