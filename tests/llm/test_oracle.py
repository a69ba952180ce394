"""The text operators' queries that have SQL, against DuckDB on the same tables."""

import os

import pytest

duckdb = pytest.importorskip("duckdb")
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.mark.parametrize("name", ["p4_found", "p7_kept", "p9_rebuilt"])
def test_query_equals_sql(spark, name):
    from ledgerloom.llm import queries

    c = duckdb.connect()
    for f in os.listdir(SF):
        if f.endswith(".parquet"):
            c.execute(f"create view {f[:-8]} as select * from '{SF}/{f}'")
    df = queries.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(map(tuple, df.select(*cols).collect()))
    cur = c.execute(f"select {', '.join(cols)} from ({queries.oracle_sql()[name]})")
    want = sorted(cur.fetchall())
    assert got == want and got
