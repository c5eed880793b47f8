"""Every query with SQL against DuckDB on the smallest tables; the others must run."""

import os

import duckdb
import pytest

from ledgerloom.plans import catalogue, problems

QUERIES = problems.QUERIES | catalogue.QUERIES
SQL = problems.SQL | catalogue.SQL


@pytest.fixture(scope="module")
def con(data):
    c = duckdb.connect()
    for name in os.listdir(data):
        c.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{data}/{name}'")
    return c


def plain(v):
    if v is None or (isinstance(v, float) and v != v):
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)):
        return repr(round(float(v), 6) + 0.0)
    return str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, con, name):
    df = QUERIES[name](spark, data)
    got = sorted(tuple(plain(v) for v in r) for r in df.select(*sorted(df.columns)).collect())
    if name in SQL:
        cur = con.execute(SQL[name])
        names = [x[0] for x in cur.description]
        assert sorted(names) == sorted(df.columns)
        order = [names.index(c) for c in sorted(names)]
        assert got == sorted(tuple(plain(r[i]) for i in order) for r in cur.fetchall())
