"""Every registered query with SQL gives DuckDB's rows on the small tables."""

from decimal import Decimal

import duckdb
import pytest

from starloom.jobs.registry import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    return c


def plain(v):
    return float(v) if isinstance(v, Decimal) else v


@pytest.mark.parametrize("name", sorted(SQL))
def test_rows_match(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    cols = sorted(df.columns)
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
    rel = con.sql(SQL[name])
    at = [rel.columns.index(c) for c in cols]
    assert len(rel.columns) == len(cols)
    want = sorted((tuple(plain(r[i]) for i in at) for r in rel.fetchall()), key=repr)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_others_run(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0
