"""Every text query with SQL gives DuckDB's rows on the small tables."""

import duckdb
import pytest

from starloom.llm.queries import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_rows_match(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "conversations"):
        con.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    df = QUERIES[name](spark, SF_DIR)
    rel = con.sql(SQL[name])
    assert sorted(df.columns) == sorted(rel.columns)
    want = rel.project(", ".join(df.columns)).fetchall()
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(want, key=repr)
