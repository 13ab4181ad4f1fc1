"""The queries that SQL can express, beside their SQL, on the smallest tables."""

import duckdb
import pytest

from searchloom.llm import queries as Q

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", Q.ORACLES)
def test_query_and_sql_agree(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        con.execute(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    theirs = con.execute(Q.ORACLES[name])
    columns = [c[0] for c in theirs.description]
    found = Q.QUERIES[name](spark, SMALL)
    assert sorted(found.columns) == sorted(columns)
    key = lambda row: tuple(map(str, row))
    assert sorted(map(tuple, found.select(columns).collect()), key=key) == sorted(theirs.fetchall(), key=key)
