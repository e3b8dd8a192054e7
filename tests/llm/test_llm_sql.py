"""Queries that SQL can express, against DuckDB."""

import duckdb
import pytest

from ferryline.llm import suite

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = suite.queries(), suite.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    cursor = con.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    want = sorted(tuple(row[i] for i in order) for row in cursor.fetchall())
    assert sorted(tuple(r[c] for c in columns) for r in df.collect()) == want
    assert want
