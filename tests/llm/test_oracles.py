"""Queries that SQL can express give DuckDB's rows."""

import duckdb
import pytest

from tapeloom.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_same_rows(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    df = queries.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    sql = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in sql.description]
    assert sorted(names) == columns
    want = sorted((tuple(r[names.index(c)] for c in columns) for r in sql.fetchall()), key=str)
    assert sorted((tuple(r) for r in df.select(*columns).collect()), key=str) == want
