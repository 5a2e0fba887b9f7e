"""Every query with SQL gives DuckDB's rows: same names, same values, order aside."""

import math

import duckdb
import pytest

from tapeloom.plans import queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def key(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_same_rows(spark, con, sf_dir, name):
    df = queries.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted(tuple(key(v) for v in r) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    sql = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in sql.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    want = sorted(tuple(key(r[i]) for i in order) for r in sql.fetchall())
    assert got == want
    assert got
