"""Every query with SQL against DuckDB, on the smallest tables."""

import os

import duckdb
import pytest

from aerolayer.plans.queries import QUERIES, SQL

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return c


def shown(v):
    return repr(v + 0.0) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    got = sorted(tuple(map(shown, r)) for r in df.select(*[f"`{c}`" for c in cols]).collect())
    rel = duck.sql(SQL[name])
    assert sorted(rel.columns) == cols
    at = [rel.columns.index(c) for c in cols]
    types = {c: TYPES[t] for c, t in df.dtypes}
    assert {c: str(t) for c, t in zip(rel.columns, rel.types, strict=True)} == types
    assert got == sorted(tuple(shown(r[i]) for i in at) for r in rel.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_without_sql(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0
