"""Every registered query against its SQL on the smallest tables."""

import math
import sys

import duckdb
import pytest

from tidegauge.plans.catalog import QUERIES
from tidegauge.plans.oracles import ORACLES

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
KINDS = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return con


def cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return repr(v)


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
    sys.path.insert(0, ".")
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DIR)
    rows = df.collect()
    if name not in ORACLES:
        assert df.columns
        return
    rel = duck.execute(ORACLES[name])
    kinds = {c[0]: str(c[1]) for c in rel.description}
    names = [c[0] for c in rel.description]
    expected = rel.fetchall()
    assert {c: KINDS.get(t, t) for c, t in df.dtypes} == kinds
    order = sorted(df.columns)
    got = sorted(tuple(cell(r[c]) for c in order) for r in rows)
    want = sorted(tuple(cell(r[names.index(c)]) for c in order) for r in expected)
    assert got == want
