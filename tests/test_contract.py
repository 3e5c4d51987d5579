"""All queries run on the smallest tables, and agree with their SQL."""

import glob
import math
import os

import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
CORE = [n for m in entry.MODULES for n in __import__(m, fromlist=["QUERIES"]).QUERIES]


def value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "tolist"):
        v = v.tolist()
    return tuple(map(value, v)) if isinstance(v, (list, tuple)) else v.isoformat() if hasattr(v, "isoformat") else v


#: Queries without SQL, and the tests that compare them with brute force.
WITHOUT_SQL = {"packed_lines": "test_operators", "soft_pairs": "test_operators", "item_containment": "test_whole_jobs"}


def check(spark, name, without=WITHOUT_SQL):
    import duckdb

    df = entry.queries()[name](spark, FOLDER)
    got = [tuple(value(r[c]) for c in sorted(df.columns)) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert name in without
        return
    con = duckdb.connect()
    for p in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    rel = con.sql(sql)
    at = [rel.columns.index(c) for c in sorted(df.columns)]
    assert len(rel.columns) == len(df.columns)
    assert sorted(map(repr, got)) == sorted(repr(tuple(value(r[i]) for i in at)) for r in rel.fetchall())


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")
@pytest.mark.parametrize("name", CORE)
def test_query(spark, name):
    check(spark, name)


def test_entry(spark):
    if os.path.isdir(FOLDER):
        assert entry.entry(spark).count() > 0
