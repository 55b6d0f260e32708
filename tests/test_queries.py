"""Every registered query against its SQL twin, on the smallest test data."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_points

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    yield con
    con.close()


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return repr(value)


@pytest.mark.parametrize("name", sorted(entry_points.queries()))
def test_query(spark, duck, name):
    df = entry_points.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(v) for v in r) for r in df.select(*columns).collect())
    sql = entry_points.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    result = duck.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    assert got == sorted(tuple(plain(r[i]) for i in places) for r in result.fetchall())


def test_every_twin_belongs_to_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
