"""Every query with SQL against DuckDB on the smallest tables."""

import datetime
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from gridloom.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 5) + 0.0
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, datetime.date):
        return datetime.datetime(v.year, v.month, v.day)
    return v


def rows(cols, data):
    return sorted((tuple(plain(r[i]) for i in cols) for r in data), key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    got = df.collect()
    found = con.execute(SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(names)
    want = found.fetchall()
    order = sorted(names)
    assert rows([df.columns.index(c) for c in order], got) == rows([names.index(c) for c in order], want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - {"op_M6_boosted_trees", "op_M8_grid"}))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
