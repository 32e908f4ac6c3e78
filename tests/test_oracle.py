"""Every registered query against its SQL on another engine, over whole tables."""

import datetime
import os

import duckdb
import pytest

import __spark_entry__ as spark_entry
from tablecheck.plans.queries import ORACLES, QUERIES, TABLES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(cell(row[i]) for i in order) for row in values), key=repr)


def cell(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    got = rows(df.columns, df.collect())
    cursor = duck.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    want = rows(columns, cursor.fetchall())
    assert sorted(df.columns) == sorted(columns)
    assert len(got) == len(want) > 0
    assert got == want


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(spark_entry.queries())


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0
