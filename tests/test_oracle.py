"""Every registered query against its SQL, on whole tables."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as driver
from gridmart.catalog import QUERIES
from gridmart.catalog_sql import ORACLE

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Everything stays in built-in functions, and no pairs are formed without a key.
UNWANTED = ["Python", "CartesianProduct", "NestedLoopJoin"]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value.isoformat() if isinstance(value, dt.date) else value


# Their order is part of the result.
ORDERED = {"sorted_points", "sorted_prices", "first_points"}


def plain_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [tuple(plain(row[i]) for i in order) for row in rows]


def sorted_rows(names, rows):
    return sorted(plain_rows(names, rows), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(driver.queries())
    assert set(ORACLE) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    frame = QUERIES[name](spark, FOLDER)
    result = duck.execute(ORACLE[name])
    columns = [column[0] for column in result.description]
    assert sorted(frame.columns) == sorted(columns)
    operators = str(frame._jdf.queryExecution().executedPlan())
    assert not [word for word in UNWANTED if word in operators]
    shown = plain_rows if name in ORDERED else sorted_rows
    assert shown(frame.columns, frame.collect()) == shown(columns, result.fetchall())


def test_entry_runs(spark):
    assert driver.entry(spark).count() > 0
