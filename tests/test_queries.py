"""Every registered query against its SQL on the smallest tables."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as driver

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value.isoformat() if isinstance(value, (dt.date, dt.datetime)) else value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(plain(row[i]) for i in order) for row in rows], key=repr)


def test_all_checked_but_random_ones():
    assert set(driver.queries()) - set(driver.oracle_sql()) == {
        name for name in driver.queries() if name.startswith("op") and name not in driver.oracle_sql()
    } | ({"pipeline"} & set(driver.queries()))


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    got = driver.queries()[name](spark, FOLDER)
    want = duck.sql(driver.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted_rows(got.columns, got.collect()) == sorted_rows(want.columns, want.fetchall())


def test_flagship(spark):
    mart = driver.entry(spark)
    assert "player_total_move_time" in mart.columns and mart.count() > 1000
