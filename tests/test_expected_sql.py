"""Every registered query against its expected SQL, over whole tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from panelspark.plans.standins import TABLES

QUERIES, EXPECTED = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def db(sf):
    found = duckdb.connect()
    for t in TABLES:
        found.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return found


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_equals_expected_sql(spark, sf, db, name):
    df = QUERIES[name](spark, sf)
    found = table(df.columns, [tuple(r) for r in df.collect()])
    result = db.execute(EXPECTED[name])
    assert found == table([c[0] for c in result.description], result.fetchall())


def test_names_match():
    assert set(EXPECTED) <= set(QUERIES)
    assert entry.FLAGSHIP in EXPECTED


def test_entry(spark):
    assert entry.entry(spark).count() > 0
