"""Every registered query against its SQL twin, on the smallest tables."""

import compare
import pytest

import __spark_entry__ as entry
from shelfcast import catalog, oracle

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return compare.connect(SF)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, db, name):
    df = catalog.queries()[name](spark, SF)
    got = compare.spark_rows(df)
    sql = oracle.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    want = compare.sql_rows(db, sql)
    assert {d[0] for d in db.description} == set(df.columns)
    assert compare.difference(got, want) is None


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalog.queries()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["date", "used", "seven_lag"] and df.count() > 0
