"""Every registered query against its SQL oracle, on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_point
from conftest import SF
from drydock.catalog.common import TABLES

QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return repr(value)


def test_oracles_name_queries():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    found = sorted(tuple(_plain(r[c]) for c in columns) for r in df.collect())
    if name not in ORACLES:
        assert found
        return
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert found == sorted(tuple(_plain(r[i]) for i in order) for r in result.fetchall())


@pytest.mark.parametrize("name, by", [
    ("profile_tables", ["dataset"]), ("profile_sizes", ["dataset"]), ("variable_keep_first", ["variable"]),
    ("clean_tables", ["doc", "variable"]), ("ingest_report", ["status", "dataset"]), ("published_profile", ["dataset"])])
def test_order(spark, name, by):
    """What is sorted comes out sorted."""
    found = [tuple(r[c] for c in by) for r in QUERIES[name](spark, SF).collect()]
    assert found == sorted(found) and len(found) > 1


def test_preview_is_the_first_rows(spark, duck):
    want = duck.execute(ORACLES["dictionary_preview"]).fetchall()
    assert [tuple(r) for r in QUERIES["dictionary_preview"](spark, SF).collect()] == want


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.count() == len(TABLES)
