"""Every event query with SQL equals its DuckDB oracle on the sf0.01 tables (the corpus queries have tests of their own)."""

import os

import pytest

import __spark_entry__ as entry
from oracle_compare import compare, duck
from tidemark import catalog

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
ORACLE = catalog.ORACLE
# Sketches are no exact counts; tests/test_sketches.py holds them against the exact query.
NO_SQL = {"uv_sketch_hourly", "uv_sketch_daily"}


@pytest.fixture(scope="module")
def con():
    c = duck(SF)
    yield c
    c.close()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    assert compare(entry.queries()[name](spark, SF), con, ORACLE[name]) is None


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) - set(ORACLE) == NO_SQL
    assert set(catalog.QUERIES) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["window_end", "rank", "item_id", "cnt"]
    assert df.count() > 0
