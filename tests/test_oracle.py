"""Every registered query against DuckDB on the given tables."""

import os

import pytest

import __spark_entry__ as entry
from loamline import catalog
from tests.oracle import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = catalog.oracle_sql()
QUERIES = {name: fn for name, fn in entry.queries().items() if name in catalog.queries()}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    assert compare(spark, con, QUERIES[name], SQL[name], SF_DIR) is None


def test_a_query_can_be_released(spark):
    result = QUERIES["agg_quality_score"](spark, SF_DIR)
    paths = list(result.staged.paths)
    assert result.count() == 1 and paths
    assert result.staged.drop() == len(paths)
    assert not any(os.path.exists(p.removeprefix("file:")) for p in paths)


def test_entry_has_rows(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 5 and all(r.total_count > 0 for r in rows)
