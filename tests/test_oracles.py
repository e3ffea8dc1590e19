"""Every query with a SQL equivalent gives the same rows as DuckDB."""

import compare
import pytest

import __spark_entry__ as entry
from workload.oracles import ORACLES
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


def test_keys_match():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert QUERIES.items() <= entry.queries().items() and ORACLES.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    found = compare.differences(QUERIES[name](spark, SF_DIR), con, ORACLES[name])
    assert not found, "\n".join(found)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.columns[:2] == ["coin_id", "vs_currency"] and rows.count() == 10
