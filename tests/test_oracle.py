"""The correctness gate: every registered query against its DuckDB oracle at sf0.01."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from conftest import SF01
from oracle_compare import compare, duck_connection
from slaflow.plans.catalog import QUERIES
from slaflow.plans.oracle import ORACLE_SQL

NAMES = sorted(ORACLE_SQL)


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF01)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(queries()) and set(ORACLE_SQL) <= set(oracle_sql()) <= set(queries())


def test_entry_runs(spark):
    df = entry(spark)
    assert df.count() >= 0 and "sla_compliance_rate" in df.columns


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, QUERIES[name], ORACLE_SQL[name], SF01, con)
    assert r["ok"], r
