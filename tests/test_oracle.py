"""Every query with an oracle matches DuckDB at sf0.01 (row count, names, values)."""

import pytest

from __spark_entry__ import oracle_sql, queries
from tests.conftest import SF001
from tools.oracle_check import compare, duck_connect

ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF001)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_matches_duckdb(spark, con, key):
    ok, n, _, detail = compare(spark, con, key, queries()[key], ORACLES[key], SF001)
    assert ok, detail
