"""Every registered query with an oracle equals its DuckDB SQL at sf0.01."""

import pytest

import __spark_entry__ as entry
from conftest import SF01
from oracle_compare import compare, duck

ORACLES = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, SF01, QUERIES[name], ORACLES[name])
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["match"], r
