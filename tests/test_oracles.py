"""Every registered query with an oracle returns the oracle's rows (sf0.001, DuckDB)."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF0001
from tests.oracle_compare import compare

ORACLES = E.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck0001, name):
    df = E.queries()[name](spark, SF0001)
    ok, msg = compare(df, ORACLES[name], duck0001)
    assert ok, msg


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "runs_match_1_ago" in df.columns
