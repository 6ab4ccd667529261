"""Every registered query with an oracle agrees with DuckDB; the others give rows."""

import pytest
from oracle import compare

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, duck, sf, name):
    assert compare(spark, duck, name, QUERIES[name], ORACLES[name], sf) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and all(r.trained_tokens <= r.tokens for r in rows)
