"""The correctness gate: every registered query equals its DuckDB oracle at
sf0.01 (column names, row count, order-insensitive values)."""

from __future__ import annotations

import pytest
from conftest import SF01
from oracle import compare

from loam.suite import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck01, name):
    ok, msg = compare(spark, name, QUERIES[name], ORACLE[name], SF01, duck01)
    assert ok, msg


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert "VisibilityOrigin" in df.columns
    assert set(e.oracle_sql()) <= set(e.queries())
