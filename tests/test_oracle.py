"""Every registered query against the equivalent SQL on DuckDB."""

from __future__ import annotations

import pytest
from oracle import connect, differences

from galewright.plans import registered

WITH_SQL = sorted(n for n, q in registered().items() if q.sql)


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", WITH_SQL)
def test_matches_sql(spark, sf, con, name):
    q = registered()[name]
    assert differences(q.build(spark, sf), con, q.sql) == []


def test_entry_contract(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["age_group", "y_flag", "row_count", "avg_balance", "avg_duration"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
    own = set(registered())
    assert own <= set(entry.queries())
    assert own <= set(entry.oracle_sql())
