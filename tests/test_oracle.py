"""Every registered query with an oracle, against DuckDB at the smallest scale; the others must return rows."""

import pytest
from oracle import compare, connect

from __spark_entry__ import entry, oracle_sql, queries


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_equals_oracle(spark, sf, con, name):
    problem, _ = compare(queries()[name](spark, sf), con, oracle_sql()[name])
    assert not problem


HEAVY = {"dbscan_grid", "segment_model_table", "k_sweep", "gmm_sweep"}


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql()) - HEAVY))
def test_returns_rows(spark, sf, name):
    assert queries()[name](spark, sf).limit(1).count() == 1


def test_entry(spark):
    assert entry(spark).columns == ["id", "units", "total"]


def test_oracles_have_queries():
    assert set(oracle_sql()) <= set(queries())
