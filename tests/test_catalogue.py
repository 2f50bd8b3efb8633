"""Every registered query against its SQL."""

from __future__ import annotations

import pytest
from compare import compare, connect

import __spark_entry__ as entry
from catalogue.registry import QUERIES

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, con, name):
    assert name in ORACLES
    assert compare(entry.queries()[name](spark, sf_dir), con, ORACLES[name]) == []


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "terminal_id" and df.count() > 0
