"""Queries with SQL return its rows."""

from __future__ import annotations

import pytest
from compare import compare, connect

from tillbook.llm import queries


@pytest.mark.parametrize("name", ["op11_fill_in_middle", "op12_merkle_manifest"])
def test_query_matches_sql(spark, sf_dir, name):
    found = queries.QUERIES[name](spark, sf_dir)
    assert compare(found, connect(sf_dir), queries.ORACLES[name]) == []
