"""Registered queries next to DuckDB."""

from __future__ import annotations

import pytest
from oracle_check import compare, connect

from demandlab.llm import catalog


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_against_sql(spark, sf_dir, name):
    small = sf_dir.replace("sf0.01", "sf0.001")
    ok, message = compare(spark, connect(small), catalog.QUERIES[name], catalog.SQL[name], small)
    assert ok, message


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in catalog.QUERIES) == list(range(1, 14))
    assert set(catalog.SQL) <= set(catalog.QUERIES)
