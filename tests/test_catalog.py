"""Every registered query with a SQL counterpart must give the same rows in DuckDB."""

from __future__ import annotations

import pytest
from oracle_check import compare, connect

from demandlab.catalog import all_queries, all_sql


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(all_sql()))
def test_same_rows_as_sql(spark, sf_dir, duck, name):
    ok, message = compare(spark, duck, all_queries()[name], all_sql()[name], sf_dir)
    assert ok, message


def test_every_sql_text_belongs_to_a_query():
    assert set(all_sql()) <= set(all_queries())


def test_entry_has_rows(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).count() > 0
