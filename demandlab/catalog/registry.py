"""Collects the queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        if name in _queries:
            raise ValueError(f"query {name} is registered twice")
        _queries[name] = run
        if sql is not None:
            _sql[name] = sql
        return run

    return register


def all_queries() -> dict[str, Query]:
    return dict(_queries)


def all_sql() -> dict[str, str]:
    return dict(_sql)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Rounds every double column, because engines sum doubles in different orders."""
    return df.select(*[
        F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema.fields
    ])
