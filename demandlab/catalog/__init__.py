"""Every operator applied to the given tables, with an equivalent SQL text where SQL can express it."""

from __future__ import annotations

from demandlab.catalog import (  # noqa: F401
    aggregates, columns, drift, joins, models, quality, scans, series, streams,
)
from demandlab.catalog.registry import all_queries, all_sql  # noqa: F401
