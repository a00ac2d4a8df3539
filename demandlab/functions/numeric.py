"""Guards and error expressions.

A pandas NaN compares false with everything while Spark orders NaN above all
numbers, so floating inputs go through ``nan_to_null`` before a comparison.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INFINITY = float("inf")


def nan_to_null(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def is_finite(x: Column) -> Column:
    return F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(INFINITY)), F.lit(False))


def non_negative(x: Column) -> Column:
    """``max(0, x)``; NaN becomes 0 as in a Python ``max(0.0, nan)``, NULL stays NULL."""
    return F.when(x.isNotNull(), F.greatest(F.lit(0.0), F.nanvl(x.cast("double"), F.lit(0.0))))


def percent_error(error: Column, actual: Column, epsilon: float, policy: str = "add") -> Column:
    """Absolute error as a share of the actual value.

    ``policy="add"`` divides by ``actual + epsilon``; ``"floor"`` by ``max(|actual|, epsilon)``.
    """
    if policy == "add":
        base = actual.cast("double") + F.lit(epsilon)
    elif policy == "floor":
        base = F.greatest(F.abs(actual.cast("double")), F.lit(epsilon))
    else:
        raise ValueError(f"unknown policy {policy!r}")
    return F.abs(F.try_divide(error, base))


def percent_change(new: Column, old: Column) -> Column:
    return F.try_divide(new - old, old) * 100


def z_score(x: Column, mean: float, std: float) -> Column:
    return F.abs((x - F.lit(mean)) / F.lit(std))


def safe_ratio(part: Column, whole: Column) -> Column:
    """NULL instead of a division by zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))
