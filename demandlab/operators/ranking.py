"""Exact running totals and quantiles that stay within a task's memory.

Spark's exact ``percentile`` keeps every distinct value of a group in one task,
and a running ``sum`` over ``partitionBy(group)`` sorts the whole group in one
task. Both are fine for a group of known size only, so here

1. equal values are merged first (map-side), so a hot value is one row;
2. the merged table is dealt to ranges of (group, value) and written once to the
   shared folder with the number of its range, because everything below reads it
   and it is far smaller than its input;
3. totals per (group, range) give each range its starting rank, and only the values
   inside a range are ordered. A group of any size takes the same way.

Spark's sampling decides where the ranges begin and never a result.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from demandlab.session import scratch_path


def settle(df: DataFrame, label: str) -> DataFrame:
    """Writes a reduced table to the shared folder and returns it as read back."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def value_counts(df: DataFrame, groups: Sequence[str], value: str, **weights: Column) -> DataFrame:
    """One row per (group, value) with summed weights; rows without a value are left out."""
    weights = weights or {"n": F.lit(1)}
    kept = df.filter(F.col(value).isNotNull() & ~F.isnan(value))
    # Adding 0.0 folds -0.0 into 0.0, which compare equal but would group apart.
    normal = kept.withColumn(value, F.col(value).cast("double") + F.lit(0.0))
    return normal.groupBy(*groups, value).agg(*[F.sum(w).alias(name) for name, w in weights.items()])


def same(names: Sequence[str], left: str, right: str) -> Column:
    """Null-safe equality of the named columns of two aliased tables."""
    return reduce(and_, [F.col(f"{left}.`{n}`").eqNullSafe(F.col(f"{right}.`{n}`")) for n in names], F.lit(True))


def running_totals(counts: DataFrame, groups: Sequence[str], value: str, measures: Sequence[str],
                   totals: Sequence[str] = ()) -> DataFrame:
    """Adds ``cum_<m>``, the group's total of ``m`` over all values up to this one, and ``all_<m>``, its total.

    ``totals`` are columns that only need ``all_<m>``. ``counts`` holds one row
    per (group, value); a NULL group is a group.
    """
    groups, every = list(groups), [*measures, *totals]
    ranged = settle(counts.repartitionByRange(*groups, value).withColumn("_slice", F.spark_partition_id()),
                    "value-ranges")
    whole = W.partitionBy(*groups)
    per_slice = ranged.groupBy(*groups, "_slice").agg(*[F.sum(m).alias(f"_in_{m}") for m in every])
    earlier = whole.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = per_slice.select(
        *groups, "_slice",
        *[F.coalesce(F.sum(f"_in_{m}").over(earlier), F.lit(0)).alias(f"_before_{m}") for m in measures],
        *[F.sum(f"_in_{m}").over(whole).alias(f"all_{m}") for m in every],
    )
    inside = W.partitionBy(*groups, "_slice").orderBy(value).rowsBetween(W.unboundedPreceding, 0)
    # One row per group and range at most: groups plus ranges, not values.
    added = [f"_before_{m}" for m in measures] + [f"all_{m}" for m in every]
    joined = ranged.alias("r").join(F.broadcast(offsets).alias("o"), same([*groups, "_slice"], "r", "o")).select(
        "r.*", *[F.col(f"o.{name}") for name in added])
    summed = joined.withColumns({f"cum_{m}": F.col(f"_before_{m}") + F.sum(m).over(inside) for m in measures})
    return summed.drop("_slice", *[f"_before_{m}" for m in measures])


def ranks_for(shares: Sequence[float], total: Column) -> Column:
    """The zero-based ranks an interpolated quantile of each share needs."""
    spots = F.transform(_shares(shares), lambda s: s * (total - 1))
    return F.array_distinct(F.concat(F.transform(spots, lambda s: F.floor(s)), F.transform(spots, lambda s: F.ceil(s))))


def _shares(shares: Sequence[float]) -> Column:
    return F.expr("array(" + ", ".join(f"{float(s)}D" for s in shares) + ")")


def held_ranks(shares: Sequence[float], weight: str) -> Column:
    """The wanted ranks a row with running totals covers."""
    end = F.col(f"cum_{weight}")
    first = end - F.col(weight)
    return F.filter(ranks_for(shares, F.col(f"all_{weight}")), lambda r: (r >= first) & (r < end))


def interpolated(shares: Sequence[float], values_at: Column, total: Column) -> Column:
    """Array of quantiles from a map of rank to value."""

    def at(share: Column) -> Column:
        spot = share * (total - 1)
        low, high = values_at[F.floor(spot)], values_at[F.ceil(spot)]
        return low + (high - low) * (spot - F.floor(spot))

    return F.transform(_shares(shares), at)


def rank_map(held: Column, value: str) -> Column:
    """Aggregates rows into a map of rank to value; at most two entries per share are kept."""
    entries = F.transform(held, lambda r: F.struct(r.alias("rank"), F.col(value).alias("value")))
    return F.map_from_entries(F.flatten(F.collect_list(F.when(F.size(held) > 0, entries))))


def exact_quantiles(counts: DataFrame, groups: Sequence[str], value: str, shares: Sequence[float],
                    weight: str = "n") -> DataFrame:
    """Linearly interpolated quantiles: one array ``quantiles`` per group, in the order of ``shares``.

    ``counts`` as for ``running_totals``.
    """
    ranked = running_totals(counts.filter(F.col(weight) > 0), groups, value, [weight])
    hits = ranked.withColumn("_held", held_ranks(shares, weight)).filter(F.size("_held") > 0)
    found = hits.groupBy(*groups).agg(
        rank_map(F.col("_held"), value).alias("_at"), F.max(f"all_{weight}").alias("_total"))
    return found.select(*groups, interpolated(shares, F.col("_at"), F.col("_total")).alias("quantiles"))
