"""Trip cleaning rules, the cleaning funnel and de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlab.functions.calendar import lasts_between, minutes_between
from demandlab.functions.numeric import safe_ratio

PICKUP, DROPOFF, DISTANCE = "tpep_pickup_datetime", "tpep_dropoff_datetime", "trip_distance"


def in_year(year: int, ts: str = PICKUP) -> Column:
    """Half-open range instead of ``year(ts) = y``, so Parquet statistics can skip row groups."""
    start = F.lit(f"{year}-01-01").cast("timestamp_ntz")
    end = F.lit(f"{year + 1}-01-01").cast("timestamp_ntz")
    return (F.col(ts) >= start) & (F.col(ts) < end)


def in_month(month: Column | str = "expected_month", ts: str = PICKUP) -> Column:
    return F.month(ts) == (F.col(month) if isinstance(month, str) else month)


def positive_distance(distance: str = DISTANCE) -> Column:
    return ~F.isnan(distance) & (F.col(distance) > 0)


def plausible_duration(low: float = 1.0, high: float = 300.0) -> Column:
    """Trip minutes strictly between both limits."""
    return lasts_between(PICKUP, DROPOFF, low, high)


def with_duration(trips: DataFrame) -> DataFrame:
    return trips.withColumn("duration_minutes", minutes_between(PICKUP, DROPOFF))


def clean_trips(trips: DataFrame, year: int) -> DataFrame:
    """Rows of the year and file month with a positive distance and a plausible duration."""
    return trips.filter(in_year(year) & in_month() & positive_distance() & plausible_duration())


def cleaning_funnel(trips: DataFrame, year: int, by: str = "expected_month") -> DataFrame:
    """Rows in, dropped by date, dropped by quality and kept, per file month and in total (NULL month)."""
    dated = F.coalesce(in_year(year) & in_month(), F.lit(False))
    good = F.coalesce(positive_distance() & plausible_duration(), F.lit(False))
    per_month = trips.groupBy(by).agg(
        F.count(F.lit(1)).alias("original_rows"),
        F.count_if(~dated).alias("date_dropped"),
        F.count_if(dated & ~good).alias("quality_dropped"),
        F.count_if(dated & good).alias("clean_rows"),
    )
    # The roll-up runs over one row per month, so the trips are not doubled for the total.
    steps = ["original_rows", "date_dropped", "quality_dropped", "clean_rows"]
    counts = per_month.rollup(by).agg(*[F.sum(c).alias(c) for c in steps])
    return counts.withColumn("pass_rate_pct", safe_ratio(F.col("clean_rows"), F.col("original_rows")) * 100)


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many rows repeat a key already seen."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return per_key.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_rows"))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first by ``order``.

    An aggregate, not a window: copies of a key are reduced before the shuffle,
    so a key holding a large share of the rows does not land in one task.
    """
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order))
    picked = df.groupBy(*keys).agg(first.alias("_first"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns])


def concat_tables(tables: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; columns absent from one table become NULL."""
    merged = tables[0]
    for other in tables[1:]:
        merged = merged.unionByName(other, allowMissingColumns=True)
    return merged
