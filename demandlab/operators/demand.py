"""Demand counts, roll-ups and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlab.functions.calendar import floor_hour, floor_minutes, with_window_parts
from demandlab.operators.cleaning import PICKUP
from demandlab.schemas import DEMAND, WINDOW, ZONE


def build_demand(trips: DataFrame, ts: str = PICKUP, zone: str = ZONE, minutes: int = 15) -> DataFrame:
    """Trips per (window, zone); empty windows are absent and rows without a zone are dropped.

    One shuffle; counts are combined on the map side, so a busy zone or window
    costs no more than a quiet one.
    """
    keyed = trips.filter(F.col(zone).isNotNull() & F.col(ts).isNotNull()).select(
        floor_minutes(ts, minutes).alias(WINDOW), F.col(zone).cast("int").alias(ZONE)
    )
    counted = keyed.groupBy(WINDOW, ZONE).agg(F.count(F.lit(1)).alias(DEMAND))
    return with_window_parts(counted)


def merge_demand(parts: DataFrame) -> DataFrame:
    """Sums partial demand tables into one row per (window, zone)."""
    summed = parts.groupBy(WINDOW, ZONE).agg(F.sum(DEMAND).alias(DEMAND))
    return with_window_parts(summed)


def dataset_profile(df: DataFrame, ts: str = WINDOW, zone: str = ZONE) -> DataFrame:
    return df.agg(
        F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"),
        F.count_distinct(zone).alias("zones"), F.count(F.lit(1)).alias("total_rows"),
    )


def hour_profile(demand: DataFrame) -> DataFrame:
    """Per (zone, hour): number of observed windows and number of trips."""
    return demand.groupBy(ZONE, "hour").agg(
        F.count(F.lit(1)).alias("slot_count"), F.sum(DEMAND).alias("trips")
    )


def hour_summary(profile: DataFrame, value: str = "slot_count") -> DataFrame:
    """Per hour: total, mean per zone and the busiest zone (lowest id on a tie)."""
    busiest = F.max_by(F.col(ZONE), F.struct(F.col(value), -F.col(ZONE)))
    return profile.groupBy("hour").agg(
        F.sum(value).alias("total"), F.avg(value).alias("mean_per_zone"), busiest.alias("busiest_zone")
    )


def hourly_rollup(demand: DataFrame, ts: str = WINDOW) -> DataFrame:
    """Per (hour, zone): observed windows and trips."""
    return demand.groupBy(floor_hour(ts).alias("hour_start"), ZONE).agg(
        F.count(F.lit(1)).alias("slot_count"), F.sum(DEMAND).alias("trips")
    )
