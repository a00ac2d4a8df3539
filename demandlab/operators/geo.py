"""Zone lookups and map layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlab.functions.calendar import in_zones
from demandlab.schemas import MANHATTAN_ZONES, ZONE, zone_table


def with_zone(df: DataFrame, how: str = "inner", unknown: str = "Unknown") -> DataFrame:
    """Adds the zone's name and coordinates. ``how="left"`` keeps unnamed zones as ``unknown``.

    The dimension is the fixed list of 24 named zones, so it is always broadcast.
    """
    zones = F.broadcast(zone_table(df.sparkSession))
    joined = df.join(zones, ZONE, how)
    return joined if how == "inner" else joined.withColumn("name", F.coalesce("name", F.lit(unknown)))


def zone_layer(df: DataFrame, value: str) -> DataFrame:
    """One row per named zone with its value, 0 where the table has none.

    The fixed zone list is the outer side: the table is first cut to the named
    zones by a semi join and summed per zone, which leaves at most 24 rows.
    """
    zones = zone_table(df.sparkSession)
    named = df.join(F.broadcast(zones.select(ZONE)), ZONE, "left_semi")
    per_zone = named.groupBy(ZONE).agg(F.sum(value).cast("double").alias(value))
    return zones.join(F.broadcast(per_zone), ZONE, "left").withColumn(value, F.coalesce(value, F.lit(0.0)))


def flag_manhattan(df: DataFrame) -> DataFrame:
    return df.withColumn("is_manhattan", in_zones(F.col(ZONE), MANHATTAN_ZONES))


def only_zones(df: DataFrame, zones: list[int]) -> DataFrame:
    return df.filter(F.col(ZONE).isin(*zones))


def demand_tier(demand: Column) -> Column:
    return F.when(demand > 500, "red").when(demand > 200, "orange").when(demand > 50, "blue").otherwise("gray")


def prediction_tier(prediction: Column) -> Column:
    return F.when(prediction > 20, "red").when(prediction > 10, "orange").otherwise("blue")


def heat_points(layer: DataFrame, value: str, scale: float = 100.0) -> DataFrame:
    """Coordinates and weight of the zones with a positive value."""
    return layer.filter(F.col(value) > 0).select(ZONE, "lat", "lon", (F.col(value) / scale).alias("weight"))


def against_history(predictions: DataFrame, profile: DataFrame, predicted: str = "predicted",
                    historical: str = "slot_count") -> DataFrame:
    """Predictions next to the hour profile of their zone with the absolute error."""
    joined = predictions.join(profile.select(ZONE, "hour", historical), [ZONE, "hour"])
    return joined.withColumn("abs_error", F.abs(F.col(predicted) - F.col(historical)))


def align_distributions(left: DataFrame, right: DataFrame, key: str, share: str, fill: float = 1e-4) -> DataFrame:
    """Full outer alignment of two share tables; absent keys get ``fill``."""
    a = left.select(key, F.col(share).alias(f"left_{share}"))
    b = right.select(key, F.col(share).alias(f"right_{share}"))
    return a.join(b, key, "full_outer").na.fill(fill, [f"left_{share}", f"right_{share}"])
