"""Reference and production windows, and the drift check over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from demandlab.operators.drift import drift_summary, feature_drift
from demandlab.operators.features import build_features
from demandlab.operators.sampling import fixed_sample
from demandlab.schemas import FEATURES, LAGS, WINDOW, ZONE
from demandlab.sources.trips import between, trailing

HISTORY_DAYS = 30


def reference_rows(demand: DataFrame, features: Sequence[str] = FEATURES, lags: Sequence[int] = LAGS,
                   sample_size: int | None = None) -> DataFrame:
    rows = build_features(demand, lags)
    if sample_size is not None:
        rows = fixed_sample(rows, sample_size, [ZONE, WINDOW])
    return rows.select(*features)


def production_rows(demand: DataFrame, days_back: int = 7, features: Sequence[str] = FEATURES,
                    lags: Sequence[int] = LAGS, sample_size: int | None = None) -> DataFrame:
    """The newest days, with lags taken from 30 more days of history; sampled last, if at all."""
    history = trailing(demand, days=days_back + HISTORY_DAYS)
    recent = trailing(build_features(history, lags), days=days_back)
    if sample_size is not None:
        recent = fixed_sample(recent, sample_size, [ZONE, WINDOW])
    return recent.select(*features)


def window_index(demand: DataFrame) -> DataFrame:
    """Observed windows per zone and day: small enough to be kept beside the demand table and added to day by day."""
    return demand.groupBy(ZONE, F.to_date(WINDOW).alias("day")).agg(F.count(F.lit(1)).alias("windows"))


def look_back(index: DataFrame, start: str, end: str | None, lags: Sequence[int] = LAGS) -> DataFrame:
    """One row (zone, since) per zone that has windows in the range: the day its features need history from.

    Lags count observed windows, so the day differs by zone: it is the newest one from which the
    days before the range hold the longest look-back. A zone with less history needs all of it.
    """
    reach = max([*lags, 23])
    first = F.to_date(F.lit(start))
    inside = F.col("day") >= first
    if end is not None:
        inside = inside & (F.col("day") <= F.to_date(F.lit(end)))
    # At most one row a day and zone.
    newer = F.sum("windows").over(W.partitionBy(ZONE).orderBy(F.desc("day")))
    before = index.filter(F.col("day") < first).withColumn("_n", newer)
    enough = before.groupBy(ZONE).agg(
        F.coalesce(F.max(F.when(F.col("_n") >= reach, F.col("day"))), F.min("day")).alias("since"))
    active = index.filter(inside).select(ZONE).distinct()
    return active.join(enough, ZONE, "left").select(ZONE, F.coalesce("since", first).alias("since"))


def range_rows(demand: DataFrame, start: str | None, end: str | None, lags: Sequence[int] = LAGS,
               index: DataFrame | None = None) -> DataFrame:
    """Features of a date range, built on the history before it and trimmed afterwards.

    With a ``window_index`` of the table, each zone is read from its ``look_back`` day on and the
    scan starts at the earliest of them; without one, all history before ``end`` is read.
    """
    history = between(demand, end=end)
    if index is not None and start is not None:
        since = look_back(index, start, end, lags)
        earliest = since.agg(F.min("since").cast("timestamp_ntz").alias("t")).scalar()
        needed = history.filter(F.col(WINDOW) >= earliest)
        # One row per zone.
        kept = needed.join(F.broadcast(since), ZONE).filter(F.col(WINDOW) >= F.col("since").cast("timestamp_ntz"))
        history = kept.select(*demand.columns)
    return between(build_features(history, lags), start=start)


def check_drift(reference: DataFrame, production: DataFrame, features: Sequence[str] = FEATURES,
                **limits) -> tuple[DataFrame, DataFrame]:
    """(per-feature table, one-row summary)."""
    table = feature_drift(reference, production, features, **limits)
    return table, drift_summary(table, order=features)
