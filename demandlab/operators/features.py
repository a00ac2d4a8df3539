"""Lag and rolling features per zone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from demandlab.functions.calendar import calendar_columns, minutes_between
from demandlab.functions.numeric import safe_ratio
from demandlab.schemas import DEMAND, LAGS, ROLLING_FEATURES, WINDOW, ZONE, lag_features


def full_frame(agg, x: Column, series: WindowSpec, rows: int, min_rows: int | None = None) -> Column:
    """Rolling aggregate over the current row and those before it.

    NULL until ``min_rows`` values are in the frame (all of them by default).
    """
    frame = series.rowsBetween(-(rows - 1), 0)
    return F.when(F.count(x).over(frame) >= (rows if min_rows is None else min_rows), agg(x).over(frame))


def moving_average(x: Column, series: WindowSpec, rows: int = 5) -> Column:
    return F.avg(x).over(series.rowsBetween(-(rows - 1), 0))


def history_columns(series: WindowSpec, lags: Sequence[int] = LAGS, value: str = DEMAND) -> dict[str, Column]:
    """Lags count observed windows, not clock time; rolling frames include the current row."""
    x = F.col(value).cast("double")
    columns = {f"lag_{n}": F.lag(x, n).over(series) for n in lags}
    columns["rolling_mean_4"] = full_frame(F.avg, x, series, 4)
    columns["rolling_std_4"] = full_frame(F.stddev_samp, x, series, 4)
    columns["rolling_max_24"] = full_frame(F.max, x, series, 24)
    columns["rolling_min_24"] = full_frame(F.min, x, series, 24)
    return columns


def with_history(demand: DataFrame, lags: Sequence[int] = LAGS) -> DataFrame:
    """Calendar, lag and rolling columns, incomplete rows included.

    All windowed columns share one partitioning and order: one shuffle on the
    zone and one sort. The input holds one row per (zone, window), so a zone is
    at most 96 rows a day however many trips it has.
    """
    series = W.partitionBy(ZONE).orderBy(WINDOW)
    return demand.withColumns({**calendar_columns(), **history_columns(series, lags)})


def with_history_spans(demand: DataFrame, lags: Sequence[int] = LAGS, span_days: int = 90) -> DataFrame:
    """The same columns for series too long to sort as one group per zone.

    Rows are numbered inside the zone from per-day counts, cut into spans of at
    least the longest look-back, and each span also receives the look-back rows
    before it. Work per task is then bounded by the span, not the series.
    """
    reach = max([*lags, 23])
    day = F.to_date(WINDOW)
    dated = demand.withColumn("_day", day)
    per_day = dated.groupBy(ZONE, "_day").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.partitionBy(ZONE).orderBy("_day").rowsBetween(W.unboundedPreceding, -1))
    starts = per_day.select(ZONE, "_day", F.coalesce(before, F.lit(0)).alias("_before"))
    in_day = F.row_number().over(W.partitionBy(ZONE, "_day").orderBy(WINDOW))
    numbered = dated.withColumn("_in_day", in_day).join(starts, [ZONE, "_day"])
    span_rows = max(span_days * 96, reach)
    position = F.col("_before") + F.col("_in_day") - 1
    own = F.floor(position / span_rows)
    # A row also serves the next span when it lies within reach of that span's first row.
    needed_next = (own + 1) * span_rows - position <= reach
    spans = F.when(needed_next, F.array(own, own + 1)).otherwise(F.array(own))
    copies = numbered.select(*demand.columns, own.alias("_own"), F.explode(spans).alias("_span"))
    series = W.partitionBy(ZONE, "_span").orderBy(WINDOW)
    built = copies.withColumns({**calendar_columns(), **history_columns(series, lags)})
    return built.filter("_span = _own").drop("_own", "_span")


def build_features(demand: DataFrame, lags: Sequence[int] = LAGS) -> DataFrame:
    """Feature rows whose whole history is present."""
    return with_history(demand, lags).na.drop(subset=[*lag_features(lags), *ROLLING_FEATURES])


def feature_row_counts(demand: DataFrame, lags: Sequence[int] = LAGS) -> DataFrame:
    """Rows before and after dropping incomplete history."""
    complete = F.lit(True)
    for name in [*lag_features(lags), *ROLLING_FEATURES]:
        complete = complete & F.col(name).isNotNull()
    counts = with_history(demand, lags).agg(
        F.count(F.lit(1)).alias("rows_before"), F.count_if(complete).alias("rows_after")
    )
    dropped = F.col("rows_before") - F.col("rows_after")
    return counts.withColumns({
        "rows_dropped": dropped, "dropped_pct": safe_ratio(dropped, F.col("rows_before")) * 100,
    })


def gap_report(df: DataFrame, ts: str = WINDOW, zone: str = ZONE) -> DataFrame:
    """Longest distance between neighbouring windows per zone, in minutes."""
    series = W.partitionBy(zone).orderBy(ts)
    step = minutes_between(F.lag(ts).over(series), F.col(ts))
    return df.select(zone, step.alias("step")).groupBy(zone).agg(
        F.max("step").alias("max_gap_minutes"), F.count("step").alias("steps")
    )


def recent_per_zone(df: DataFrame, keep: int, ts: str = WINDOW, zone: str = ZONE) -> DataFrame:
    """The last ``keep`` rows of each zone; Spark limits each group before the shuffle."""
    newest = F.row_number().over(W.partitionBy(zone).orderBy(F.desc(ts)))
    return df.withColumn("_newest", newest).filter(F.col("_newest") <= keep).drop("_newest")
