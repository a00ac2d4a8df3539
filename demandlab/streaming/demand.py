"""Streaming demand counts, de-duplication and scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlab.functions.calendar import seconds_between, with_window_parts
from demandlab.operators.metrics import with_rates
from demandlab.operators.models import score
from demandlab.operators.observability import folded_quantile
from demandlab.operators.quality import request_errors
from demandlab.schemas import DEMAND, WINDOW, ZONE
from demandlab.streaming.io import event_time, kept


def demand_stream(trips: DataFrame, ts: str, zone: str = ZONE, delay: str = "30 minutes",
                  minutes: int = 15) -> DataFrame:
    """Tumbling demand counts; a window is emitted once the watermark passed its end, later rows are dropped."""
    timed = event_time(kept(trips, ts, F.col(zone).isNotNull()), ts, delay)
    counted = timed.groupBy(F.window(ts, f"{minutes} minutes").alias("_w"), F.col(zone).cast("int").alias(ZONE)).agg(
        F.count(F.lit(1)).alias(DEMAND))
    flat = counted.select(F.col("_w.start").cast("timestamp_ntz").alias(WINDOW), ZONE, DEMAND)
    return with_window_parts(flat)


def distinct_stream(rows: DataFrame, ts: str, keys: Sequence[str], delay: str = "30 minutes") -> DataFrame:
    """First row per key among rows arriving within the watermark delay."""
    once = event_time(rows, ts, delay).dropDuplicatesWithinWatermark(list(keys))
    return once.withColumn(ts, F.col(ts).cast("timestamp_ntz"))


def running_score_stream(rows: DataFrame, actual: str, predicted: str, succeeded: Column,
                         labels: Sequence[str] = (), ts: str | None = None) -> DataFrame:
    """Totals since the start of the stream, per label, with requests per second where ``ts`` is given.

    The state is one row per label. Without labels use complete output mode, with labels update mode.
    """
    e = F.when(succeeded, F.col(actual).cast("double") - F.col(predicted).cast("double"))
    rate = [(F.count(F.lit(1)) / F.greatest(seconds_between(F.min(ts), F.max(ts)), F.lit(1.0)))
            .alias("requests_per_second")] if ts else []
    totals = rows.groupBy(*labels).agg(
        F.count(F.lit(1)).alias("total_requests"), F.count_if(succeeded).alias("successful"),
        F.count_if(~succeeded).alias("failed"), F.sum(F.abs(e)).alias("sum_abs_error"),
        F.sum(e * e).alias("sum_sq_error"), *rate,
    )
    return with_rates(totals)


def _spans(log: DataFrame, ts: str, width: int, step: int, delay: str) -> tuple[DataFrame, Column]:
    return event_time(log, ts, delay), F.window(ts, f"{width} minutes", f"{step} minutes").alias("_w")


def _flat(windows: DataFrame, *columns: str | Column) -> DataFrame:
    return windows.select(F.col("_w.start").cast("timestamp_ntz").alias("window_start"),
                          F.col("_w.end").cast("timestamp_ntz").alias("window_end"), *columns)


def _error_windows(log: DataFrame, ts: str, failed: Column, labels: Sequence[str], limit: float, width: int, step: int,
                   delay: str) -> DataFrame:
    timed, span = _spans(log, ts, width, step, delay)
    counted = timed.groupBy(span, *labels).agg(
        F.count(F.lit(1)).alias("requests"), F.sum(failed.cast("long")).alias("errors"))
    share = F.col("errors") / F.col("requests")
    return counted.withColumns({"error_rate": share, "violating": share > limit})


def sliding_error_rates(log: DataFrame, ts: str, failed: Column, labels: Sequence[str] = ("endpoint",),
                        limit: float = 0.05, width: int = 5, step: int = 1, delay: str = "30 minutes") -> DataFrame:
    """Streaming twin of ``observability.error_rate_alerts``."""
    rates = _error_windows(log, ts, failed, labels, limit, width, step, delay)
    return _flat(rates, *labels, "requests", "errors", "error_rate", "violating")


def _latency_windows(log: DataFrame, ts: str, latency: str, bounds: Sequence[float], labels: Sequence[str], share: float,
                     limit: float, width: int, step: int, delay: str) -> DataFrame:
    x = F.col(latency)
    timed, span = _spans(kept(log, ts, x.isNotNull()), ts, width, step, delay)
    names = [f"_b{i}" for i in range(len(bounds))]
    # The state of a window is one count per bound, whatever the number of requests.
    counted = timed.groupBy(span, *labels).agg(
        *[F.count_if(x <= float(b)).alias(n) for n, b in zip(names, bounds, strict=True)], F.count(F.lit(1)).alias("_all"))
    estimate = folded_quantile(bounds, [F.col(n) for n in (*names, "_all")], share)
    return counted.withColumn("estimate", estimate).withColumn("violating", F.col("estimate") > limit)


def sliding_latency(log: DataFrame, ts: str, latency: str, bounds: Sequence[float], labels: Sequence[str] = ("endpoint",),
                    share: float = 0.95, limit: float = 1.0, width: int = 5, step: int = 1,
                    delay: str = "30 minutes") -> DataFrame:
    """Streaming twin of ``observability.latency_alerts``: a histogram quantile per label and closed window."""
    rows = _latency_windows(log, ts, latency, bounds, labels, share, limit, width, step, delay)
    return _flat(rows, *labels, "estimate", "violating")


def _sustained(windows: DataFrame, labels: Sequence[str], minutes: int, step: int) -> DataFrame:
    """Runs of back-to-back violating windows as sessions of a second stateful operator.

    A window stands at its last microsecond. Sessions take up what begins within a step and a second of the row
    before, which is the next window and never the one after it. The ends of a run are aggregates: a filter on the
    session's own bounds would be moved below the operator that merges sessions.
    """
    placed = windows.filter("violating").withColumn("_at", F.window_time("_w"))
    runs = placed.groupBy(F.session_window("_at", f"{step * 60 + 1} seconds").alias("_run"), *labels).agg(
        F.min("_at").alias("_first"), F.max("_at").alias("_last"), F.count(F.lit(1)).alias("windows"))
    tick = F.expr("INTERVAL 1 MICROSECOND")
    lasted = F.floor((F.unix_micros("_last") - F.unix_micros("_first")) / 60_000_000)
    return runs.filter(lasted >= minutes).select(
        *labels, (F.col("_first") + tick).cast("timestamp_ntz").alias("first_at"),
        (F.col("_last") + tick).cast("timestamp_ntz").alias("last_at"), "windows", lasted.alias("minutes"))


def sustained_errors(log: DataFrame, ts: str, failed: Column, labels: Sequence[str] = ("endpoint",), minutes: int = 5,
                     limit: float = 0.05, width: int = 5, step: int = 1, delay: str = "30 minutes") -> DataFrame:
    """Streaming twin of ``observability.sustained`` over error rates: a run is emitted once it cannot go on."""
    return _sustained(_error_windows(log, ts, failed, labels, limit, width, step, delay), labels, minutes, step)


def sustained_latency(log: DataFrame, ts: str, latency: str, bounds: Sequence[float], labels: Sequence[str] = ("endpoint",),
                      minutes: int = 5, share: float = 0.95, limit: float = 1.0, width: int = 5, step: int = 1,
                      delay: str = "30 minutes") -> DataFrame:
    """The same over latency quantiles."""
    rows = _latency_windows(log, ts, latency, bounds, labels, share, limit, width, step, delay)
    return _sustained(rows, labels, minutes, step)


def score_stream(model: PipelineModel, requests: DataFrame) -> DataFrame:
    """Scores the requests that pass validation; the others keep their messages and no prediction."""
    checked = requests.withColumn("errors", request_errors())
    scored = score(model, checked)
    return scored.withColumn("predicted", F.when(F.size("errors") == 0, F.col("predicted")))
