"""Roll-ups and alert queries over prediction and request logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from demandlab.functions.calendar import epoch_seconds, floor_hour, floor_minutes, minutes_between
from demandlab.functions.numeric import INFINITY, safe_ratio


def recent_performance(log: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    """Hourly error and latency of predictions with a known actual value."""
    recent = log.filter(F.col("actual_demand").isNotNull()
                        & (F.col("timestamp") > now - F.make_dt_interval(hours=F.lit(hours))))
    e = F.col("error")
    return recent.groupBy(floor_hour("timestamp").alias("hour")).agg(
        F.count(F.lit(1)).alias("prediction_count"),
        F.avg("predicted_demand").alias("avg_predicted"), F.avg("actual_demand").alias("avg_actual"),
        F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg("latency_ms").alias("avg_latency_ms"),
    )


def hourly_predictions(log: DataFrame, now: Column, days: int = 7) -> DataFrame:
    recent = log.filter(F.col("timestamp") > now - F.make_dt_interval(F.lit(days)))
    return recent.groupBy(floor_hour("timestamp").alias("hour"), "location_id").agg(
        F.avg("predicted_demand").alias("avg_predicted_demand"), F.count(F.lit(1)).alias("prediction_count")
    )


def counters(log: DataFrame, labels: Sequence[str]) -> DataFrame:
    return log.groupBy(*labels).agg(F.count(F.lit(1)).alias("total"))


def histogram(log: DataFrame, value: str, bounds: Sequence[float], labels: Sequence[str] = ()) -> DataFrame:
    """Cumulative counts per upper bound, +Inf included.

    All bounds are counted in one aggregate and only the result is turned into
    rows, so the log is never multiplied by the number of bounds.
    """
    x = F.col(value)
    present = x.isNotNull() & ~F.isnan(x)
    names = [f"b{i}" for i in range(len(bounds))]
    counted = log.filter(present).groupBy(*labels).agg(
        *[F.count_if(x <= float(b)).alias(n) for n, b in zip(names, bounds)],
        F.count(F.lit(1)).alias("b_inf"),
    )
    steps = [F.struct(F.lit(float(b)).alias("le"), F.col(n).alias("cumulative")) for n, b in zip(names, bounds)]
    steps.append(F.struct(F.lit(INFINITY).alias("le"), F.col("b_inf").alias("cumulative")))
    return counted.select(*labels, F.inline(F.array(*steps)))


def histogram_quantiles(buckets: DataFrame, shares: Sequence[float], labels: Sequence[str]) -> DataFrame:
    """Quantiles by linear interpolation inside the bucket that reaches the rank.

    A rank in the last bucket gives the highest finite bound. Input is one row
    per (labels, bound).
    """
    series = W.partitionBy(*labels).orderBy("le")
    framed = buckets.withColumns({
        "lower": F.coalesce(F.lag("le").over(series), F.lit(0.0)),
        "below": F.coalesce(F.lag("cumulative").over(series), F.lit(0)),
        "total": F.max("cumulative").over(W.partitionBy(*labels)),
    })
    asked = framed.withColumn("q", F.explode(F.array(*[F.lit(float(s)) for s in shares])))
    rank = F.col("q") * F.col("total")
    reached = (F.col("cumulative") >= rank) & ((F.col("below") < rank) | (F.col("below") == 0))
    inside = F.col("lower") + (F.col("le") - F.col("lower")) * safe_ratio(
        rank - F.col("below"), F.col("cumulative") - F.col("below"))
    estimate = F.when(F.col("le") == INFINITY, F.col("lower")).when(F.col("le") <= 0, F.col("le")).otherwise(inside)
    hit = asked.filter(reached).withColumn("estimate", estimate)
    return hit.groupBy(*labels, "q").agg(F.min_by("estimate", "le").alias("estimate"))


def folded_quantile(bounds: Sequence[float], cumulative: Sequence[Column], share: float) -> Column:
    """``histogram_quantiles`` of one row that holds all its cumulative counts, the last one being that of +Inf.

    Only columns of the row are used, so it works where windows over bounds do not, as on streams.
    """
    total = cumulative[-1]
    rank = F.lit(float(share)) * total
    steps, lower, below = [], F.lit(0.0), F.lit(0)
    for bound, count in zip([*map(float, bounds), INFINITY], cumulative, strict=True):
        if bound == INFINITY:
            inside = lower
        elif bound <= 0:
            inside = F.lit(bound)
        else:
            inside = lower + (F.lit(bound) - lower) * safe_ratio(rank - below, count - below)
        steps.append(F.when(count >= rank, inside))
        lower, below = F.lit(bound), count
    return F.coalesce(*steps)


def feature_summary(log: DataFrame, features: Sequence[str]) -> DataFrame:
    """Count and sum of observed values per feature."""
    wide = log.select(*[F.col(f).cast("double").alias(f) for f in features])
    long = wide.unpivot([], list(features), "feature_name", "value")
    return long.groupBy("feature_name").agg(F.count("value").alias("observations"), F.sum("value").alias("total"))


def success_over(log: DataFrame, ts: str, succeeded: Column, now: Column, hours: int = 24) -> DataFrame:
    """Requests, successes and success rate of the last hours."""
    recent = log.filter((F.col(ts) > now - F.make_dt_interval(hours=F.lit(hours))) & (F.col(ts) <= now))
    counted = recent.agg(F.count(F.lit(1)).alias("requests"), F.count_if(succeeded).alias("successes"))
    return counted.withColumn("success_rate_pct", safe_ratio(F.col("successes"), F.col("requests")) * 100)


def sliding_counts(log: DataFrame, ts: str, labels: Sequence[str], measures: dict[str, Column],
                   width: int = 5, step: int = 1) -> DataFrame:
    """Sums per sliding window of ``width`` minutes starting every ``step`` minutes.

    The log is first summed per step, so only those sums are copied into the
    overlapping windows.
    """
    per_step = log.groupBy(floor_minutes(ts, step).alias("_step"), *labels).agg(
        *[F.sum(m).alias(n) for n, m in measures.items()])
    placed = per_step.withColumn("_w", F.window("_step", f"{width} minutes", f"{step} minutes"))
    return placed.groupBy(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *labels).agg(
        *[F.sum(n).alias(n) for n in measures])


def request_rates(log: DataFrame, ts: str, labels: Sequence[str], width: int = 5, step: int = 1) -> DataFrame:
    """Requests per second in each sliding window."""
    counted = sliding_counts(log, ts, labels, {"requests": F.lit(1)}, width, step)
    return counted.withColumn("per_second", F.col("requests") / (width * 60.0))


def error_rate_alerts(log: DataFrame, ts: str, failed: Column, labels: Sequence[str] = ("endpoint",),
                      limit: float = 0.05, width: int = 5, step: int = 1) -> DataFrame:
    """Error share per label and window, with the violation flag."""
    counted = sliding_counts(log, ts, labels, {"requests": F.lit(1), "errors": failed.cast("long")}, width, step)
    share = F.col("errors") / F.col("requests")
    return counted.withColumns({"error_rate": share, "violating": share > limit})


def latency_alerts(log: DataFrame, ts: str, latency: str, bounds: Sequence[float],
                   labels: Sequence[str] = ("endpoint",), share: float = 0.95, limit: float = 1.0,
                   width: int = 5, step: int = 1) -> DataFrame:
    """Histogram quantile of the latency per label and window, with the violation flag."""
    x = F.col(latency)
    measures = {f"b{i}": (x <= float(b)).cast("long") for i, b in enumerate(bounds)}
    counted = sliding_counts(log.filter(x.isNotNull()), ts, labels, {**measures, "b_inf": F.lit(1)}, width, step)
    steps = [F.struct(F.lit(float(b)).alias("le"), F.col(f"b{i}").alias("cumulative")) for i, b in enumerate(bounds)]
    steps.append(F.struct(F.lit(INFINITY).alias("le"), F.col("b_inf").alias("cumulative")))
    keys = ["window_start", "window_end", *labels]
    rows = counted.select(*keys, F.inline(F.array(*steps)))
    estimates = histogram_quantiles(rows, [share], keys).drop("q")
    return estimates.withColumn("violating", F.col("estimate") > limit)


def sustained(windows: DataFrame, labels: Sequence[str], minutes: int, step: int = 1,
              ts: str = "window_end") -> DataFrame:
    """Runs of back-to-back violating windows lasting at least ``minutes``.

    Input is one row per (label, window), so a label has at most one row per
    step of the period.
    """
    bad = windows.filter("violating").withColumn("_no", F.floor(epoch_seconds(ts) / (step * 60)))
    run = F.col("_no") - F.row_number().over(W.partitionBy(*labels).orderBy("_no"))
    runs = bad.withColumn("_run", run).groupBy(*labels, "_run").agg(
        F.min(ts).alias("first_at"), F.max(ts).alias("last_at"), F.count(F.lit(1)).alias("windows"))
    lasted = F.floor(minutes_between("first_at", "last_at"))
    return runs.withColumn("minutes", lasted).filter(F.col("minutes") >= minutes).drop("_run")


def trailing_means(log: DataFrame, ts: str, value: str, labels: Sequence[str], bucket_minutes: int = 15) -> DataFrame:
    """Per label and bucket: mean of the last hour, and of the 24 hours ending a week earlier.

    Values are summed per bucket first; the range frames then run over at most
    ``1440 / bucket_minutes`` rows a day and label. Bucket ``t`` covers the hour
    ``(t - 1 h, t]`` counted in whole buckets.
    """
    summed = log.groupBy(floor_minutes(ts, bucket_minutes).alias("bucket"), *labels).agg(
        F.sum(F.col(value).cast("double")).alias("_s"), F.count(value).alias("_n"))
    keyed = summed.withColumn("_t", epoch_seconds("bucket"))
    series = W.partitionBy(*labels).orderBy("_t")
    hour = series.rangeBetween(-3599, 0)
    day_week_ago = series.rangeBetween(-7 * 86400 - 86399, -7 * 86400)

    def mean(frame) -> Column:
        return safe_ratio(F.sum("_s").over(frame), F.sum("_n").over(frame))

    return keyed.select(*labels, "bucket", mean(hour).alias("mean_1h"), mean(day_week_ago).alias("mean_24h_week_ago"))


def activity_feed(checks: DataFrame, drift: DataFrame, each: int = 3) -> DataFrame:
    """Newest check and drift reports in one list, newest first.

    ``checks``: timestamp, status, actions_taken; ``drift``: timestamp,
    drift_detected, drifted_features.
    """
    a = checks.orderBy(F.desc("timestamp")).limit(each).select(
        F.substring("timestamp", 1, 19).alias("time"), F.lit("Continual Learning").alias("type"),
        F.col("status"), F.array_join("actions_taken", ", ").alias("actions"))
    b = drift.orderBy(F.desc("timestamp")).limit(each).select(
        F.substring("timestamp", 1, 19).alias("time"), F.lit("Drift Detection").alias("type"),
        F.when(F.col("drift_detected"), "Drift Detected").otherwise("No Drift").alias("status"),
        F.concat(F.col("drifted_features").cast("string"), F.lit(" features drifted")).alias("actions"))
    return a.unionByName(b).orderBy(F.desc("time"))


def retrain_events(checks: DataFrame) -> DataFrame:
    retrained = F.array_contains("actions_taken", "model_retrained")
    return checks.agg(F.count_if(retrained).alias("retrain_events"), F.count(F.lit(1)).alias("checks"))
