"""Structured Streaming operators (T1-T9) and alert durations (L1)."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlab.catalog import adapters as ad
from demandlab.catalog.adapters import sql_over
from demandlab.catalog.aggregates import LATENCY_BOUNDS, QUANTILE_STEPS
from demandlab.catalog.drift import FEATURE_COLUMNS, LONG_SQL, NAMES_SQL, ks_steps
from demandlab.catalog.models import decision_sql, grouped_psi_sql
from demandlab.catalog.quality import CHECKED, rule_sql
from demandlab.catalog.registry import query, rounded
from demandlab.catalog.series import SLIDING
from demandlab.operators.models import train
from demandlab.operators.observability import error_rate_alerts, latency_alerts, sustained
from demandlab.operators.profile import write_profile
from demandlab.schemas import (
    DEMAND, DEMAND_TABLE, FEATURES, LAGS, ROLLING_FEATURES, WINDOW, ZONE, lag_features,
)
from demandlab.session import scratch_path
from demandlab.streaming.checks import check_stream, quarantine_stream
from demandlab.streaming.demand import (
    demand_stream, distinct_stream, running_score_stream, score_stream, sliding_error_rates, sliding_latency,
    sustained_errors, sustained_latency,
)
from demandlab.streaming.features import feature_stream, moving_average_stream
from demandlab.streaming.io import (
    append_to_table, closable, close_stream, file_stream, newest_rows, newest_snapshot, open_for_closing, snapshots_to_table,
    upserts_to_table,
)


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = file_stream(spark, sf_dir, ad.EVENTS, "events.parquet")
    return rows.withColumn(ZONE, ad.zone_of(F.col("event_type")))


def request_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_stream(spark, sf_dir).select(
        "event_id", "ts", ZONE,
        F.when(F.col("event_id") % 2 == 0, "single").otherwise("batch").alias("endpoint"),
        F.when(F.col("event_type") == "error", "error").otherwise("success").alias("status"),
        F.get_json_object("props", "$.k").cast("double").alias("k"), "value",
        (F.col("value") / 100).alias("latency_seconds"))


def files_in_order(rows: DataFrame, ts: str, label: str, parts: int = 3) -> str:
    """``rows`` as files that arrive in the order of their times: ``parts`` spans of equal length, a file each.

    The rows are made once, by all tasks; small row groups let a stream read a file by many tasks.
    """
    path = scratch_path(rows.sparkSession, label)
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    made = rows.persist()
    try:
        span = made.agg(F.min(at).alias("low"), F.max(at).alias("high")).first()
        if span["low"] is None:
            made.write.parquet(path)
            return path
        width = (span["high"] - span["low"]) // parts + 1
        for k in range(parts):
            begin = span["low"] + k * width
            made.filter((at >= begin) & (at < begin + width)).repartition(1).write.mode("append").option(
                "parquet.block.size", 16 << 20).parquet(path)
    finally:
        made.unpersist()
    return path


def drained(spark: SparkSession, source: DataFrame, ts: str, build, label: str) -> DataFrame:
    """Runs ``build(source)`` over all that is there, then closes the stream and runs again: nothing stays open."""
    path, checkpoint, end = (scratch_path(spark, f"{label}-{part}") for part in ("table", "checkpoint", "end"))
    result = build(closable(source, open_for_closing(spark, source.schema, end)))
    append_to_table(result, path, checkpoint)
    close_stream(spark, source.schema, ts, end)
    append_to_table(result, path, checkpoint)
    return spark.read.schema(result.schema).parquet(path)


def requests_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The request stream from three files, one a batch."""
    rows = ad.requests(spark, sf_dir).select("event_id", "ts", "endpoint", "status", "latency_seconds")
    return file_stream(spark, files_in_order(rows, "ts", "request-files"), rows.schema, files_per_trigger=1)


def demand_files(spark: SparkSession, sf_dir: str) -> str:
    """The demand table as written by the demand stream."""
    path = scratch_path(spark, "demand-stream")
    append_to_table(demand_stream(event_stream(spark, sf_dir), "ts"), path, scratch_path(spark, "stream-checkpoint"))
    return path


@query("t1_event_stream", "SELECT event_id, ts, event_type, value FROM events")
def events_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "events-stream")
    append_to_table(event_stream(spark, sf_dir).select("event_id", "ts", "event_type", "value"), path, scratch_path(spark, "stream-checkpoint"))
    return spark.read.parquet(path)


# A window is emitted once the watermark (newest event - 30 minutes) has passed its end.
EMITTED = {
    "closed": """SELECT * FROM demand WHERE pickup_window + INTERVAL 15 MINUTE
    <= (SELECT date_trunc('millisecond', max(ts)) FROM events) - INTERVAL 30 MINUTE"""
}


@query("t2_streaming_demand", sql_over("demand", extra=EMITTED, body="SELECT * FROM closed"))
def streaming_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(DEMAND_TABLE).parquet(demand_files(spark, sf_dir))


@query("t2_drained_demand", sql_over("demand", body="SELECT * FROM demand"))
def drained_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ad.events(spark, sf_dir).select("event_id", "ts", ZONE)
    source = file_stream(spark, files_in_order(rows, "ts", "event-files"), rows.schema, files_per_trigger=1)
    return drained(spark, source, "ts", lambda events: demand_stream(events, "ts"), "drained-demand")


@query("t3_streaming_scores")
def streaming_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ad.features(spark, sf_dir)
    source, path = scratch_path(spark, "feature-table"), scratch_path(spark, "scores")
    rows.write.parquet(source)
    stored = spark.read.parquet(source)
    model = train(stored)
    append_to_table(score_stream(model, file_stream(spark, source, stored.schema)), path, scratch_path(spark, "stream-checkpoint"))
    return rounded(spark.read.parquet(path).select(
        WINDOW, ZONE, DEMAND, F.size("errors").alias("error_count"), "predicted"))


@query("t4_running_score", sql_over("requests", body="""
SELECT total_requests, successful, failed, round(sum_abs_error, 4) AS sum_abs_error,
  round(sum_sq_error, 2) AS sum_sq_error, round(successful / total_requests * 100, 4) AS success_rate_pct,
  round(sum_abs_error / successful, 4) AS mae, round(sqrt(sum_sq_error / successful), 4) AS rmse
FROM (SELECT count(*) AS total_requests, count(*) FILTER (WHERE status = 'success') AS successful,
  count(*) FILTER (WHERE status <> 'success') AS failed, sum(abs(value - k)) FILTER (WHERE status = 'success')
  AS sum_abs_error, sum((value - k) * (value - k)) FILTER (WHERE status = 'success') AS sum_sq_error FROM requests)"""))
def running_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "running-score")
    score = running_score_stream(request_stream(spark, sf_dir), "value", "k", F.col("status") == "success")
    snapshots_to_table(score, path, scratch_path(spark, "stream-checkpoint"))
    newest = newest_snapshot(spark, path, score.schema)
    return rounded(newest.withColumn("sum_sq_error", F.round("sum_sq_error", 2)), 4)


@query("t4_endpoint_score", sql_over("requests", body="""
SELECT endpoint, total_requests, successful, failed, round(sum_abs_error, 4) AS sum_abs_error,
  round(sum_sq_error, 2) AS sum_sq_error, round(total_requests / greatest(span, 1.0), 4) AS requests_per_second,
  round(successful / total_requests * 100, 4) AS success_rate_pct,
  round(sum_abs_error / successful, 4) AS mae, round(sqrt(sum_sq_error / successful), 4) AS rmse
FROM (SELECT endpoint, count(*) AS total_requests, count(*) FILTER (WHERE status = 'success') AS successful,
  count(*) FILTER (WHERE status <> 'success') AS failed, sum(abs(value - k)) FILTER (WHERE status = 'success')
  AS sum_abs_error, sum((value - k) * (value - k)) FILTER (WHERE status = 'success') AS sum_sq_error,
  (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0 AS span FROM requests GROUP BY endpoint)"""))
def endpoint_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six files, one a batch; every fourth batch compacts the table."""
    rows = ad.requests(spark, sf_dir).select("ts", "endpoint", "status", "value", "k")
    source = file_stream(spark, files_in_order(rows, "ts", "request-files", 6), rows.schema, files_per_trigger=1)
    score = running_score_stream(source, "value", "k", F.col("status") == "success", ["endpoint"], "ts")
    path = scratch_path(spark, "endpoint-score")
    upserts_to_table(score, path, scratch_path(spark, "stream-checkpoint"), ["endpoint"], compact_every=4)
    newest = newest_rows(spark, path, score.schema, ["endpoint"])
    return rounded(newest.withColumn("sum_sq_error", F.round("sum_sq_error", 2)), 4)


ONLINE = [*lag_features(), *ROLLING_FEATURES]
_online_sql = ", ".join(f"round({c}, 6) AS {c}" for c in ONLINE)


@query("t5_online_features", sql_over("history", extra=EMITTED, body=f"""
SELECT pickup_window, PULocationID, CAST(actual_demand AS DOUBLE) AS actual_demand, {_online_sql}, false AS late
FROM history WHERE pickup_window <= (SELECT max(pickup_window) FROM closed)"""))
def online_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, path = demand_files(spark, sf_dir), scratch_path(spark, "online-features")
    append_to_table(feature_stream(file_stream(spark, source, DEMAND_TABLE), LAGS), path, scratch_path(spark, "stream-checkpoint"))
    return rounded(spark.read.parquet(path))


# A zone that is silent for longer than this starts a new series.
LIFETIME = timedelta(minutes=30)
SERIES = {
    "gaps": f"""SELECT *, coalesce(pickup_window - lag(pickup_window) OVER z > INTERVAL {LIFETIME.seconds // 60} MINUTE, false)
    AS fresh FROM demand WINDOW z AS (PARTITION BY PULocationID ORDER BY pickup_window)""",
    "lives": """SELECT *, sum(CAST(fresh AS INTEGER)) OVER (PARTITION BY PULocationID ORDER BY pickup_window) AS life
    FROM gaps""",
}


@query("t6_moving_average_lifetime", sql_over("demand", extra=SERIES, body="""
SELECT pickup_window, PULocationID, CAST(actual_demand AS DOUBLE) AS actual_demand, false AS late,
  round(avg(actual_demand) OVER (PARTITION BY PULocationID, life ORDER BY pickup_window
  ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 6) AS moving_average FROM lives"""))
def moving_average_with_lifetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ad.demand(spark, sf_dir).select(WINDOW, ZONE, DEMAND)
    source = file_stream(spark, files_in_order(rows, WINDOW, "demand-files"), rows.schema, files_per_trigger=1)
    path = scratch_path(spark, "moving-average")
    append_to_table(moving_average_stream(source, DEMAND, lifetime=LIFETIME), path, scratch_path(spark, "stream-checkpoint"))
    return rounded(spark.read.parquet(path))


@query("t6_moving_average", sql_over("demand", extra=EMITTED, body="""
SELECT pickup_window, PULocationID, CAST(actual_demand AS DOUBLE) AS actual_demand, false AS late,
  round(avg(actual_demand) OVER (PARTITION BY PULocationID ORDER BY pickup_window
  ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 6) AS moving_average FROM closed"""))
def streaming_moving_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, path = demand_files(spark, sf_dir), scratch_path(spark, "moving-average")
    append_to_table(moving_average_stream(file_stream(spark, source, DEMAND_TABLE), DEMAND), path, scratch_path(spark, "stream-checkpoint"))
    return rounded(spark.read.parquet(path))


ERROR_RATES = """SELECT window_start, window_end, endpoint, count(*) AS requests,
  count(*) FILTER (WHERE status = 'error') AS errors,
  count(*) FILTER (WHERE status = 'error') / count(*) AS error_rate,
  count(*) FILTER (WHERE status = 'error') / count(*) > 0.05 AS violating FROM slid GROUP BY 1, 2, 3"""


@query("t7_sliding_error_rates", sql_over("requests", extra={**SLIDING, "rates": ERROR_RATES}, body="""
SELECT * REPLACE (round(error_rate, 6) AS error_rate) FROM rates
WHERE window_end <= (SELECT date_trunc('millisecond', max(ts)) FROM requests) - INTERVAL 30 MINUTE"""))
def streaming_error_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "error-rates")
    append_to_table(sliding_error_rates(request_stream(spark, sf_dir), "ts", F.col("status") == "error"), path, scratch_path(spark, "stream-checkpoint"))
    return rounded(spark.read.parquet(path))


@query("t7_error_rate_alerts", sql_over("requests", extra={**SLIDING, "rates": ERROR_RATES}, body="""
SELECT * REPLACE (round(error_rate, 6) AS error_rate) FROM rates"""))
def batch_error_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(error_rate_alerts(ad.requests(spark, sf_dir), "ts", F.col("status") == "error"))


_les = ", ".join(f"({b}::DOUBLE)" for b in LATENCY_BOUNDS) + ", ('inf'::DOUBLE)"
LATENCY_SQL = sql_over("requests", extra={
    **SLIDING,
    "hist": f"""SELECT window_start, window_end, endpoint, le, count(*) FILTER (WHERE latency_seconds <= le)
    AS cumulative FROM slid, (VALUES {_les}) AS b(le) GROUP BY 1, 2, 3, 4""",
}, body="").rstrip() + ", " + QUANTILE_STEPS.format(keys="window_start, window_end, endpoint", shares="(0.95::DOUBLE)")


@query("t7_latency_alerts", LATENCY_SQL + """ SELECT window_start, window_end, endpoint,
round(estimate, 6) AS estimate, estimate > 1.0 AS violating FROM picked WHERE rn = 1""")
def latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(latency_alerts(ad.requests(spark, sf_dir), "ts", "latency_seconds", LATENCY_BOUNDS))


@query("t7_streaming_latency", LATENCY_SQL + """ SELECT window_start, window_end, endpoint,
round(estimate, 6) AS estimate, estimate > 1.0 AS violating FROM picked WHERE rn = 1
AND window_end <= (SELECT date_trunc('millisecond', max(ts)) FROM requests) - INTERVAL 30 MINUTE""")
def streaming_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "latency")
    rows = sliding_latency(requests_in_order(spark, sf_dir), "ts", "latency_seconds", LATENCY_BOUNDS)
    append_to_table(rows, path, scratch_path(spark, "stream-checkpoint"))
    return rounded(spark.read.schema(rows.schema).parquet(path))


@query("t7_drained_latency", LATENCY_SQL + """ SELECT window_start, window_end, endpoint,
round(estimate, 6) AS estimate, estimate > 1.0 AS violating FROM picked WHERE rn = 1""")
def drained_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(drained(spark, requests_in_order(spark, sf_dir), "ts", lambda log: sliding_latency(
        log, "ts", "latency_seconds", LATENCY_BOUNDS), "drained-latency"))


# The arriving rows in three spans of equal length, one a batch, each against the whole reference.
BATCHES = {
    "span": """SELECT epoch_us(min(pickup_window)) AS low,
    (epoch_us(max(pickup_window)) - epoch_us(min(pickup_window))) // 3 + 1 AS width FROM prod""",
    "arrived": f"""SELECT *, (epoch_us(pickup_window) - low) // width AS batch_id, (lag_1 + lag_4) / 2 - actual_demand AS e,
    {rule_sql()} AS messages FROM prod, span""",
    "lprod": f"UNPIVOT (SELECT batch_id, {FEATURE_COLUMNS} FROM arrived) ON {', '.join(FEATURES)} INTO NAME feature VALUE value",
    "lone": LONG_SQL["lref"],
    "lref": "SELECT batch_id, feature, value FROM lone, (SELECT DISTINCT batch_id FROM arrived)",
    **ks_steps("batch_id, feature"),
    **grouped_psi_sql("batch_id", "arrived"),
    "tab": f"""SELECT batch_id, feature, coalesce(CASE WHEN feature = '{ZONE}' THEN psi > 0.1 ELSE p_value < 0.05 END, false) AS
    drift_detected FROM ksp JOIN psi USING (batch_id)""",
    "drift": f"""SELECT batch_id, drifted_features, {NAMES_SQL} AS names FROM (SELECT batch_id,
    count(*) FILTER (WHERE drift_detected) AS drifted_features,
    coalesce(list(feature) FILTER (WHERE drift_detected), []) AS hits FROM tab GROUP BY 1)""",
    "perf": """SELECT batch_id, avg(abs(e)) AS mae, (avg(abs(e)) - 0.5) / 0.5 * 100 AS mae_increase_pct, count(*) AS samples,
    count(*) FILTER (WHERE messages = '') AS valid_records FROM arrived GROUP BY 1""",
}
BATCH_SQL = f"""SELECT CAST(batch_id AS INTEGER) AS batch_id, round(mae, 6) AS mae, samples, drifted_features, valid_records,
  reason <> '' AS should_retrain, CASE WHEN reason = '' THEN 'All checks passed' ELSE reason END AS reason
FROM (SELECT *, {decision_sql(2.5)} AS reason FROM perf JOIN drift USING (batch_id))"""


@query("t8_batch_checks", sql_over("ref", "prod", extra=BATCHES, body=BATCH_SQL))
def batch_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    reference, production = ad.reference_and_production(spark, sf_dir)
    base, path = scratch_path(spark, "reference-profile"), scratch_path(spark, "batch-checks")
    write_profile(reference, base)
    arriving = ad.with_forecasts(production)
    rows = file_stream(spark, files_in_order(arriving, WINDOW, "feature-files"), arriving.schema, files_per_trigger=1)
    check_stream(rows, base, 0.5, path, scratch_path(spark, "stream-checkpoint"), "by_challenger")
    return rounded(spark.read.parquet(path).select(
        "batch_id", "mae", "samples", "drifted_features", "valid_records", "should_retrain", "reason"))


@query("t8_quarantine_stream", sql_over("quality", extra=CHECKED, body="""
SELECT CASE WHEN messages = '' THEN 'good' ELSE 'bad' END AS part, count(*) AS n,
  CAST(sum(event_id) AS BIGINT) AS id_sum FROM checked GROUP BY 1"""))
def quarantined(spark: SparkSession, sf_dir: str) -> DataFrame:
    arriving = ad.quality_rows(spark, sf_dir)
    rows = file_stream(spark, files_in_order(arriving, WINDOW, "quality-files"), arriving.schema, files_per_trigger=1)
    good, bad = scratch_path(spark, "good-stream"), scratch_path(spark, "bad-stream")
    quarantine_stream(rows, good, bad, scratch_path(spark, "stream-checkpoint"))
    parts = [spark.read.parquet(p).select("event_id", F.lit(n).alias("part")) for p, n in ((good, "good"), (bad, "bad"))]
    return parts[0].unionByName(parts[1]).groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("id_sum"))


@query("t9_distinct_stream", "SELECT event_id, ts, event_type, value FROM events")
def deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = event_stream(spark, sf_dir)
    twice = rows.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    path = scratch_path(spark, "distinct-stream")
    append_to_table(distinct_stream(twice.drop("copy"), "ts", ["event_id", ZONE]), path, scratch_path(spark, "stream-checkpoint"))
    return spark.read.parquet(path).select("event_id", "ts", "event_type", "value")


SUSTAINED = """SELECT endpoint, min(window_end) AS first_at, max(window_end) AS last_at, count(*) AS windows,
  CAST(max(no) - min(no) AS BIGINT) AS minutes FROM bad GROUP BY endpoint, no - rn HAVING max(no) - min(no) >= 5"""
BAD_WINDOWS = """SELECT endpoint, window_end, epoch(window_end)::BIGINT // 60 AS no,
    row_number() OVER (PARTITION BY endpoint ORDER BY window_end) AS rn FROM {src}"""


@query("l1_sustained_alerts", sql_over("requests", extra={
    **SLIDING, "rates": ERROR_RATES, "bad": BAD_WINDOWS.format(src="rates WHERE violating"),
}, body=SUSTAINED))
def sustained_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = error_rate_alerts(ad.requests(spark, sf_dir), "ts", F.col("status") == "error")
    return sustained(rates, ["endpoint"], 5)


# A run is closed when the watermark has passed its last window by more than the step.
@query("l1_streaming_alerts", sql_over("requests", extra={
    **SLIDING, "rates": ERROR_RATES, "bad": BAD_WINDOWS.format(src="rates WHERE violating"), "runs": SUSTAINED,
}, body="""SELECT * FROM runs WHERE last_at + INTERVAL 61 SECOND - INTERVAL 1 MICROSECOND
  <= (SELECT date_trunc('millisecond', max(ts)) FROM requests) - INTERVAL 30 MINUTE"""))
def streaming_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "sustained")
    rows = sustained_errors(requests_in_order(spark, sf_dir), "ts", F.col("status") == "error")
    append_to_table(rows, path, scratch_path(spark, "stream-checkpoint"))
    return spark.read.schema(rows.schema).parquet(path)


@query("l1_drained_latency_alerts", LATENCY_SQL + ", " + f"""bad AS (
{BAD_WINDOWS.format(src="picked WHERE rn = 1 AND estimate > 1.0")}) {SUSTAINED}""")
def drained_latency_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drained(spark, requests_in_order(spark, sf_dir), "ts", lambda log: sustained_latency(
        log, "ts", "latency_seconds", LATENCY_BOUNDS), "drained-alerts")
