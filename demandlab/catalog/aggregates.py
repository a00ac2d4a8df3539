"""Aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlab.catalog import adapters as ad
from demandlab.catalog.adapters import sql_over
from demandlab.catalog.joins import PROFILE
from demandlab.catalog.registry import query, rounded
from demandlab.catalog.scans import DAILY_SQL, LONG_ERRORS, METRICS_SQL, MONTHLY_SQL, daily_checks, monthly_trips
from demandlab.operators.cleaning import cleaning_funnel
from demandlab.operators.demand import (
    build_demand, dataset_profile, hour_profile, hour_summary, hourly_rollup, merge_demand,
)
from demandlab.operators.metrics import (
    METRIC_NAMES, guarded_metrics, history_stats, leaderboard, performance_check, prediction_performance,
    regression_metrics, running_score,
)
from demandlab.operators.observability import (
    counters, feature_summary, histogram, histogram_quantiles, hourly_predictions, recent_performance,
    retrain_events, success_over,
)
from demandlab.schemas import BATCH_SIZE_BOUNDS, DEMAND, LATENCY_BOUNDS, VALUE_BOUNDS, WINDOW, ZONE
from demandlab.sources.logs import metric_rows

NOW = "2024-01-31"


def now():
    return F.lit(NOW).cast("timestamp_ntz")


@query("a1_demand_15min", sql_over("demand", body="SELECT * FROM demand"))
def demand_15min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad.demand(spark, sf_dir)


@query("a2_merged_demand", sql_over("demand", body="""
SELECT pickup_window, PULocationID, actual_demand, hour, day_of_week, month FROM demand"""))
def merged_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ad.events(spark, sf_dir)
    halves = [build_demand(rows.filter(F.col("event_id") % 2 == part), ts="ts") for part in (0, 1)]
    return merge_demand(halves[0].unionByName(halves[1]))


_GOOD = """trip_distance > 0 AND epoch_us(tpep_dropoff_datetime) - epoch_us(tpep_pickup_datetime) > 60000000
AND epoch_us(tpep_dropoff_datetime) - epoch_us(tpep_pickup_datetime) < 18000000000"""
_DATED = "year(tpep_pickup_datetime) = 2024 AND month(tpep_pickup_datetime) = expected_month"


@query("a3_cleaning_funnel", sql_over("trips", extra=MONTHLY_SQL, body=f"""
SELECT expected_month, count(*) AS original_rows, count(*) FILTER (WHERE NOT ({_DATED})) AS date_dropped,
  count(*) FILTER (WHERE {_DATED} AND NOT ({_GOOD})) AS quality_dropped,
  count(*) FILTER (WHERE {_DATED} AND {_GOOD}) AS clean_rows,
  round(count(*) FILTER (WHERE {_DATED} AND {_GOOD}) / count(*) * 100, 6) AS pass_rate_pct
FROM monthly GROUP BY ROLLUP (expected_month)"""))
def funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(cleaning_funnel(monthly_trips(spark, sf_dir), 2024))


@query("a4_dataset_profile", sql_over("demand", body="""
SELECT min(pickup_window) AS first_ts, max(pickup_window) AS last_ts, count(DISTINCT PULocationID) AS zones,
  count(*) AS total_rows FROM demand"""))
def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset_profile(ad.demand(spark, sf_dir))


@query("a5_hour_profile", sql_over("demand", extra=PROFILE, body="SELECT * FROM profile"))
def profile_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hour_profile(ad.demand(spark, sf_dir))


@query("a6_hour_summary", sql_over("demand", extra=PROFILE, body="""
SELECT hour, CAST(sum(slot_count) AS BIGINT) AS total, round(avg(slot_count), 6) AS mean_per_zone,
  first(PULocationID ORDER BY slot_count DESC, PULocationID) AS busiest_zone FROM profile GROUP BY hour"""))
def summary_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(hour_summary(hour_profile(ad.demand(spark, sf_dir))))


@query("a7_hourly_rollup", sql_over("demand", body="""
SELECT date_trunc('hour', pickup_window) AS hour_start, PULocationID, count(*) AS slot_count,
  CAST(sum(actual_demand) AS BIGINT) AS trips FROM demand GROUP BY 1, 2"""))
def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_rollup(ad.demand(spark, sf_dir))


@query("a8_retrain_events", sql_over("requests", extra=DAILY_SQL, body="""
SELECT count(*) FILTER (WHERE bad * 5 > n) AS retrain_events, count(*) AS checks FROM checks"""))
def retrains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrain_events(daily_checks(spark, sf_dir))


@query("a9_recent_performance", sql_over("plog", body=f"""
SELECT date_trunc('hour', timestamp) AS hour, count(*) AS prediction_count,
  round(avg(predicted_demand), 6) AS avg_predicted, round(avg(actual_demand), 6) AS avg_actual,
  round(avg(abs(error)), 6) AS mae, round(sqrt(avg(error * error)), 6) AS rmse,
  round(avg(latency_ms), 6) AS avg_latency_ms
FROM plog WHERE actual_demand IS NOT NULL AND timestamp > TIMESTAMP '{NOW}' - INTERVAL 24 HOUR GROUP BY 1"""))
def recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(recent_performance(ad.prediction_log(spark, sf_dir), now()))


@query("a10_hourly_predictions", sql_over("plog", body=f"""
SELECT date_trunc('hour', timestamp) AS hour, location_id,
  round(avg(predicted_demand), 6) AS avg_predicted_demand, count(*) AS prediction_count
FROM plog WHERE timestamp > TIMESTAMP '{NOW}' - INTERVAL 7 DAY GROUP BY 1, 2"""))
def predictions_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(hourly_predictions(ad.prediction_log(spark, sf_dir), now()))


_METRICS_ROUNDED = ", ".join(f"round({m}, 6) AS {m}" for m in METRIC_NAMES)


@query("a11_regression_metrics", sql_over("long_preds", extra=LONG_ERRORS, body=f"""
SELECT model, {_METRICS_ROUNDED}, samples FROM (SELECT model, {METRICS_SQL} FROM errs GROUP BY model)"""))
def metric_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(regression_metrics(ad.long_predictions(spark, sf_dir)))


@query("a12_performance_check", sql_over("preds", body="""
SELECT round(mae, 6) AS mae, round(rmse, 6) AS rmse, round(r2, 6) AS r2, samples, 2.32::DOUBLE AS baseline_mae,
  round((mae - 2.32) / 2.32 * 100, 6) AS mae_increase_pct FROM (
  SELECT avg(abs(e)) AS mae, sqrt(avg(e * e)) AS rmse, 1 - sum(e * e) / (var_pop(y) * count(*)) AS r2,
  count(*) AS samples FROM (SELECT by_challenger - actual_demand AS e, CAST(actual_demand AS DOUBLE) AS y FROM preds))"""))
def performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(performance_check(ad.predictions(spark, sf_dir), 2.32, predicted="by_challenger"))


@query("a13_guarded_metrics", sql_over("preds", body="""
SELECT round(avg(abs(e)), 6) AS mae, round(sqrt(avg(e * e)), 6) AS rmse,
  round(avg(abs(e) / (y + 1e-10)) * 100, 6) AS mape,
  round(1 - sum(e * e) / (var_pop(y) * count(*) + 1e-10), 6) AS r2
FROM (SELECT actual_demand - by_challenger AS e, CAST(actual_demand AS DOUBLE) AS y FROM preds)"""))
def guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(guarded_metrics(ad.predictions(spark, sf_dir), predicted="by_challenger"))


@query("a14_report_metrics", sql_over("preds", body="""
SELECT round(avg(abs(e)), 6) AS mae, round(sqrt(avg(e * e)), 6) AS rmse,
  round(avg(abs(e / (y + 1e-8))) * 100, 6) AS mape, round(avg(e), 6) AS bias
FROM (SELECT by_challenger - actual_demand AS e, CAST(actual_demand AS DOUBLE) AS y FROM preds)"""))
def report_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(prediction_performance(ad.predictions(spark, sf_dir), predicted="by_challenger"))


@query("a15_running_score", sql_over("requests", body="""
SELECT total_requests, successful, failed, round(sum_abs_error, 4) AS sum_abs_error,
  round(sum_sq_error, 2) AS sum_sq_error, round(successful / total_requests * 100, 4) AS success_rate_pct,
  round(sum_abs_error / successful, 4) AS mae, round(sqrt(sum_sq_error / successful), 4) AS rmse,
  round(total_requests / greatest(span, 1.0), 4) AS requests_per_second
FROM (SELECT count(*) AS total_requests, count(*) FILTER (WHERE status = 'success') AS successful,
  count(*) FILTER (WHERE status <> 'success') AS failed, sum(abs(value - k)) FILTER (WHERE status = 'success')
  AS sum_abs_error, sum((value - k) * (value - k)) FILTER (WHERE status = 'success') AS sum_sq_error,
  (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0 AS span FROM requests)"""))
def running(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = running_score(ad.requests(spark, sf_dir), "value", "k", F.col("status") == "success", "ts")
    return rounded(score.withColumn("sum_sq_error", F.round("sum_sq_error", 2)), 4)


@query("a16_stream_stats", sql_over("requests", body="""
SELECT first(value ORDER BY ts DESC, event_id DESC) AS latest, round(avg(value), 6) AS mean, min(value) AS lowest,
  max(value) AS highest, count(value) AS points FROM requests"""))
def stream_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(history_stats(ad.requests(spark, sf_dir), "value", ["ts", "event_id"]))


@query("a17_counters", sql_over("requests", body="""
SELECT endpoint, status, count(*) AS total FROM requests GROUP BY 1, 2"""))
def counts_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counters(ad.requests(spark, sf_dir), ["endpoint", "status"])


@query("a17_error_counters", sql_over("requests", body="""
SELECT error_type, endpoint, count(*) AS total FROM requests WHERE status = 'error' GROUP BY 1, 2"""))
def error_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = ad.requests(spark, sf_dir).filter(F.col("status") == "error")
    return counters(failed, ["error_type", "endpoint"])


def _histogram_sql(source: str, value: str, bounds: list[float], label: str = "") -> str:
    les = ", ".join(f"({b}::DOUBLE)" for b in bounds) + ", ('inf'::DOUBLE)"
    pick, group = (f"{label}, ", f"{label}, ") if label else ("", "")
    return (f"SELECT {pick}le, count(*) FILTER (WHERE {value} <= le) AS cumulative FROM {source}, "
            f"(VALUES {les}) AS b(le) GROUP BY {group}le")


LATENCY_HISTOGRAM = {"hist": _histogram_sql("requests", "latency_seconds", LATENCY_BOUNDS, "endpoint")}


@query("a18_latency_histogram", sql_over("requests", extra=LATENCY_HISTOGRAM, body="SELECT * FROM hist"))
def latency_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram(ad.requests(spark, sf_dir), "latency_seconds", LATENCY_BOUNDS, ["endpoint"])


@query("a18_value_histogram", sql_over("requests", body=_histogram_sql("requests", "value", VALUE_BOUNDS)))
def value_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram(ad.requests(spark, sf_dir), "value", VALUE_BOUNDS)


@query("a18_batch_size_histogram", sql_over("requests", extra={
    "sizes": "SELECT time_bucket(INTERVAL 60 MINUTE, ts) AS h, count(*) AS size FROM requests "
             "WHERE endpoint = 'batch' GROUP BY 1",
}, body=_histogram_sql("sizes", "size", BATCH_SIZE_BOUNDS)))
def batch_size_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    batches = ad.requests(spark, sf_dir).filter(F.col("endpoint") == "batch")
    hour = F.window("ts", "60 minutes").start
    sizes = batches.groupBy(hour.alias("h")).agg(F.count(F.lit(1)).alias("size"))
    return histogram(sizes, "size", BATCH_SIZE_BOUNDS)


QUANTILE_STEPS = """framed AS (SELECT *, coalesce(lag(le) OVER w, 0.0) AS lower, coalesce(lag(cumulative) OVER w, 0) AS below,
  max(cumulative) OVER (PARTITION BY {keys}) AS total FROM hist WINDOW w AS (PARTITION BY {keys} ORDER BY le)),
  asked AS (SELECT *, q * total AS rank FROM framed, (VALUES {shares}) AS s(q)),
  picked AS (SELECT {keys}, q, CASE WHEN isinf(le) THEN lower WHEN le <= 0 THEN le
  ELSE lower + (le - lower) * (rank - below) / nullif(cumulative - below, 0) END AS estimate,
  row_number() OVER (PARTITION BY {keys}, q ORDER BY le) AS rn FROM asked WHERE cumulative >= rank)"""


@query("a19_latency_quantiles", sql_over("requests", extra=LATENCY_HISTOGRAM, body="SELECT 1").removesuffix(
    "\nSELECT 1") + ", " + QUANTILE_STEPS.format(keys="endpoint", shares="(0.5::DOUBLE), (0.95::DOUBLE), (0.99::DOUBLE)")
    + " SELECT endpoint, q, round(estimate, 6) AS estimate FROM picked WHERE rn = 1")
def latency_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    buckets = histogram(ad.requests(spark, sf_dir), "latency_seconds", LATENCY_BOUNDS, ["endpoint"])
    return rounded(histogram_quantiles(buckets, [0.5, 0.95, 0.99], ["endpoint"]))


@query("a20_feature_summary", sql_over("features", body="""
SELECT 'lag_1' AS feature_name, count(lag_1) AS observations, round(sum(lag_1), 6) AS total FROM features
UNION ALL SELECT 'lag_4', count(lag_4), round(sum(lag_4), 6) FROM features
UNION ALL SELECT 'lag_96', count(lag_96), round(sum(lag_96), 6) FROM features
UNION ALL SELECT 'rolling_mean_4', count(rolling_mean_4), round(sum(rolling_mean_4), 6) FROM features"""))
def observed_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(feature_summary(ad.features(spark, sf_dir), ["lag_1", "lag_4", "lag_96", "rolling_mean_4"]))


@query("a21_success_rate", sql_over("requests", body=f"""
SELECT count(*) AS requests, count(*) FILTER (WHERE status = 'success') AS successes,
  round(count(*) FILTER (WHERE status = 'success') / count(*) * 100, 6) AS success_rate_pct
FROM requests WHERE ts > TIMESTAMP '{NOW}' - INTERVAL 24 HOUR AND ts <= TIMESTAMP '{NOW}'"""))
def success_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(success_over(ad.requests(spark, sf_dir), "ts", F.col("status") == "success", now()))


# Three forecasts of every row: a day ago, the blend, and the newest value.
THREE = {
    "three": """SELECT model, predicted, actual_demand FROM long_preds UNION ALL
    SELECT 'by_newest', lag_1, actual_demand FROM features""",
    "errs": "SELECT model, CAST(actual_demand AS DOUBLE) AS y, CAST(predicted - actual_demand AS DOUBLE) AS e FROM three",
    "wide": f"SELECT model, {METRICS_SQL} FROM errs GROUP BY model",
    "long": "UNPIVOT (SELECT * EXCLUDE (samples) FROM wide) ON " + ", ".join(METRIC_NAMES)
            + " INTO NAME metric_name VALUE metric_value",
}


def three_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = ad.predictions(spark, sf_dir).select(WINDOW, ZONE, DEMAND, "by_champion", "by_challenger",
                                                F.col("lag_1").alias("by_newest"))
    return wide.unpivot([WINDOW, ZONE, DEMAND], ["by_champion", "by_challenger", "by_newest"], "model", "predicted")


def _leaderboard_sql(value: str) -> str:
    return sql_over("long_preds", extra=THREE, body=f"""
SELECT model, wins, row_number() OVER (ORDER BY wins DESC, model) = 1 AS is_winner FROM (
  SELECT model, count(*) FILTER (WHERE r = 1) AS wins FROM (
    SELECT model, rank() OVER (PARTITION BY metric_name ORDER BY round(CASE
      WHEN metric_name IN ('r2_score', 'within_5_trips', 'within_10_pct') THEN -metric_value ELSE {value} END, 9)) AS r
    FROM long) GROUP BY model)""")


def _long_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = regression_metrics(three_forecasts(spark, sf_dir))
    return rounded(metric_rows(wide, METRIC_NAMES, ["model"]), 9)


@query("a22_leaderboard", _leaderboard_sql("metric_value"))
def board(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaderboard(_long_metrics(spark, sf_dir))


@query("a22_leaderboard_abs_bias",
       _leaderboard_sql("CASE WHEN metric_name = 'bias' THEN abs(metric_value) ELSE metric_value END"))
def board_abs_bias(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaderboard(_long_metrics(spark, sf_dir), bias="abs")
