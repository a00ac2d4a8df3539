"""Windows, sorts, samples and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from demandlab.catalog import adapters as ad
from demandlab.catalog.adapters import sql_over
from demandlab.catalog.joins import TRAILING_SQL
from demandlab.catalog.registry import query, rounded
from demandlab.catalog.scans import DAILY_SQL, FEATURE_SQL, SAMPLE_ORDER, SAMPLE_TS, daily_checks
from demandlab.operators.cleaning import concat_tables, duplicate_count, keep_first
from demandlab.operators.demand import hour_profile
from demandlab.operators.features import (
    feature_row_counts, gap_report, moving_average, recent_per_zone, with_history_spans,
)
from demandlab.operators.observability import activity_feed, request_rates, trailing_means
from demandlab.operators.sampling import fixed_sample, head
from demandlab.schemas import DEMAND, FEATURES, ROLLING_FEATURES, WINDOW, ZONE, lag_features


@query("w1_lags", sql_over("history", body="""
SELECT pickup_window, PULocationID, lag_1, lag_4, lag_24, lag_96, lag_672 FROM history"""))
def lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad.history(spark, sf_dir).select(WINDOW, ZONE, *lag_features())


@query("w2_w5_rolling", sql_over("history", body="""
SELECT pickup_window, PULocationID, round(rolling_mean_4, 6) AS rolling_mean_4,
  round(rolling_std_4, 6) AS rolling_std_4, rolling_max_24, rolling_min_24 FROM history"""))
def rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ad.history(spark, sf_dir).select(WINDOW, ZONE, *ROLLING_FEATURES))


@query("w6_feature_builder", sql_over("features", body=f"""
SELECT pickup_window, actual_demand, {FEATURE_SQL} FROM features"""))
def feature_builder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ad.features(spark, sf_dir).select(WINDOW, DEMAND, *FEATURES))


@query("w6_feature_builder_spans", sql_over("history", body=f"""
SELECT pickup_window, actual_demand, {FEATURE_SQL} FROM history"""))
def feature_builder_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = with_history_spans(ad.demand(spark, sf_dir), span_days=7)
    return rounded(built.select(WINDOW, DEMAND, *FEATURES))


@query("w6_row_counts", sql_over("history", "features", body="""
SELECT before AS rows_before, after AS rows_after, before - after AS rows_dropped,
  round((before - after) / before * 100, 6) AS dropped_pct
FROM (SELECT (SELECT count(*) FROM history) AS before, (SELECT count(*) FROM features) AS after)"""))
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(feature_row_counts(ad.demand(spark, sf_dir)))


@query("w7_moving_average", sql_over("demand", body="""
SELECT pickup_window, PULocationID, round(avg(actual_demand) OVER (PARTITION BY PULocationID ORDER BY pickup_window
  ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 6) AS moving_average FROM demand"""))
def moving(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = W.partitionBy(ZONE).orderBy(WINDOW)
    return rounded(ad.demand(spark, sf_dir).select(
        WINDOW, ZONE, moving_average(F.col(DEMAND), series, 5).alias("moving_average")))


@query("w8_gap_report", sql_over("demand", body="""
SELECT PULocationID, round(max(step), 6) AS max_gap_minutes, count(step) AS steps FROM (
  SELECT PULocationID, (epoch_us(pickup_window) - lag(epoch_us(pickup_window)) OVER (PARTITION BY PULocationID
  ORDER BY pickup_window)) / 60000000.0 AS step FROM demand) GROUP BY 1"""))
def gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(gap_report(ad.demand(spark, sf_dir)))


@query("w9_trailing_means", sql_over("plog", body=TRAILING_SQL.format(src="plog")))
def trailing_prediction_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = ad.prediction_log(spark, sf_dir)
    return rounded(trailing_means(log, "timestamp", "predicted_demand", ["location_id"]))


SLIDING = {
    "minutes": "SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS m, endpoint, status, latency_seconds FROM requests",
    "slid": """SELECT m - to_minutes(CAST(i AS INTEGER)) AS window_start,
    m - to_minutes(CAST(i AS INTEGER)) + INTERVAL 5 MINUTE AS window_end, endpoint, status, latency_seconds
    FROM minutes, range(5) AS r(i)""",
}


@query("w10_request_rates", sql_over("requests", extra=SLIDING, body="""
SELECT window_start, window_end, endpoint, status, count(*) AS requests, round(count(*) / 300.0, 6) AS per_second
FROM slid GROUP BY 1, 2, 3, 4"""))
def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(request_rates(ad.requests(spark, sf_dir), "ts", ["endpoint", "status"]))


@query("o1_ordered_demand", sql_over("demand", body="""
SELECT PULocationID, pickup_window, actual_demand FROM demand ORDER BY PULocationID, pickup_window"""))
def ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad.demand(spark, sf_dir).select(ZONE, WINDOW, DEMAND).orderBy(ZONE, WINDOW)


@query("o2_head", sql_over("demand", body="""
SELECT pickup_window, PULocationID, actual_demand FROM demand ORDER BY pickup_window, PULocationID LIMIT 100"""))
def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return head(ad.demand(spark, sf_dir).select(WINDOW, ZONE, DEMAND), 100, WINDOW, ZONE)


@query("o3_top_zone", sql_over("demand", body="""
SELECT PULocationID, count(*) AS slot_count FROM demand WHERE hour = 9 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1"""))
def top_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    nine = hour_profile(ad.demand(spark, sf_dir)).filter(F.col("hour") == 9)
    return head(nine.select(ZONE, "slot_count"), 1, F.desc("slot_count"), ZONE)


@query("o4_latest_rows", sql_over("preds", body="""
SELECT pickup_window, PULocationID, actual_demand, round(by_challenger, 6) AS by_challenger FROM preds
ORDER BY pickup_window DESC, PULocationID LIMIT 20"""))
def latest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ad.predictions(spark, sf_dir).select(WINDOW, ZONE, DEMAND, "by_challenger")
    return rounded(head(rows, 20, F.desc(WINDOW), ZONE))


@query("o5_recent_per_zone", sql_over("demand", body="""
SELECT pickup_window, PULocationID, actual_demand FROM demand
QUALIFY row_number() OVER (PARTITION BY PULocationID ORDER BY pickup_window DESC) <= 50"""))
def recent_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recent_per_zone(ad.demand(spark, sf_dir).select(WINDOW, ZONE, DEMAND), 50)


@query("o6_reverse_listing", sql_over("requests", body="""
SELECT strftime(ts, '%H:%M:%S') AS time, event_id, round(value, 2) AS value FROM requests ORDER BY ts DESC"""))
def reverse_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest_first = ad.requests(spark, sf_dir).orderBy(F.desc("ts"), F.desc("event_id"))
    return newest_first.select(F.date_format("ts", "HH:mm:ss").alias("time"), "event_id",
                               F.round("value", 2).alias("value"))


@query("o7_fixed_sample", sql_over("demand", body=f"""
SELECT pickup_window, PULocationID, actual_demand FROM demand {SAMPLE_ORDER.format(ts=SAMPLE_TS)} LIMIT 1000"""))
def sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ad.demand(spark, sf_dir).select(WINDOW, ZONE, DEMAND)
    return fixed_sample(rows, 1000, [ZONE, WINDOW])


@query("u1_concatenated", """SELECT event_type, count(*) AS n, count(note) AS notes FROM (
SELECT event_type, NULL AS note FROM events WHERE event_id % 2 = 0
UNION ALL SELECT event_type, 'odd' FROM events WHERE event_id % 2 = 1) GROUP BY 1""")
def concatenated(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ad.events(spark, sf_dir).select("event_id", "event_type")
    even = rows.filter(F.col("event_id") % 2 == 0)
    odd = rows.filter(F.col("event_id") % 2 == 1).withColumn("note", F.lit("odd"))
    return concat_tables([even, odd]).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.count("note").alias("notes"))


@query("u2_activity_feed", sql_over("requests", extra=DAILY_SQL, body="""
SELECT substr(timestamp, 1, 19) AS time, 'Continual Learning' AS type,
  CASE WHEN bad * 5 > n THEN 'success_deployed' ELSE 'success_no_retrain' END AS status,
  CASE WHEN bad * 5 > n THEN 'retrain_triggered, model_retrained' ELSE '' END AS actions
FROM (SELECT * FROM checks ORDER BY timestamp DESC LIMIT 3)
UNION ALL SELECT substr(timestamp, 1, 19), 'Drift Detection', CASE WHEN bad > 60 THEN 'Drift Detected' ELSE 'No Drift' END,
  bad || ' features drifted' FROM (SELECT * FROM checks ORDER BY timestamp DESC LIMIT 3)"""))
def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = daily_checks(spark, sf_dir)
    drift = checks.select("timestamp", (F.col("bad") > 60).alias("drift_detected"),
                          F.col("bad").alias("drifted_features"))
    return activity_feed(checks, drift)


@query("u3_duplicate_count", sql_over("ev", body="""
SELECT CAST(sum(n - 1) AS BIGINT) AS duplicate_rows FROM (
  SELECT count(*) AS n FROM ev GROUP BY time_bucket(INTERVAL 15 MINUTE, ts), PULocationID)"""))
def duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ad.events(spark, sf_dir).withColumn(WINDOW, ad.floor_minutes("ts"))
    return duplicate_count(rows, [WINDOW, ZONE])


@query("u3_keep_first", sql_over("ev", body="""
SELECT pickup_window, PULocationID, event_id, value FROM (
  SELECT *, time_bucket(INTERVAL 15 MINUTE, ts) AS pickup_window FROM ev)
QUALIFY row_number() OVER (PARTITION BY pickup_window, PULocationID ORDER BY ts, event_id) = 1"""))
def first_of_each(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ad.events(spark, sf_dir).select(
        ad.floor_minutes("ts").alias(WINDOW), ZONE, "event_id", "value", "ts")
    return keep_first(rows, [WINDOW, ZONE], ["ts", "event_id"]).drop("ts")
