"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandlab.catalog import adapters as ad
from demandlab.catalog.adapters import sql_over
from demandlab.catalog.registry import query, rounded
from demandlab.operators.drift import feature_drift, drift_report
from demandlab.operators.metrics import METRIC_NAMES, regression_metrics
from demandlab.plans.drift_check import production_rows, range_rows, reference_rows, window_index
from demandlab.schemas import (
    API_LOG, CHECK_REPORT, DEMAND, DRIFT_REPORT, FEATURES, METRIC_LOG, MODEL_REGISTRY, PREDICTION_LOG, WINDOW, ZONE, table,
    DBL, INT, NTZ, STR, TRIPS,
)
from demandlab.session import scratch_path
from demandlab.sources.logs import api_log_rows, append_log, metric_log
from demandlab.sources.reports import append_report, newest_reports, read_registry
from demandlab.sources.trips import (
    between, check_columns, contract_counts, read_directory, read_table, read_trips, write_csv, write_table,
)

FEATURE_SQL = ", ".join(
    f"round({f}, 6) AS {f}" if f.startswith(("lag", "rolling")) else f for f in FEATURES)


@query("s1_projected_scan", "SELECT ts, event_type, value FROM events")
def projected_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = table(ts=NTZ, event_type=STR, value=DBL)
    return read_table(spark, f"{sf_dir}/events.parquet", wanted)


@query("s2_directory_scan", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def directory_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = read_directory(spark, sf_dir, "events.parquet", ad.EVENTS)
    return found.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


# Events written as two monthly trip files; the second holds events of odd users moved 20 days on,
# so it also contains rows of the wrong month.
MONTHLY_SQL = {
    "monthly": """SELECT * FROM trips UNION ALL
    SELECT ts + INTERVAL 20 DAY, ts + INTERVAL 20 DAY + to_microseconds(CAST(round(value * 60000000) AS BIGINT)),
    PULocationID, k, 2 FROM ev WHERE user_id % 2 = 1"""
}


def monthly_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "monthly-trips")
    rows = ad.events(spark, sf_dir)
    moved = rows.filter(F.col("user_id") % 2 == 1).withColumn("ts", F.col("ts") + F.make_dt_interval(F.lit(20)))
    names = [f"{folder}/trips_2024-01.parquet", f"{folder}/trips_2024-02.parquet"]
    for name, part in zip(names, (rows, moved)):
        write_table(ad.as_trips(part).select(TRIPS.fieldNames()), name)
    return read_trips(spark, names)


@query("s3_file_month", sql_over("trips", extra=MONTHLY_SQL, body="""
SELECT expected_month, count(*) AS n, min(tpep_pickup_datetime) AS first_pickup FROM monthly GROUP BY 1"""))
def file_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_trips(spark, sf_dir).groupBy("expected_month").agg(
        F.count(F.lit(1)).alias("n"), F.min("tpep_pickup_datetime").alias("first_pickup"))


@query("s4_table_contract", sql_over("ev", body="""
SELECT count(*) AS total_rows, count(*) FILTER (WHERE PULocationID IS NULL) AS null_PULocationID,
  count(*) FILTER (WHERE ts IS NULL) AS null_ts,
  count(*) FILTER (WHERE props IS NOT NULL AND TRY_CAST(props AS DOUBLE) IS NULL) AS bad_props,
  count(*) FILTER (WHERE value IS NOT NULL AND TRY_CAST(value AS INTEGER) IS NULL) AS bad_value FROM ev"""))
def table_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ad.events(spark, sf_dir)
    check_columns(rows, ["ts", "event_type", "value"])
    return contract_counts(rows, [ZONE, "ts"], {"props": "double", "value": "int"})


SAMPLE_ORDER = "ORDER BY md5(concat_ws('|', '42', CAST(PULocationID AS VARCHAR), {ts})), PULocationID, pickup_window"
SAMPLE_TS = "strftime(pickup_window, '%Y-%m-%d %H:%M:%S')"


@query("s5_reference_sample", sql_over("features", body=f"""
SELECT {FEATURE_SQL} FROM (SELECT * FROM features {SAMPLE_ORDER.format(ts=SAMPLE_TS)} LIMIT 2000)"""))
def reference_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reference_rows(ad.demand(spark, sf_dir), sample_size=2000))


@query("s6_production_window", sql_over("features", body=f"""
SELECT {FEATURE_SQL} FROM features
WHERE pickup_window >= (SELECT max(pickup_window) FROM features) - INTERVAL 7 DAY"""))
def production_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(production_rows(ad.demand(spark, sf_dir), days_back=7))


@query("s7_date_range", sql_over("demand", body="""
SELECT pickup_window, PULocationID, actual_demand FROM demand
WHERE pickup_window BETWEEN TIMESTAMP '2024-01-08' AND TIMESTAMP '2024-01-14'"""))
def date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = between(ad.demand(spark, sf_dir), "2024-01-08", "2024-01-14")
    return found.select(WINDOW, ZONE, DEMAND)


def daily_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One check report per day of the events."""
    day = F.date_format("ts", "yyyy-MM-dd")
    per_day = ad.requests(spark, sf_dir).groupBy(day.alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == "error").alias("bad"))
    retrained = F.col("bad") * 5 > F.col("n")
    return per_day.select(
        F.concat("day", F.lit("T06:00:00.123")).alias("timestamp"),
        F.when(retrained, "success_deployed").otherwise("success_no_retrain").alias("status"),
        F.when(retrained, F.array(F.lit("retrain_triggered"), F.lit("model_retrained")))
        .otherwise(F.array().cast("array<string>")).alias("actions_taken"),
        F.col("n").alias("production_data_records"), "day", "bad",
    )


DAILY_SQL = {
    "checks": """SELECT strftime(ts, '%Y-%m-%d') || 'T06:00:00.123' AS timestamp, count(*) AS n,
    count(*) FILTER (WHERE status = 'error') AS bad FROM requests GROUP BY strftime(ts, '%Y-%m-%d')"""
}


@query("s8_newest_reports", sql_over("requests", extra=DAILY_SQL, body="""
SELECT timestamp, CASE WHEN bad * 5 > n THEN 'success_deployed' ELSE 'success_no_retrain' END AS status,
  CASE WHEN bad * 5 > n THEN 'retrain_triggered, model_retrained' ELSE '' END AS actions,
  n AS production_data_records FROM checks ORDER BY timestamp DESC LIMIT 10"""))
def newest_check_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "check-reports")
    daily_checks(spark, sf_dir).withColumn("run_at", F.col("day")).write.partitionBy("run_at").json(folder)
    newest = newest_reports(spark, folder, CHECK_REPORT)
    return newest.select("timestamp", "status", F.array_join("actions_taken", ", ").alias("actions"),
                         "production_data_records")


def weekly_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry with one version per week of predictions, as the lifecycle would leave it."""
    week = F.weekofyear(WINDOW)
    e = F.col("by_challenger") - F.col(DEMAND)
    per_week = ad.predictions(spark, sf_dir).groupBy(week.alias("week")).agg(
        F.round(F.avg(F.abs(e)), 6).alias("mae"), F.round(F.sqrt(F.avg(e * e)), 6).alias("rmse"),
        F.count(F.lit(1)).alias("n"))
    nothing = F.lit(None).cast("double")
    return per_week.select(
        F.concat(F.lit("v"), F.col("week").cast("string")).alias("version"),
        F.concat(F.lit("2024-02-0"), F.col("week").cast("string"), F.lit("T10:30:00")).alias("trained_at"),
        F.concat(F.lit("models/v"), F.col("week").cast("string")).alias("model_path"),
        F.struct("mae", "rmse", nothing.alias("r2"), nothing.alias("mape")).alias("performance"),
        F.struct(F.lit("2024-01-01").alias("start_date"), F.lit("2024-01-30").alias("end_date"),
                 F.col("n").alias("n_samples")).alias("training_data"),
        (F.col("week") == 5).alias("is_deployed"), F.lit(None).cast("string").alias("deployed_at"),
    )


REGISTRY_SQL = {
    "registry": """SELECT 'v' || week(pickup_window) AS version,
    '2024-02-0' || week(pickup_window) || 'T10:30:00' AS trained_at,
    round(avg(abs(by_challenger - actual_demand)), 6) AS mae,
    round(sqrt(avg((by_challenger - actual_demand) * (by_challenger - actual_demand))), 6) AS rmse,
    count(*) AS n_samples, week(pickup_window) = 5 AS is_deployed
    FROM preds GROUP BY week(pickup_window)"""
}


def stored_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weekly registry after a round trip through JSON files, one object per file."""
    folder = scratch_path(spark, "registry")
    weekly = weekly_registry(spark, sf_dir)
    weekly.withColumn("part", F.col("version")).write.partitionBy("part").json(folder)
    return read_registry(spark, folder).select(MODEL_REGISTRY.fieldNames())


@query("s9_model_registry", sql_over("preds", extra=REGISTRY_SQL, body="""
SELECT version, trained_at, mae, rmse, n_samples, is_deployed FROM registry"""))
def model_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_registry(spark, sf_dir).select(
        "version", "trained_at", F.col("performance.mae").alias("mae"), F.col("performance.rmse").alias("rmse"),
        F.col("training_data.n_samples").alias("n_samples"), "is_deployed")


@query("s10_parquet_sink", sql_over("demand", body="""
SELECT pickup_window, PULocationID, actual_demand, hour, day_of_week, month FROM demand"""))
def parquet_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "demand")
    write_table(ad.demand(spark, sf_dir), path, ["month"])
    return spark.read.parquet(path).select(WINDOW, ZONE, DEMAND, "hour", "day_of_week", "month")


@query("s11_json_report_sink", sql_over("prod", "ref", body="""
SELECT '2024-02-01 00:00:00' AS timestamp, CAST(20 AS BIGINT) AS total_features, 20 AS detail_rows,
  (SELECT count(*) FROM prod) AS production_data_size"""))
def json_report_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "drift-reports")
    reference, production = ad.reference_and_production(spark, sf_dir)
    size = production.agg(F.count(F.lit(1)).alias("n")).scalar()
    report = drift_report(feature_drift(reference, production), F.lit("2024-02-01 00:00:00"), size)
    append_report(report, path, "20240201_000000")
    stored = newest_reports(spark, path, DRIFT_REPORT, 1)
    return stored.select("timestamp", F.col("summary.total_features").alias("total_features"),
                         F.size("feature_drift").alias("detail_rows"), "production_data_size")


HISTORY_CSV = table(pickup_window=NTZ, PULocationID=INT, predicted=DBL)


@query("s12_csv_export", sql_over("preds", body="""
SELECT pickup_window, PULocationID, round(by_challenger, 2) AS predicted FROM preds"""))
def csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "history-csv")
    rows = ad.predictions(spark, sf_dir).select(WINDOW, ZONE, F.round("by_challenger", 2).alias("predicted"))
    write_csv(rows, path)
    return spark.read.schema(HISTORY_CSV).option("header", True).csv(path)


@query("s13_log_tables", sql_over("plog", body="""
SELECT model_version, endpoint, count(*) AS n, count(actual_demand) AS with_actual, count(*) AS with_id,
  min(created_at) AS first_created, count(DISTINCT CAST(timestamp AS DATE)) AS days FROM plog GROUP BY 1, 2"""))
def log_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "prediction-log")
    append_log(ad.prediction_log(spark, sf_dir), path, PREDICTION_LOG)
    stored = spark.read.schema(T.StructType(PREDICTION_LOG.fields).add("log_date", "date")).parquet(path)
    return stored.groupBy("model_version", "endpoint").agg(
        F.count(F.lit(1)).alias("n"), F.count("actual_demand").alias("with_actual"), F.count("id").alias("with_id"),
        F.min("created_at").alias("first_created"), F.count_distinct("log_date").alias("days"))


@query("s13_log_ids", sql_over("plog", body="""
SELECT count(*) AS rows_logged, count(*) AS distinct_ids, CASE WHEN count(*) > 0 THEN CAST(1 AS BIGINT) END AS first_id,
  nullif(count(*), 0) AS last_id FROM plog"""))
def log_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, rows = scratch_path(spark, "prediction-log"), ad.prediction_log(spark, sf_dir)
    # Two appends, the first of them repeated.
    for endpoint in ("single", "batch", "single"):
        append_log(rows.filter(F.col("endpoint") == endpoint), path, PREDICTION_LOG, append_id=endpoint)
    stored = spark.read.schema(PREDICTION_LOG).parquet(path)
    return stored.agg(F.count(F.lit(1)).alias("rows_logged"), F.count_distinct("id").alias("distinct_ids"),
                      F.min("id").alias("first_id"), F.max("id").alias("last_id"))


@query("s13_api_log", sql_over("requests", body="""
SELECT endpoint, CASE WHEN status = 'success' THEN 200 ELSE 500 END AS status_code, count(*) AS n, count(*) AS with_id,
  count(*) FILTER (WHERE status <> 'success') AS with_message, round(max(latency_seconds) * 1000, 6) AS max_latency_ms,
  min(ts) AS first_at FROM requests GROUP BY 1, 2"""))
def api_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "api-log")
    append_log(api_log_rows(ad.requests(spark, sf_dir)), path, API_LOG)
    return rounded(spark.read.schema(API_LOG).parquet(path).groupBy("endpoint", "status_code").agg(
        F.count(F.lit(1)).alias("n"), F.count("id").alias("with_id"), F.count("error_message").alias("with_message"),
        F.max("latency_ms").alias("max_latency_ms"), F.min("timestamp").alias("first_at")))


@query("s7_bounded_range", sql_over("features", body=f"""
SELECT pickup_window, {FEATURE_SQL} FROM features
WHERE pickup_window >= TIMESTAMP '2024-01-27' AND pickup_window <= TIMESTAMP '2024-01-30'"""))
def bounded_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    index, rows = scratch_path(spark, "window-index"), ad.demand(spark, sf_dir)
    window_index(rows).write.parquet(index)
    found = range_rows(rows, "2024-01-27", "2024-01-30", index=spark.read.parquet(index))
    return rounded(found.select(WINDOW, *FEATURES))


METRICS_SQL = """sqrt(avg(e * e)) AS rmse, avg(abs(e)) AS mae,
    avg(abs(e) / greatest(abs(y), 2.220446049250313e-16)) * 100 AS mape,
    1 - sum(e * e) / (var_pop(y) * count(*)) AS r2_score, median(abs(e)) AS median_ae, avg(e) AS bias,
    max(abs(e)) AS max_error, avg(CASE WHEN abs(e) <= 5 THEN 1.0 ELSE 0.0 END) * 100 AS within_5_trips,
    avg(CASE WHEN abs(e / (y + 1e-8)) <= 0.1 THEN 1.0 ELSE 0.0 END) * 100 AS within_10_pct, count(*) AS samples"""

LONG_ERRORS = {
    "errs": """SELECT model, CAST(actual_demand AS DOUBLE) AS y, CAST(predicted - actual_demand AS DOUBLE) AS e
    FROM long_preds"""
}


@query("s14_metric_log", sql_over("long_preds", extra={
    **LONG_ERRORS,
    "wide": f"SELECT {METRICS_SQL} FROM errs WHERE model = 'by_challenger'",
    "long": "UNPIVOT wide ON " + ", ".join(METRIC_NAMES) + " INTO NAME metric_name VALUE metric_value",
}, body="""SELECT metric_name, round(metric_value, 6) AS metric_value, 'v1' AS model_version,
  'last_7_days' AS data_window, TIMESTAMP '2024-02-01' AS timestamp FROM long"""))
def metric_logging(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = ad.long_predictions(spark, sf_dir).filter(F.col("model") == "by_challenger")
    rows = metric_log(regression_metrics(one), METRIC_NAMES, F.lit("2024-02-01").cast("timestamp_ntz"), "last_7_days")
    assert rows.columns == METRIC_LOG.fieldNames()
    return rounded(rows.select("metric_name", "metric_value", "model_version", "data_window", "timestamp"))
