"""Projections, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlab.catalog import adapters as ad
from demandlab.catalog.adapters import sql_over
from demandlab.catalog.registry import query, rounded
from demandlab.catalog.scans import MONTHLY_SQL, monthly_trips
from demandlab.functions import calendar as cal
from demandlab.functions import numeric as num
from demandlab.functions.documents import as_json, join_reasons, texts_if
from demandlab.operators.cleaning import (
    clean_trips, in_month, in_year, plausible_duration, positive_distance, with_duration,
)
from demandlab.operators.geo import demand_tier, heat_points, only_zones, prediction_tier, with_zone, zone_layer
from demandlab.operators.quality import validated_requests
from demandlab.schemas import COMPARISON_FEATURES, DEMAND, NAMED_ZONES, REQUEST_RANGES, WINDOW, ZONE
from demandlab.sources.trips import trailing

ZONES_SQL = "SELECT * FROM (VALUES " + ", ".join(
    f"({z}, CAST({lat} AS DOUBLE), CAST({lon} AS DOUBLE), '{name}')" for z, lat, lon, name in NAMED_ZONES
) + ") AS t(PULocationID, lat, lon, name)"
ZONES = {"zones": ZONES_SQL}


@query("p1_year_filter", """SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total
FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 1""")
def year_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ad.orders(spark, sf_dir).filter(in_year(1997, "o_orderdate"))
    return rounded(rows.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total")), 2)


@query("p2_month_filter", sql_over("trips", extra=MONTHLY_SQL, body="""
SELECT expected_month, count(*) AS n FROM monthly WHERE month(tpep_pickup_datetime) = expected_month GROUP BY 1"""))
def month_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = monthly_trips(spark, sf_dir).filter(in_month())
    return kept.groupBy("expected_month").agg(F.count(F.lit(1)).alias("n"))


@query("p3_distance_rule", sql_over("trips", body="""
SELECT tpep_pickup_datetime, PULocationID, trip_distance FROM trips WHERE trip_distance > 0"""))
def distance_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = ad.trips(spark, sf_dir).filter(positive_distance())
    return kept.select("tpep_pickup_datetime", ZONE, "trip_distance")


@query("p4_duration_rule", sql_over("trips", body="""
SELECT * FROM (SELECT tpep_pickup_datetime, tpep_dropoff_datetime,
  round((epoch_us(tpep_dropoff_datetime) - epoch_us(tpep_pickup_datetime)) / 60000000.0, 6) AS duration_minutes
  FROM trips) WHERE duration_minutes > 1 AND duration_minutes < 300"""))
def duration_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = with_duration(ad.trips(spark, sf_dir)).filter(plausible_duration())
    return rounded(kept.select("tpep_pickup_datetime", "tpep_dropoff_datetime", "duration_minutes"))


@query("p4_clean_trips", sql_over("trips", extra=MONTHLY_SQL, body="""
SELECT expected_month, tpep_pickup_datetime, PULocationID, trip_distance FROM monthly
WHERE year(tpep_pickup_datetime) = 2024 AND month(tpep_pickup_datetime) = expected_month AND trip_distance > 0
AND epoch_us(tpep_dropoff_datetime) - epoch_us(tpep_pickup_datetime) > 60000000
AND epoch_us(tpep_dropoff_datetime) - epoch_us(tpep_pickup_datetime) < 18000000000"""))
def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = clean_trips(monthly_trips(spark, sf_dir), 2024)
    return kept.select("expected_month", "tpep_pickup_datetime", ZONE, "trip_distance")


@query("p5_feature_projection", sql_over("features", body="""
SELECT PULocationID, hour, day_of_week, month, lag_1, lag_4, lag_96, round(rolling_mean_4, 6) AS rolling_mean_4
FROM features"""))
def feature_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ad.features(spark, sf_dir).select(COMPARISON_FEATURES))


@query("p6_casts", """SELECT CAST(strftime(ts, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS ts,
CAST(user_id AS INTEGER) AS user_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return ad.events(spark, sf_dir).select(
        F.to_timestamp_ntz(text).alias("ts"), F.col("user_id").cast("int"),
        F.get_json_object("props", "$.k").cast("int").alias("k"))


@query("p7_drop_nulls", sql_over("history", body="""
SELECT PULocationID, count(*) AS kept FROM history WHERE lag_96 IS NOT NULL AND rolling_std_4 IS NOT NULL GROUP BY 1"""))
def drop_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = ad.history(spark, sf_dir).na.drop(subset=["lag_96", "rolling_std_4"])
    return kept.groupBy(ZONE).agg(F.count(F.lit(1)).alias("kept"))


@query("p8_trailing_window", sql_over("demand", body="""
SELECT 24 AS hours, pickup_window, PULocationID, actual_demand FROM demand
  WHERE pickup_window >= (SELECT max(pickup_window) FROM demand) - INTERVAL 24 HOUR
UNION ALL SELECT 48, pickup_window, PULocationID, actual_demand FROM demand
  WHERE pickup_window >= (SELECT max(pickup_window) FROM demand) - INTERVAL 48 HOUR
UNION ALL SELECT 168, pickup_window, PULocationID, actual_demand FROM demand
  WHERE pickup_window >= (SELECT max(pickup_window) FROM demand) - INTERVAL 168 HOUR"""))
def trailing_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ad.demand(spark, sf_dir)
    spans = [trailing(rows, hours=h).select(F.lit(h).alias("hours"), WINDOW, ZONE, DEMAND) for h in (24, 48, 168)]
    return spans[0].unionByName(spans[1]).unionByName(spans[2])


@query("p9_membership", sql_over("demand", body="""
SELECT pickup_window, PULocationID, actual_demand FROM demand WHERE PULocationID IN (237, 211, 161)"""))
def membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return only_zones(ad.demand(spark, sf_dir), [237, 211, 161]).select(WINDOW, ZONE, DEMAND)


@query("p10_non_negative", "SELECT event_id, round(greatest(0.0, value - 50), 6) AS clamped FROM events")
def clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ad.events(spark, sf_dir)
    return rounded(rows.select("event_id", num.non_negative(F.col("value") - 50).alias("clamped")))


@query("p11_tiers", """SELECT event_id,
CASE WHEN value > 500 THEN 'red' WHEN value > 200 THEN 'orange' WHEN value > 50 THEN 'blue' ELSE 'gray' END AS tier,
CASE WHEN value > 20 THEN 'red' WHEN value > 10 THEN 'orange' ELSE 'blue' END AS prediction_tier FROM events""")
def tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("value")
    return ad.events(spark, sf_dir).select(
        "event_id", demand_tier(v).alias("tier"), prediction_tier(v).alias("prediction_tier"))


@query("p12_heat_weights", sql_over("demand", extra=ZONES, body="""
SELECT PULocationID, lat, lon, round(total / 100.0, 6) AS weight FROM
  (SELECT PULocationID, CAST(sum(actual_demand) AS DOUBLE) AS total FROM demand WHERE hour = 9 GROUP BY 1)
JOIN zones USING (PULocationID) WHERE total > 0"""))
def heat_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    at_nine = ad.demand(spark, sf_dir).filter(F.col("hour") == 9)
    return rounded(heat_points(zone_layer(at_nine, DEMAND), DEMAND))


@query("p13_display", sql_over("preds", body="""
SELECT pickup_window AS "Time", PULocationID AS "Location", round(CAST(actual_demand AS DOUBLE), 1) AS "Actual",
  round(by_challenger, 1) AS "Predicted", round(actual_demand - by_challenger, 2) AS "Error" FROM preds"""))
def display(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad.predictions(spark, sf_dir).select(
        F.col(WINDOW).alias("Time"), F.col(ZONE).alias("Location"),
        F.round(F.col(DEMAND).cast("double"), 1).alias("Actual"), F.round("by_challenger", 1).alias("Predicted"),
        F.round(F.col(DEMAND) - F.col("by_challenger"), 2).alias("Error"))


def _request_checks_sql() -> str:
    parts = []
    for name, (low, high) in REQUEST_RANGES.items():
        text = "inf" if high is None else high
        outside = f"{name} < {low}" + ("" if high is None else f" OR {name} > {high}")
        parts.append(f"CASE WHEN {name} IS NULL THEN '{name}: missing' END")
        parts.append(f"CASE WHEN {outside} THEN '{name}: not in [{low}, {text}]' END")
    return "concat_ws(' | ', " + ", ".join(parts) + ")"


@query("p14_request_validation", sql_over("quality", body=f"""
SELECT event_id, {_request_checks_sql()} AS messages FROM quality"""))
def request_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = validated_requests(ad.quality_rows(spark, sf_dir))
    return checked.select("event_id", F.array_join("errors", " | ").alias("messages"))


@query("f1_floor", """SELECT event_id, time_bucket(INTERVAL 15 MINUTE, ts) AS quarter,
date_trunc('hour', ts) AS hour_start FROM events""")
def floors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ad.events(spark, sf_dir).withColumn("quarter", cal.floor_minutes("ts", 15))
    return rows.withColumn("hour_start", cal.floor_hour("ts")).select("event_id", "quarter", "hour_start")


@query("f2_f10_calendar", """SELECT o_orderkey, CAST(hour(o_orderdate) AS INTEGER) AS hour,
CAST(month(o_orderdate) AS INTEGER) AS month, CAST(year(o_orderdate) AS INTEGER) AS year,
CAST(day(o_orderdate) AS INTEGER) AS day_of_month, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS day_of_week,
CAST(week(o_orderdate) AS INTEGER) AS week_of_year, CAST(isodow(o_orderdate) >= 6 AS INTEGER) AS is_weekend,
CAST((month(o_orderdate) % 12) // 3 AS INTEGER) AS season,
CAST(date_trunc('month', o_orderdate) AS DATE) AS year_month FROM orders""")
def calendar_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("o_orderdate")
    return ad.orders(spark, sf_dir).select(
        "o_orderkey", F.hour(d).alias("hour"), F.month(d).alias("month"), F.year(d).alias("year"),
        F.dayofmonth(d).alias("day_of_month"), cal.day_of_week(d).alias("day_of_week"),
        cal.iso_week(d).alias("week_of_year"), cal.is_weekend(F.weekday(d)).alias("is_weekend"),
        cal.season(F.month(d)).alias("season"), cal.month_start(d).alias("year_month"))


@query("f6_f9_flags", sql_over("history", body="""
SELECT pickup_window, PULocationID, is_weekend, is_rush_hour, time_of_day, is_manhattan FROM history"""))
def flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ad.demand(spark, sf_dir).withColumns(cal.calendar_columns())
    return rows.select(WINDOW, ZONE, "is_weekend", "is_rush_hour", "time_of_day", "is_manhattan")


@query("f11_time_differences", sql_over("trips", body="""
SELECT tpep_pickup_datetime, tpep_dropoff_datetime,
  round((epoch_us(tpep_dropoff_datetime) - epoch_us(tpep_pickup_datetime)) / 1000000.0, 6) AS seconds,
  round((epoch_us(tpep_dropoff_datetime) - epoch_us(tpep_pickup_datetime)) / 60000000.0, 6) AS minutes FROM trips"""))
def time_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = "tpep_pickup_datetime", "tpep_dropoff_datetime"
    return rounded(ad.trips(spark, sf_dir).select(
        a, b, cal.seconds_between(a, b).alias("seconds"), cal.minutes_between(a, b).alias("minutes")))


@query("f12_f15_numeric", sql_over("preds", body="""
SELECT pickup_window, PULocationID, round(abs(e), 6) AS abs_error, round(e * e, 6) AS squared,
  round(sqrt(abs(e)), 6) AS root, round(CASE WHEN e > 0 THEN ln(e) END, 6) AS log_error,
  round((by_challenger - y) / y * 100, 6) AS change_pct, round(abs(e / (y + 1e-8)), 6) AS pct_8,
  round(abs(e / (y + 1e-10)), 6) AS pct_10,
  round(abs(e) / greatest(abs(y), 2.220446049250313e-16), 6) AS pct_floor,
  round(abs((lag_1 - 15.0) / 10.0), 6) AS z, (e / (y + 1e-10)) < 'inf'::DOUBLE AS finite
FROM (SELECT *, CAST(actual_demand AS DOUBLE) AS y, by_challenger - actual_demand AS e FROM preds)"""))
def numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    y, p = F.col(DEMAND).cast("double"), F.col("by_challenger")
    e = p - y
    return rounded(ad.predictions(spark, sf_dir).select(
        WINDOW, ZONE, F.abs(e).alias("abs_error"), (e * e).alias("squared"), F.sqrt(F.abs(e)).alias("root"),
        F.when(e > 0, F.ln(e)).alias("log_error"), num.percent_change(p, y).alias("change_pct"),
        num.percent_error(e, y, 1e-8).alias("pct_8"), num.percent_error(e, y, 1e-10).alias("pct_10"),
        num.percent_error(e, y, 2.220446049250313e-16, "floor").alias("pct_floor"),
        num.z_score(F.col("lag_1"), 15.0, 10.0).alias("z"),
        num.is_finite(e / (y + 1e-10)).alias("finite")))


@query("f16_f21_text", """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M') AS minute_text,
strftime(ts, '%H:%M:%S') AS clock, regexp_extract(props, '"k": (\\d+)', 1) AS captured,
CASE WHEN concat_ws(' | ', CASE WHEN value > 50 THEN 'large' END, CASE WHEN event_type = 'error' THEN 'failed' END) = ''
  THEN 'All checks passed'
  ELSE concat_ws(' | ', CASE WHEN value > 50 THEN 'large' END, CASE WHEN event_type = 'error' THEN 'failed' END) END
  AS reasons,
CAST((value > 50)::INTEGER + (event_type = 'error')::INTEGER AS INTEGER) AS reason_count,
event_type = 'error' AS has_failed,
CAST(coalesce(json_extract_string(props, '$.missing'), '0') AS INTEGER) AS nested_default,
'{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' AS as_json FROM events""")
def text(spark: SparkSession, sf_dir: str) -> DataFrame:
    large, failed = F.col("value") > 50, F.col("event_type") == "error"
    parsed = F.from_json("props", "k int, missing int")
    found = texts_if([(large, F.lit("large")), (failed, F.lit("failed"))])
    return ad.events(spark, sf_dir).select(
        "event_id", cal.minute_text("ts").alias("minute_text"), cal.clock_text("ts").alias("clock"),
        F.regexp_extract("props", r'"k": (\d+)', 1).alias("captured"),
        join_reasons(F.when(large, F.lit("large")), F.when(failed, F.lit("failed")), default="All checks passed")
        .alias("reasons"),
        F.size(found).alias("reason_count"), F.array_contains(found, "failed").alias("has_failed"),
        F.coalesce(parsed["missing"], F.lit(0)).alias("nested_default"),
        as_json("event_id", "event_type").alias("as_json"))


@query("f22_request_features", sql_over("ev", body="""
SELECT event_id, PULocationID, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
  CAST(month(ts) AS INTEGER) AS month, CAST(isodow(ts) >= 6 AS INTEGER) AS is_weekend,
  CAST(hour(ts) IN (7, 8, 9, 17, 18, 19) AS INTEGER) AS is_rush_hour, CAST(day(ts) AS INTEGER) AS day_of_month,
  CAST(week(ts) AS INTEGER) AS week_of_year,
  CASE WHEN hour(ts) <= 6 THEN 0 WHEN hour(ts) <= 12 THEN 1 WHEN hour(ts) <= 18 THEN 2 ELSE 3 END AS time_of_day,
  CAST((month(ts) % 12) // 3 AS INTEGER) AS season, CAST(PULocationID IN (4, 161, 237) AS INTEGER) AS is_manhattan
FROM ev"""))
def history_free_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cal.request_features(ad.events(spark, sf_dir), "ts")
    return rows.drop("ts", "user_id", "event_type", "value", "props")


@query("p13_zone_display", sql_over("demand", extra=ZONES, body="""
SELECT pickup_window, PULocationID, actual_demand, name FROM demand JOIN zones USING (PULocationID)"""))
def zone_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_zone(ad.demand(spark, sf_dir)).select(WINDOW, ZONE, DEMAND, "name")
