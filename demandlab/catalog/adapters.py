"""The given tables seen as trips, demand, features, predictions and requests.

Each adapter exists twice: as a DataFrame and as a SQL common table expression
with the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlab.functions.calendar import floor_minutes, with_window_parts
from demandlab.operators.demand import build_demand
from demandlab.operators.features import build_features, with_history
from demandlab.schemas import (
    DEMAND, DBL, LAGS, LONG, MANHATTAN_ZONES, NTZ, PREDICTION_LOG, STR, WINDOW, ZONE, table,
)
from demandlab.sources.logs import with_log_defaults
from demandlab.sources.trips import read_table

EVENTS = table(event_id=LONG, ts=NTZ, user_id=LONG, event_type=STR, value=DBL, props=STR)
ORDERS = table(o_orderkey=LONG, o_custkey=LONG, o_orderstatus=STR, o_totalprice=DBL, o_orderdate=NTZ,
               o_orderpriority=STR)
ZONE_OF_TYPE = {"click": 4, "error": 132, "purchase": 161, "signup": 237, "view": 138}
REFERENCE_END = "2024-01-23"


def zone_of(event_type):
    mapped = F.lit(None).cast("int")
    for name, zone in ZONE_OF_TYPE.items():
        mapped = F.when(event_type == name, F.lit(zone)).otherwise(mapped)
    return mapped


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/events.parquet", EVENTS).withColumn(ZONE, zone_of(F.col("event_type")))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/orders.parquet", ORDERS)


def as_trips(rows: DataFrame) -> DataFrame:
    """Duration in minutes = value, distance = the counter in ``props``."""
    micros = F.round(F.col("value") * 60_000_000).cast("long")
    return rows.select(
        F.col("ts").alias("tpep_pickup_datetime"),
        F.timestamp_add("MICROSECOND", micros, "ts").alias("tpep_dropoff_datetime"),
        ZONE, F.get_json_object("props", "$.k").cast("double").alias("trip_distance"),
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_trips(events(spark, sf_dir)).withColumn("expected_month", F.lit(1))


def demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_demand(events(spark, sf_dir), ts="ts")


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_history(demand(spark, sf_dir), LAGS)


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_features(demand(spark, sf_dir), LAGS)


def with_forecasts(rows: DataFrame) -> DataFrame:
    """Two plain forecasts: the value a day ago, and the mean of two recent ones."""
    return rows.withColumns({
        "by_champion": F.col("lag_96"), "by_challenger": (F.col("lag_1") + F.col("lag_4")) / 2,
    })


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_forecasts(features(spark, sf_dir))


def long_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = predictions(spark, sf_dir).select(WINDOW, ZONE, "hour", DEMAND, "by_champion", "by_challenger")
    return wide.unpivot([WINDOW, ZONE, "hour", DEMAND], ["by_champion", "by_challenger"], "model", "predicted")


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        "event_id", "ts", ZONE,
        F.when(F.col("event_id") % 2 == 0, "single").otherwise("batch").alias("endpoint"),
        F.when(F.col("event_type") == "error", "error").otherwise("success").alias("status"),
        F.col("event_type").alias("error_type"),
        (F.col("value") / 100).alias("latency_seconds"),
        F.get_json_object("props", "$.k").cast("double").alias("k"),
        "value",
    )


def prediction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = predictions(spark, sf_dir).select(
        F.col(WINDOW).alias("timestamp"), F.col(ZONE).alias("location_id"), "hour", "day_of_week", "month",
        "lag_1", "lag_4", "lag_96", "rolling_mean_4", F.col("by_challenger").alias("predicted_demand"),
        F.when(F.col("hour") != 3, F.col(DEMAND)).cast("double").alias("actual_demand"),
        F.when(F.col("hour") != 3, F.col(DEMAND) - F.col("by_challenger")).alias("error"),
        (F.col("rolling_max_24") * 10).alias("latency_ms"),
        F.when(F.col("is_weekend") == 1, "batch").otherwise("single").alias("endpoint"),
    )
    return with_log_defaults(rows, PREDICTION_LOG, F.col("timestamp"))


def quality_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per event; some fields are missing, out of range or extreme."""
    k, value = F.get_json_object("props", "$.k").cast("double"), F.col("value")
    base = events(spark, sf_dir).select(
        "event_id", floor_minutes("ts").alias(WINDOW), "ts",
        F.when(k == 1, F.lit(300)).otherwise(F.col(ZONE)).alias(ZONE), value.alias("v"), k.alias("k"))
    return with_window_parts(base, "ts").select(
        "event_id", WINDOW, ZONE, "hour", "day_of_week", "month",
        F.when(F.col("day_of_week") >= 5, 1).otherwise(0).alias("is_weekend"),
        F.when(F.col("hour").isin(7, 8, 9, 17, 18, 19), 1).otherwise(0).alias("is_rush_hour"),
        F.dayofmonth("ts").alias("day_of_month"), F.weekofyear("ts").alias("week_of_year"),
        F.when(F.col("k") == 2, 4).otherwise(F.floor(F.col("hour") / 6)).cast("int").alias("time_of_day"),
        F.lit(0).alias("season"), F.lit(1).alias("is_manhattan"),
        F.col("v").alias("lag_1"), (F.col("v") - 2).alias("lag_4"), (F.col("v") + 3).alias("lag_24"),
        F.when(F.col("k") != 0, F.col("k")).alias("lag_96"), F.col("k").alias("lag_672"),
        F.when(F.col("k") == 5, F.lit(float("nan"))).otherwise(F.col("v") / 2).alias("rolling_mean_4"),
        (F.col("k") / 10).alias("rolling_std_4"), (F.col("v") + F.col("k")).alias("rolling_max_24"),
        (F.col("v") / 3).alias("rolling_min_24"),
    )


def reference_and_production(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = features(spark, sf_dir)
    cut = F.lit(REFERENCE_END).cast("timestamp_ntz")
    return rows.filter(F.col(WINDOW) < cut), rows.filter(F.col(WINDOW) >= cut)


def demand_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per day and priority: many months for the temporal splits."""
    digit = F.substring("o_orderpriority", 1, 1).cast("int").alias(ZONE)
    counted = orders(spark, sf_dir).select(F.col("o_orderdate").alias(WINDOW), digit).groupBy(WINDOW, ZONE).agg(
        F.count(F.lit(1)).alias(DEMAND))
    return counted


_zones = ", ".join(str(z) for z in MANHATTAN_ZONES)
_types = " ".join(f"WHEN '{n}' THEN {z}" for n, z in ZONE_OF_TYPE.items())
_lags = ",\n    ".join(f"lag(CAST(actual_demand AS DOUBLE), {n}) OVER w AS lag_{n}" for n in LAGS)
_complete = " AND ".join([*[f"lag_{n} IS NOT NULL" for n in LAGS], "rolling_max_24 IS NOT NULL"])

CTES = {
    "ev": ([], f"""SELECT event_id, ts, user_id, event_type, value, props,
    CAST(CASE event_type {_types} END AS INTEGER) AS PULocationID,
    CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events"""),
    "trips": (["ev"], """SELECT ts AS tpep_pickup_datetime,
    ts + to_microseconds(CAST(round(value * 60000000) AS BIGINT)) AS tpep_dropoff_datetime,
    PULocationID, k AS trip_distance, 1 AS expected_month FROM ev"""),
    "demand": (["ev"], """SELECT pickup_window, PULocationID, actual_demand,
    CAST(hour(pickup_window) AS INTEGER) AS hour, CAST(isodow(pickup_window) - 1 AS INTEGER) AS day_of_week,
    CAST(month(pickup_window) AS INTEGER) AS month
    FROM (SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS pickup_window, PULocationID, count(*) AS actual_demand
    FROM ev WHERE PULocationID IS NOT NULL GROUP BY 1, 2)"""),
    "history": (["demand"], f"""SELECT *,
    CAST(day_of_week IN (5, 6) AS INTEGER) AS is_weekend,
    CAST(hour IN (7, 8, 9, 17, 18, 19) AS INTEGER) AS is_rush_hour,
    CAST(day(pickup_window) AS INTEGER) AS day_of_month, CAST(week(pickup_window) AS INTEGER) AS week_of_year,
    CAST(CASE WHEN hour <= 6 THEN 0 WHEN hour <= 12 THEN 1 WHEN hour <= 18 THEN 2 ELSE 3 END AS INTEGER)
      AS time_of_day,
    CAST((month % 12) // 3 AS INTEGER) AS season,
    CAST(PULocationID IN ({_zones}) AS INTEGER) AS is_manhattan,
    {_lags},
    CASE WHEN count(*) OVER w4 = 4 THEN avg(CAST(actual_demand AS DOUBLE)) OVER w4 END AS rolling_mean_4,
    CASE WHEN count(*) OVER w4 = 4 THEN stddev_samp(CAST(actual_demand AS DOUBLE)) OVER w4 END AS rolling_std_4,
    CASE WHEN count(*) OVER w24 = 24 THEN max(CAST(actual_demand AS DOUBLE)) OVER w24 END AS rolling_max_24,
    CASE WHEN count(*) OVER w24 = 24 THEN min(CAST(actual_demand AS DOUBLE)) OVER w24 END AS rolling_min_24
    FROM demand WINDOW w AS (PARTITION BY PULocationID ORDER BY pickup_window),
    w4 AS (PARTITION BY PULocationID ORDER BY pickup_window ROWS BETWEEN 3 PRECEDING AND CURRENT ROW),
    w24 AS (PARTITION BY PULocationID ORDER BY pickup_window ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)"""),
    "features": (["history"], f"SELECT * FROM history WHERE {_complete}"),
    "preds": (["features"], "SELECT *, lag_96 AS by_champion, (lag_1 + lag_4) / 2 AS by_challenger FROM features"),
    "long_preds": (["preds"], """SELECT pickup_window, PULocationID, hour, actual_demand, 'by_champion' AS model,
    by_champion AS predicted FROM preds UNION ALL SELECT pickup_window, PULocationID, hour, actual_demand,
    'by_challenger', by_challenger FROM preds"""),
    "requests": (["ev"], """SELECT event_id, ts, PULocationID,
    CASE WHEN event_id % 2 = 0 THEN 'single' ELSE 'batch' END AS endpoint,
    CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS status,
    event_type AS error_type, value / 100 AS latency_seconds, k, value FROM ev"""),
    "plog": (["preds"], """SELECT CAST(NULL AS BIGINT) AS id, pickup_window AS timestamp, PULocationID AS location_id, hour, day_of_week, month,
    lag_1, lag_4, lag_96, rolling_mean_4, by_challenger AS predicted_demand,
    CASE WHEN hour <> 3 THEN CAST(actual_demand AS DOUBLE) END AS actual_demand,
    CASE WHEN hour <> 3 THEN actual_demand - by_challenger END AS error,
    rolling_max_24 * 10 AS latency_ms, 'v1' AS model_version,
    CASE WHEN is_weekend = 1 THEN 'batch' ELSE 'single' END AS endpoint, pickup_window AS created_at FROM preds"""),
    "quality": (["ev"], """SELECT event_id, time_bucket(INTERVAL 15 MINUTE, ts) AS pickup_window,
    CASE WHEN k = 1 THEN 300 ELSE PULocationID END AS PULocationID,
    CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
    CAST(month(ts) AS INTEGER) AS month,
    CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS is_weekend,
    CASE WHEN hour(ts) IN (7, 8, 9, 17, 18, 19) THEN 1 ELSE 0 END AS is_rush_hour,
    CAST(day(ts) AS INTEGER) AS day_of_month, CAST(week(ts) AS INTEGER) AS week_of_year,
    CAST(CASE WHEN k = 2 THEN 4 ELSE hour(ts) // 6 END AS INTEGER) AS time_of_day, 0 AS season, 1 AS is_manhattan,
    value AS lag_1, value - 2 AS lag_4, value + 3 AS lag_24, CASE WHEN k <> 0 THEN k END AS lag_96, k AS lag_672,
    CASE WHEN k = 5 THEN NULL ELSE value / 2 END AS rolling_mean_4, k / 10 AS rolling_std_4,
    value + k AS rolling_max_24, value / 3 AS rolling_min_24 FROM ev"""),
    "ref": (["features"], f"SELECT * FROM features WHERE pickup_window < TIMESTAMP '{REFERENCE_END}'"),
    "prod": (["features"], f"SELECT * FROM features WHERE pickup_window >= TIMESTAMP '{REFERENCE_END}'"),
    "daily": ([], """SELECT o_orderdate AS pickup_window, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS PULocationID,
    count(*) AS actual_demand FROM orders GROUP BY 1, 2"""),
}


def sql_over(*names: str, body: str, extra: dict[str, str] | None = None) -> str:
    """The body behind a WITH clause holding the named adapters and what they build on."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name not in ordered:
            for needed in CTES[name][0]:
                add(needed)
            ordered.append(name)

    for name in names:
        add(name)
    parts = [f"{n} AS ({CTES[n][1]})" for n in ordered]
    parts += [f"{n} AS ({text})" for n, text in (extra or {}).items()]
    return f"WITH {', '.join(parts)}\n{body}" if parts else body
