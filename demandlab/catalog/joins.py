"""Join-shaped operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlab.catalog import adapters as ad
from demandlab.catalog.adapters import sql_over
from demandlab.catalog.columns import ZONES
from demandlab.catalog.registry import query, rounded
from demandlab.operators.demand import hour_profile
from demandlab.operators.geo import against_history, align_distributions, flag_manhattan, with_zone, zone_layer
from demandlab.operators.metrics import compare_models
from demandlab.operators.observability import trailing_means
from demandlab.operators.sampling import label_by_month, split_by_month
from demandlab.schemas import DEMAND, MANHATTAN_ZONES, WINDOW, ZONE


@query("j1_zone_lookup", sql_over("demand", extra=ZONES, body="""
SELECT PULocationID, name, lat, lon, count(*) AS slots FROM demand JOIN zones USING (PULocationID)
GROUP BY 1, 2, 3, 4"""))
def zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = with_zone(ad.demand(spark, sf_dir))
    return named.groupBy(ZONE, "name", "lat", "lon").agg(F.count(F.lit(1)).alias("slots"))


@query("j2_zone_layer", sql_over("demand", extra={
    **ZONES, "nine": "SELECT PULocationID, sum(actual_demand) AS d FROM demand WHERE hour = 9 GROUP BY 1",
}, body="""SELECT PULocationID, lat, lon, name, CAST(coalesce(d, 0) AS DOUBLE) AS actual_demand
FROM zones LEFT JOIN nine USING (PULocationID)"""))
def layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_layer(ad.demand(spark, sf_dir).filter(F.col("hour") == 9), DEMAND)


@query("j2_unknown_zone", sql_over("demand", extra=ZONES, body="""
SELECT coalesce(name, 'Unknown') AS name, CAST(sum(actual_demand) AS BIGINT) AS trips
FROM demand LEFT JOIN zones USING (PULocationID) GROUP BY 1"""))
def unknown_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_zone(ad.demand(spark, sf_dir), "left").groupBy("name").agg(F.sum(DEMAND).alias("trips"))


@query("j3_zone_flag", sql_over("demand", body=f"""
SELECT pickup_window, PULocationID,
  CAST(PULocationID IN ({", ".join(map(str, MANHATTAN_ZONES))}) AS INTEGER) AS is_manhattan FROM demand"""))
def zone_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flag_manhattan(ad.demand(spark, sf_dir)).select(WINDOW, ZONE, "is_manhattan")


_MONTHS = {"months": "SELECT DISTINCT date_trunc('month', pickup_window) AS m FROM daily ORDER BY m LIMIT 10"}


@query("j4_month_split", sql_over("daily", extra=_MONTHS, body="""
SELECT daily.*, 'train' AS part FROM daily WHERE date_trunc('month', pickup_window) IN (SELECT m FROM months)
UNION ALL SELECT daily.*, 'validation' FROM daily WHERE date_trunc('month', pickup_window) NOT IN (SELECT m FROM months)"""))
def month_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of both sides of the split that training uses."""
    demand = ad.demand_orders(spark, sf_dir)
    parts = [side.select(*demand.columns, F.lit(name).alias("part"))
             for side, name in zip(split_by_month(demand, 10), ("train", "validation"), strict=True)]
    return parts[0].unionByName(parts[1])


@query("j4_month_semi_join", sql_over("daily", extra={
    "months": "SELECT DISTINCT date_trunc('month', pickup_window) AS m FROM daily ORDER BY m LIMIT 10",
}, body="""SELECT CASE WHEN m IS NULL THEN 'validation' ELSE 'train' END AS part, count(*) AS n,
  CAST(sum(actual_demand) AS BIGINT) AS demand, min(pickup_window) AS first_window, max(pickup_window) AS last_window
FROM daily LEFT JOIN months ON date_trunc('month', pickup_window) = m GROUP BY 1"""))
def month_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = label_by_month(ad.demand_orders(spark, sf_dir), 10)
    return parts.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.sum(DEMAND).alias("demand"), F.min(WINDOW).alias("first_window"),
        F.max(WINDOW).alias("last_window"))


@query("j5_aligned_distributions", sql_over("ref", "prod", extra={
    "a": "SELECT CAST(actual_demand AS INTEGER) AS b, count(*) / (SELECT count(*) FROM ref) AS s FROM ref GROUP BY 1",
    "c": "SELECT CAST(actual_demand AS INTEGER) AS b, count(*) / (SELECT count(*) FROM prod) AS s FROM prod GROUP BY 1",
}, body="""SELECT coalesce(a.b, c.b) AS bin, round(coalesce(a.s, 0.0001), 6) AS left_share,
  round(coalesce(c.s, 0.0001), 6) AS right_share FROM a FULL OUTER JOIN c ON a.b = c.b"""))
def aligned_distributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    def shares(rows: DataFrame) -> DataFrame:
        total = rows.agg(F.count(F.lit(1)).alias("n")).scalar()
        counted = rows.groupBy(F.col(DEMAND).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
        return counted.select("bin", (F.col("n") / total).alias("share"))

    reference, production = ad.reference_and_production(spark, sf_dir)
    return rounded(align_distributions(shares(reference), shares(production), "bin", "share"))


PROFILE = {
    "profile": """SELECT PULocationID, hour, count(*) AS slot_count, CAST(sum(actual_demand) AS BIGINT) AS trips
    FROM demand GROUP BY 1, 2"""
}


@query("j6_prediction_vs_history", sql_over("preds", extra=PROFILE, body="""
SELECT pickup_window, PULocationID, round(by_challenger, 6) AS predicted, slot_count,
  round(abs(by_challenger - slot_count), 6) AS abs_error FROM preds JOIN profile USING (PULocationID, hour)"""))
def prediction_vs_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ad.predictions(spark, sf_dir).withColumnRenamed("by_challenger", "predicted")
    joined = against_history(rows, hour_profile(ad.demand(spark, sf_dir)))
    return rounded(joined.select(WINDOW, ZONE, "predicted", "slot_count", "abs_error"))


@query("j7_prediction_actual_pairs", sql_over("preds", body="""
SELECT pickup_window, PULocationID, actual_demand, round(by_challenger, 6) AS predicted,
  round(actual_demand - by_challenger, 6) AS error FROM preds"""))
def prediction_actual_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = ad.predictions(spark, sf_dir).select(WINDOW, ZONE, F.col("by_challenger").alias("predicted"))
    paired = ad.demand(spark, sf_dir).join(stored, [WINDOW, ZONE])
    return rounded(paired.select(WINDOW, ZONE, DEMAND, "predicted",
                                 (F.col(DEMAND) - F.col("predicted")).alias("error")))


COMPARE_SQL = """SELECT *, CASE WHEN challenger_mae < champion_mae THEN 'v2' ELSE 'v1' END AS winner,
  round(abs((raw_challenger - raw_champion) / raw_champion * 100), 6) AS mae_improvement_pct FROM (
  SELECT avg(abs(e1)) AS raw_champion, avg(abs(e2)) AS raw_challenger,
  round(avg(abs(e1)), 6) AS champion_mae, round(sqrt(avg(e1 * e1)), 6) AS champion_rmse,
  round(1 - sum(e1 * e1) / (var_pop(y) * count(*)), 6) AS champion_r2,
  round(avg(abs(e2)), 6) AS challenger_mae, round(sqrt(avg(e2 * e2)), 6) AS challenger_rmse,
  round(1 - sum(e2 * e2) / (var_pop(y) * count(*)), 6) AS challenger_r2, count(*) AS test_samples
  FROM (SELECT CAST(actual_demand AS DOUBLE) AS y, by_champion - actual_demand AS e1,
  by_challenger - actual_demand AS e2 FROM preds))"""


@query("j8_two_models_same_rows", sql_over("preds", body=f"SELECT * EXCLUDE (raw_champion, raw_challenger) FROM ({COMPARE_SQL})"))
def two_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(compare_models(ad.predictions(spark, sf_dir), "by_champion", "by_challenger"))


TRAILING_SQL = """SELECT location_id, timestamp AS bucket, round(avg(predicted_demand) OVER h, 6) AS mean_1h,
  round(avg(predicted_demand) OVER d, 6) AS mean_24h_week_ago FROM (SELECT *, epoch(timestamp)::BIGINT AS t FROM {src})
  WINDOW h AS (PARTITION BY location_id ORDER BY t RANGE BETWEEN 3599 PRECEDING AND CURRENT ROW),
  d AS (PARTITION BY location_id ORDER BY t RANGE BETWEEN 691199 PRECEDING AND 604800 PRECEDING)"""

# Predictions exist for the newest week only, so the comparison with the week before uses the demand itself.
DEMAND_LOG = {
    "dlog": """SELECT pickup_window AS timestamp, PULocationID AS location_id,
    CAST(actual_demand AS DOUBLE) AS predicted_demand FROM demand"""
}


def demand_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad.demand(spark, sf_dir).select(
        F.col(WINDOW).alias("timestamp"), F.col(ZONE).alias("location_id"),
        F.col(DEMAND).cast("double").alias("predicted_demand"))


@query("j9_week_ago_comparison", sql_over("demand", extra=DEMAND_LOG, body=TRAILING_SQL.format(src="dlog")))
def week_ago(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(trailing_means(demand_log(spark, sf_dir), "timestamp", "predicted_demand", ["location_id"]))
