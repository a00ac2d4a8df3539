"""Drift and distribution statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlab.catalog import adapters as ad
from demandlab.catalog.adapters import REFERENCE_END, sql_over
from demandlab.catalog.joins import DEMAND_LOG, TRAILING_SQL, demand_log
from demandlab.catalog.registry import query, rounded
from demandlab.operators.drift import (
    drift_report, feature_drift, feature_drift_within, feature_stats, ks_table, prediction_stats, psi_table,
    ranked_counts, sample_counts, shifted_means, split_sample_counts,
)
from demandlab.operators.metrics import prediction_performance
from demandlab.operators.observability import trailing_means
from demandlab.plans.drift_check import check_drift, production_rows, reference_rows
from demandlab.schemas import DRIFT_LOG, FEATURES, WINDOW, ZONE
from demandlab.session import scratch_path
from demandlab.sources.logs import append_log, drift_log_rows

_long = "UNPIVOT (SELECT {cols} FROM {src}) ON " + ", ".join(FEATURES) + " INTO NAME feature VALUE value"
FEATURE_COLUMNS = ", ".join(f"CAST({f} AS DOUBLE) AS {f}" for f in FEATURES)
LONG_SQL = {
    "lref": _long.format(cols=FEATURE_COLUMNS, src="ref"),
    "lprod": _long.format(cols=FEATURE_COLUMNS, src="prod"),
}


def reference_or_production() -> tuple:
    """Row conditions of the reference and the production sample."""
    cut = F.lit(REFERENCE_END).cast("timestamp_ntz")
    return F.col(WINDOW) < cut, F.col(WINDOW) >= cut


@query("d1_reference_stats", sql_over("ref", extra={"lref": LONG_SQL["lref"]}, body="""
SELECT feature, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, round(min(value), 6) AS min,
  round(max(value), 6) AS max, round(median(value), 6) AS median, round(quantile_cont(value, 0.25), 6) AS q25,
  round(quantile_cont(value, 0.75), 6) AS q75 FROM lref GROUP BY feature"""))
def reference_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    reference, _ = ad.reference_and_production(spark, sf_dir)
    return rounded(feature_stats(reference))


def ks_steps(group: str = "feature") -> dict[str, str]:
    """KS over the tables lref and lprod with columns (group..., value)."""
    return {
        "cnt": f"""SELECT {group}, value, sum(r) AS r, sum(p) AS p FROM (
    SELECT {group}, value, 1 AS r, 0 AS p FROM lref UNION ALL SELECT {group}, value, 0, 1 FROM lprod) GROUP BY ALL""",
        "cum": f"""SELECT *, sum(r) OVER w AS cr, sum(p) OVER w AS cp, sum(r) OVER (PARTITION BY {group}) AS n,
    sum(p) OVER (PARTITION BY {group}) AS m FROM cnt WINDOW w AS (PARTITION BY {group} ORDER BY value)""",
        "ksd": f"""SELECT {group}, max(abs(cr / n - cp / m)) AS ks, max(n) AS n, max(m) AS m,
    max(abs(cr / n - cp / m)) * sqrt(CAST(max(n) AS DOUBLE) * max(m) / (max(n) + max(m))) AS lam
    FROM cum GROUP BY {group}""",
        "ksp": f"""SELECT {group}, ks, n, m, CASE WHEN lam < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0, 2 * list_sum(
    list_transform(range(1, 101), lambda k: CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END * exp(-2.0 * k * k * lam * lam)))))
    END AS p_value FROM ksd""",
    }


@query("d2_ks", sql_over("ref", "prod", extra={**LONG_SQL, **ks_steps()}, body="""
SELECT feature, round(ks, 6) AS ks, round(p_value, 6) AS p_value, CAST(n AS BIGINT) AS n_ref,
  CAST(m AS BIGINT) AS n_prod FROM ksp"""))
def ks(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = split_sample_counts(ad.features(spark, sf_dir), *reference_or_production())
    return rounded(ks_table(ranked_counts(counts)).select("feature", "ks", "p_value", "n_ref", "n_prod"))


def psi_sql(source_ref: str, source_prod: str, edges: str, floor: bool = False) -> dict[str, str]:
    share = "greatest({x}, 0.0001)" if floor else "{x}"
    r, p = share.format(x="coalesce(a.c, 0) / ra.t"), share.format(x="coalesce(b.c, 0) / rb.t")
    binned = """SELECT len(list_filter(e, lambda x: x < value)) + CASE WHEN value = e[1] THEN 1 ELSE 0 END AS bin,
    count(*) AS c FROM {src}, edges WHERE value >= e[1] AND value <= e[len(e)] AND len(e) > 1 GROUP BY 1"""
    return {
        "edges": edges,
        "rb1": binned.format(src=source_ref),
        "pb1": binned.format(src=source_prod),
        "bins": "SELECT unnest(range(1, len(e))) AS bin FROM edges",
        "shares": f"""SELECT {r} AS r, {p} AS p FROM bins LEFT JOIN rb1 a USING (bin) LEFT JOIN pb1 b USING (bin),
    (SELECT sum(c) AS t FROM rb1) ra, (SELECT sum(c) AS t FROM pb1) rb""",
        "psi": """SELECT coalesce(sum(CASE WHEN r = 0 AND p = 0 THEN 0 WHEN r = 0 OR p = 0 THEN 'inf'::DOUBLE
    ELSE (p - r) * ln(p / r) END), 0.0) AS psi FROM shares""",
    }


_DECILES = "[" + ", ".join(str(i / 10) for i in range(11)) + "]"
ZONE_EDGES = f"""SELECT CASE WHEN count(DISTINCT value) < 10 THEN list_sort(list(DISTINCT value))
  ELSE list_sort(list_distinct(quantile_cont(value, {_DECILES}))) END AS e FROM {{src}}"""
ZONE_PSI = {
    **LONG_SQL,
    "zref": "SELECT value FROM lref WHERE feature = 'PULocationID'",
    "zprod": "SELECT value FROM lprod WHERE feature = 'PULocationID'",
    **psi_sql("zref", "zprod", ZONE_EDGES.format(src="zref")),
}


@query("d3_psi_zones", sql_over("ref", "prod", extra=ZONE_PSI, body="""
SELECT 'PULocationID' AS feature, round(psi, 6) AS psi FROM psi"""))
def psi_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = sample_counts(*ad.reference_and_production(spark, sf_dir), [ZONE])
    return rounded(psi_table(ranked_counts(counts), integers=[ZONE]))


def _event_psi(column: str, floor: bool = False) -> str:
    cut = f"TIMESTAMP '{REFERENCE_END}'"
    return sql_over("ev", extra={
        "eref": f"SELECT CAST({column} AS DOUBLE) AS value FROM ev WHERE ts < {cut}",
        "eprod": f"SELECT CAST({column} AS DOUBLE) AS value FROM ev WHERE ts >= {cut}",
        **psi_sql("eref", "eprod", f"SELECT list_sort(list_distinct(quantile_cont(value, {_DECILES}))) AS e FROM eref",
                  floor),
    }, body=f"SELECT '{column}' AS feature, round(psi, 6) AS psi FROM psi")


def _event_counts(spark: SparkSession, sf_dir: str, column: str) -> DataFrame:
    rows, cut = ad.events(spark, sf_dir), F.lit(REFERENCE_END).cast("timestamp_ntz")
    return ranked_counts(split_sample_counts(rows, F.col("ts") < cut, F.col("ts") >= cut, [column]))


@query("d3_psi_values", _event_psi("value"))
def psi_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(psi_table(_event_counts(spark, sf_dir, "value")))


@query("d3_psi_users_floor", _event_psi("user_id", floor=True))
def psi_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(psi_table(_event_counts(spark, sf_dir, "user_id"), empty_bin="floor"))


MOMENTS = {
    "mref": "SELECT feature, avg(value) AS m, stddev_samp(value) AS s FROM lref GROUP BY 1",
    "mprod": "SELECT feature, avg(value) AS m, stddev_samp(value) AS s FROM lprod GROUP BY 1",
}
DRIFT_STEPS = {
    **ZONE_PSI, **ks_steps(), **MOMENTS,
    "tab": """SELECT feature, CASE WHEN feature = 'PULocationID' THEN psi > 0.1 ELSE p_value < 0.05 END
    AS drift_detected, CASE WHEN feature = 'PULocationID' THEN 'PSI' ELSE 'KS' END AS test,
    CASE WHEN feature = 'PULocationID' THEN psi ELSE ks END AS drift_score,
    CASE WHEN feature <> 'PULocationID' THEN p_value END AS p_value, mref.m AS reference_mean,
    mprod.m AS production_mean, mprod.m - mref.m AS mean_shift, mref.s AS reference_std, mprod.s AS production_std
    FROM ksp JOIN mref USING (feature) JOIN mprod USING (feature), psi""",
}


@query("d4_feature_drift", sql_over("ref", "prod", extra=DRIFT_STEPS, body="""
SELECT feature, drift_detected, test, round(drift_score, 6) AS drift_score, round(p_value, 6) AS p_value,
  round(reference_mean, 6) AS reference_mean, round(production_mean, 6) AS production_mean,
  round(mean_shift, 6) AS mean_shift, round(reference_std, 6) AS reference_std,
  round(production_std, 6) AS production_std FROM tab"""))
def drift_of_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(feature_drift_within(ad.features(spark, sf_dir), *reference_or_production()))


@query("d5_prediction_drift", sql_over("preds", body="""
SELECT round(avg(by_challenger), 6) AS mean, round(stddev_pop(by_challenger), 6) AS std,
  round(min(by_challenger), 6) AS min, round(max(by_challenger), 6) AS max, round(median(by_challenger), 6) AS median,
  round(avg(abs(e)), 6) AS mae, round(sqrt(avg(e * e)), 6) AS rmse,
  round(avg(abs(e / (y + 1e-8))) * 100, 6) AS mape, round(avg(e), 6) AS bias
FROM (SELECT by_challenger, by_challenger - actual_demand AS e, CAST(actual_demand AS DOUBLE) AS y FROM preds)"""))
def prediction_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ad.predictions(spark, sf_dir).withColumnRenamed("by_challenger", "predicted")
    performance = prediction_performance(rows).select(F.struct("*")).scalar()
    return rounded(prediction_stats(rows).withColumn("_p", performance).select("*", "_p.*").drop("_p"))


NAMES_SQL = ("array_to_string(list_filter([" + ", ".join(f"'{f}'" for f in FEATURES)
             + "], lambda f: list_contains(hits, f)), ', ')")
SUMMARY_SQL = f"""SELECT total_features, drifted_features, drifted_features > 0 AS drift_detected,
  {NAMES_SQL} AS drifted_feature_names FROM (SELECT count(*) AS total_features,
  count(*) FILTER (WHERE drift_detected) AS drifted_features,
  coalesce(list(feature) FILTER (WHERE drift_detected), []) AS hits FROM tab)"""


@query("d6_drift_report", sql_over("ref", "prod", extra={
    **DRIFT_STEPS, "errs": """SELECT (lag_1 + lag_4) / 2 AS f, (lag_1 + lag_4) / 2 - actual_demand AS e,
    CAST(actual_demand AS DOUBLE) AS y FROM prod""",
}, body=f"""
SELECT *, (SELECT count(*) FROM prod) AS production_data_size FROM ({SUMMARY_SQL}), (
  SELECT round(avg(f), 6) AS mean, round(stddev_pop(f), 6) AS std, round(min(f), 6) AS min, round(max(f), 6) AS max,
  round(median(f), 6) AS median, round(avg(abs(e)), 6) AS mae, round(sqrt(avg(e * e)), 6) AS rmse,
  round(avg(abs(e / (y + 1e-8))) * 100, 6) AS mape, round(avg(e), 6) AS bias FROM errs)"""))
def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, (in_reference, in_production) = ad.features(spark, sf_dir), reference_or_production()
    size = rows.agg(F.count_if(in_production).alias("n")).scalar()
    scored = ad.with_forecasts(rows.filter(in_production))
    nested = drift_report(feature_drift_within(rows, in_reference, in_production), F.lit("2024-02-01"), size,
                          predictions=scored, predicted="by_challenger")
    return rounded(nested.select(
        "summary.total_features", "summary.drifted_features", "summary.drift_detected",
        F.array_join("summary.drifted_feature_names", ", ").alias("drifted_feature_names"), "production_data_size",
        *[f"prediction_drift.{n}" for n in ("mean", "std", "min", "max", "median")], "prediction_drift.performance.*"))


@query("s13_drift_log", sql_over("ref", "prod", extra=DRIFT_STEPS, body=f"""
SELECT CAST(1 AS BIGINT) AS id, TIMESTAMP '2024-02-01' AS timestamp, 'data_drift' AS report_type, drift_detected,
  round(drifted_features / total_features, 6) AS drift_score, drifted_feature_names AS features_affected,
  (SELECT count(*) FROM prod) AS production_data_size FROM ({SUMMARY_SQL})"""))
def drift_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "drift-log")
    reference, production = ad.reference_and_production(spark, sf_dir)
    size = production.agg(F.count(F.lit(1)).alias("n")).scalar()
    report = drift_report(feature_drift(reference, production), F.lit("2024-02-01 00:00:00"), size)
    append_log(drift_log_rows(report), path, DRIFT_LOG)
    return rounded(spark.read.schema(DRIFT_LOG).parquet(path).select(
        "id", "timestamp", "report_type", "drift_detected", "drift_score",
        F.array_join("features_affected", ", ").alias("features_affected"),
        F.get_json_object("report_json", "$.production_data_size").cast("long").alias("production_data_size")))


@query("d7_drift_check", sql_over("features", extra={
    "ref": "SELECT * FROM features",
    "prod": "SELECT * FROM features WHERE pickup_window >= (SELECT max(pickup_window) FROM features) - INTERVAL 3 DAY",
    **DRIFT_STEPS,
}, body=SUMMARY_SQL))
def drift_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ad.demand(spark, sf_dir)
    _, summary = check_drift(reference_rows(rows), production_rows(rows, days_back=3))
    return summary.withColumn("drifted_feature_names", F.array_join("drifted_feature_names", ", "))


@query("d8_mean_shift_alert", sql_over("demand", extra={
    **DEMAND_LOG, "tr": TRAILING_SQL.format(src="dlog"),
}, body="""SELECT location_id, bucket, mean_1h, mean_24h_week_ago, round(abs(mean_1h - mean_24h_week_ago), 4) AS shift
FROM tr WHERE abs(mean_1h - mean_24h_week_ago) > 0.5"""))
def mean_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = rounded(trailing_means(demand_log(spark, sf_dir), "timestamp", "predicted_demand", ["location_id"]))
    return shifted_means(means, 0.5).withColumn("shift", F.round("shift", 4))
