"""Splits, models and lifecycle."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlab.catalog import adapters as ad
from demandlab.catalog.adapters import sql_over
from demandlab.catalog.columns import ZONES
from demandlab.catalog.drift import DRIFT_STEPS, SUMMARY_SQL, ZONE_EDGES
from demandlab.catalog.joins import COMPARE_SQL
from demandlab.catalog.registry import query, rounded
from demandlab.catalog.scans import REGISTRY_SQL, stored_registry
from demandlab.operators.features import build_features
from demandlab.operators.geo import with_zone
from demandlab.operators.lifecycle import (
    append_deployment, append_version, claim_version, current_version, model_history, next_version, registry_row,
    retrain_decision,
)
from demandlab.operators.metrics import basic_metrics, compare_models, error_table, performance_check
from demandlab.operators.models import (
    boosted_trees, compare_learners, feature_vectors, learning_curve, linear_model, load_model, random_forest,
    save_model, score, train,
)
from demandlab.operators.ranking import settle
from demandlab.operators.sampling import head, label_by_month, label_by_position, label_by_time
from demandlab.plans.backtest import backtest_summary, week_ends, weekly_checks, weekly_retraining
from demandlab.plans.continual import CheckSettings, run_check
from demandlab.plans.drift_check import range_rows, window_index
from demandlab.plans.training import retrain
from demandlab.schemas import COMPARISON_FEATURES, DEMAND, FEATURES, LAGS, WINDOW, ZONE
from demandlab.session import scratch_path
from demandlab.sources.reports import read_registry


@query("m1_month_split", sql_over("daily", extra={
    "months": "SELECT DISTINCT date_trunc('month', pickup_window) AS m FROM daily ORDER BY m LIMIT 10",
}, body="""SELECT pickup_window, PULocationID, actual_demand, CASE WHEN m IS NULL THEN 'validation' ELSE 'train' END
AS part FROM daily LEFT JOIN months ON date_trunc('month', pickup_window) = m"""))
def month_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = label_by_month(ad.demand_orders(spark, sf_dir), 10)
    return parts.select(WINDOW, ZONE, DEMAND, "part")


@query("m2_position_split", sql_over("demand", body="""
SELECT pickup_window, PULocationID, CASE WHEN row_number() OVER (ORDER BY PULocationID, pickup_window)
  <= floor((SELECT count(*) FROM demand) * 0.8) THEN 'train' ELSE 'validation' END AS part FROM demand"""))
def position_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_by_position(ad.demand(spark, sf_dir)).select(WINDOW, ZONE, "part")


@query("m2_time_split", sql_over("demand", extra={
    "ranked": """SELECT pickup_window, percent_rank() OVER (ORDER BY pickup_window) AS r FROM
    (SELECT DISTINCT pickup_window FROM demand)""",
}, body="""SELECT pickup_window, PULocationID, CASE WHEN r <= 0.8 THEN 'train' ELSE 'validation' END AS part
FROM demand JOIN ranked USING (pickup_window)"""))
def time_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_by_time(ad.demand(spark, sf_dir)).select(WINDOW, ZONE, "part")


@query("m3_feature_vectors")
def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    built = feature_vectors(ad.features(spark, sf_dir))
    return built.select(WINDOW, ZONE, DEMAND, F.size(vector_to_array("features")).alias("width"))


# Rows of one training file: features are made by zone, and a learner has as many tasks as there are files.
FILE_ROWS = 100_000


def _stored(spark: SparkSession, sf_dir: str, demand: DataFrame | None = None) -> DataFrame:
    """Feature rows, written once: a learner reads them many times."""
    path = scratch_path(spark, "training-rows")
    rows = ad.features(spark, sf_dir) if demand is None else build_features(demand, LAGS)
    rows.write.option("maxRecordsPerFile", FILE_ROWS).parquet(path)
    return spark.read.parquet(path)


def _split(spark: SparkSession, sf_dir: str, demand: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    parts = label_by_time(_stored(spark, sf_dir, demand))
    return parts.filter(F.col("part") == "train"), parts.filter(F.col("part") == "validation")


@query("m4_boosted_trees")
def boosted(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, metrics = retrain(_stored(spark, sf_dir), boosted_trees())
    return rounded(metrics)


@query("m4_learning_curve")
def boosting_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    training, validation = _split(spark, sf_dir)
    return rounded(learning_curve(train(training), validation))


@query("m5_batch_scoring")
def batch_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    training, validation = _split(spark, sf_dir)
    scored = score(train(training), validation)
    return rounded(scored.select(WINDOW, ZONE, DEMAND, "predicted"))


@query("m6_learner_comparison")
def learner_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    training, validation = _split(spark, sf_dir)
    learners = {"gbt": boosted_trees(), "forest": random_forest(), "linear": linear_model()}
    return compare_learners(training, validation, learners, COMPARISON_FEATURES)


@query("m7_persisted_model")
def persisted_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    training, validation = _split(spark, sf_dir)
    path = scratch_path(spark, "model")
    save_model(train(training), path)
    return rounded(basic_metrics(score(load_model(path), validation)))


@query("m8_registered_version", sql_over("preds", body="""
SELECT 'v1' AS version, 'models/v1' AS model_path, round(avg(abs(by_challenger - actual_demand)), 6) AS mae,
  count(*) AS n_samples, '2024-01-01' AS start_date, false AS is_deployed, 'v2' AS next_version FROM preds"""))
def registered_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "registry")
    empty = read_registry(spark, path)
    metrics = basic_metrics(ad.predictions(spark, sf_dir), predicted="by_challenger")
    version = next_version(empty).scalar()
    append_version(registry_row(metrics, version, "models/v1", "2024-02-01T00:00:00", "2024-01-01", "2024-01-30"), path)
    stored = read_registry(spark, path)
    return rounded(stored.select(
        "version", "model_path", F.col("performance.mae").alias("mae"),
        F.col("training_data.n_samples").alias("n_samples"), F.col("training_data.start_date").alias("start_date"),
        "is_deployed", next_version(stored).scalar().alias("next_version")))


@query("m8_claimed_versions", sql_over("preds", body="""
SELECT 'v1' AS version, 'models/v1' AS model_path, round(avg(abs(by_champion - actual_demand)), 6) AS mae FROM preds
UNION ALL SELECT 'v2', 'models/v2', round(avg(abs(by_challenger - actual_demand)), 6) FROM preds"""))
def claimed_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, rows = scratch_path(spark, "registry"), ad.predictions(spark, sf_dir)
    # Two runs, the first of them repeated.
    for run in ("by_champion", "by_challenger", "by_champion"):
        version = claim_version(spark, path, run)
        metrics = basic_metrics(rows, predicted=run)
        append_version(registry_row(metrics, F.lit(version), f"models/{version}", "2024-02-01T00:00:00"), path)
    return rounded(read_registry(spark, path).select("version", "model_path", F.col("performance.mae").alias("mae")))


@query("m9_champion_challenger", sql_over("preds", body=f"SELECT winner, champion_mae, challenger_mae, mae_improvement_pct, test_samples FROM ({COMPARE_SQL})"))
def champion_challenger(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = compare_models(ad.predictions(spark, sf_dir), "by_champion", "by_challenger")
    return rounded(compared.select("winner", "champion_mae", "challenger_mae", "mae_improvement_pct", "test_samples"))


def decision_sql(mae_limit: float) -> str:
    return f"""concat_ws(' | ',
  CASE WHEN mae > {mae_limit} THEN printf('Performance degradation: MAE %.4f > threshold {mae_limit:.4f}', mae) END,
  CASE WHEN mae_increase_pct > 20 THEN printf('MAE increased by %.1f%% (threshold: 20%%)', mae_increase_pct) END,
  CASE WHEN drifted_features > 0 THEN 'Data drift in ' || drifted_features || ' features: [''' ||
    replace(names, ', ', ''', ''') || ''']' END)"""


@query("m10_retrain_decision", sql_over("features", extra={
    "ref": "SELECT * FROM features",
    "prod": "SELECT * FROM features WHERE pickup_window >= (SELECT max(pickup_window) FROM features) - INTERVAL 3 DAY",
    **DRIFT_STEPS,
    "summ": f"SELECT drifted_features, drifted_feature_names AS names FROM ({SUMMARY_SQL})",
    "perf": """SELECT avg(abs(e)) AS mae, (avg(abs(e)) - 0.6) / 0.6 * 100 AS mae_increase_pct
    FROM (SELECT (lag_1 + lag_4) / 2 - actual_demand AS e FROM prod)""",
}, body=f"""SELECT reason <> '' AS should_retrain, CASE WHEN reason = '' THEN 'All checks passed' ELSE reason END AS reason
FROM (SELECT {decision_sql(0.5)} AS reason FROM perf, summ)"""))
def decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demandlab.plans.drift_check import check_drift, production_rows, reference_rows

    rows = ad.demand(spark, sf_dir)
    recent = production_rows(rows, 3, [*FEATURES, DEMAND])
    measured = performance_check(ad.with_forecasts(recent), 0.6, predicted="by_challenger")
    _, summary = check_drift(reference_rows(rows), recent)
    state = measured.withColumn("_d", summary.select(F.struct("*")).scalar()).select("*", "_d.*")
    return retrain_decision(state, mae_limit=0.5).select("should_retrain", "reason")


@query("m11_deployment", sql_over("preds", extra=REGISTRY_SQL, body="""
SELECT max_by(version, version) AS current_production, '2024-02-0' || max(substr(version, 2)) AS deployed_at,
  count(*) AS deployments FROM registry"""))
def deployment(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry, path = stored_registry(spark, sf_dir), scratch_path(spark, "deployments")
    # One small event per registered version (weeks of predictions).
    for version in sorted(r["version"] for r in registry.select("version").collect()):
        append_deployment(registry, version, f"2024-02-0{version[1:]}", path)
    return current_version(spark.read.schema("version string, deployed_at string").json(path))


@query("m12_continual_check")
def continual_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Every step of the check reads the demand; the events behind it are counted once.
    demand = settle(ad.demand(spark, sf_dir), "continual-demand")
    base = scratch_path(spark, "continual")
    settings = CheckSettings(f"{base}/champion", f"{base}/registry", f"{base}/deployments", f"{base}/models",
                             baseline_mae=0.5, mae_limit=0.5, days_back=3, reference_days=7, training_days=7)
    champion = train(_split(spark, sf_dir, demand)[0])
    save_model(champion, settings.model_path)
    report = run_check(spark, demand, "2024-01-30 23:45:00", "2024-01-26", "2024-02-01T00:00:00", settings,
                       boosted_trees())
    return report.select("config.*", "status", F.array_join("actions_taken", ", ").alias("actions"), "production_data_records",
                         "should_retrain", "new_model_version", "model_comparison.winner", "error")


@query("m13_model_history", sql_over("preds", extra=REGISTRY_SQL, body="""
SELECT version, replace(substr(trained_at, 1, 16), 'T', ' ') AS trained_at, printf('%.4f', mae) AS mae, is_deployed,
  row_number() OVER (ORDER BY trained_at DESC) = 1 AS is_current FROM registry"""))
def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model_history(stored_registry(spark, sf_dir))


START, WEEKS, BASELINE = date(2024, 1, 9), 4, 0.5
_ENDS = ", ".join(f"(TIMESTAMP '{e}', '{e}')" for e in week_ends(START, WEEKS))
_columns = ", ".join(f"CAST({f} AS DOUBLE) AS {f}" for f in FEATURES)
_long = f"UNPIVOT (SELECT week_end, {_columns} FROM {{src}}) ON " + ", ".join(FEATURES) + " INTO NAME feature VALUE value"
BACKTEST_STEPS = {
    "weekly": f"""SELECT w.name AS week_end, p.* FROM preds p, (VALUES {_ENDS}) AS w(stop, name)
    WHERE pickup_window <= stop AND pickup_window >= stop - INTERVAL 7 DAY""",
    "repeated": f"SELECT w.name AS week_end, ref.* FROM ref, (VALUES {_ENDS}) AS w(stop, name)",
    "lprod": _long.format(src="weekly"),
    "lref": _long.format(src="repeated"),
}
# A week without rows has no distribution to compare and no performance row.
BACKTEST_KS = {
    "cnt": """SELECT week_end, feature, value, sum(r) AS r, sum(p) AS p FROM (
    SELECT week_end, feature, value, 1 AS r, 0 AS p FROM lref WHERE week_end IN (SELECT week_end FROM lprod)
    UNION ALL SELECT week_end, feature, value, 0, 1 FROM lprod) GROUP BY ALL""",
}

def grouped_psi_sql(key: str, rows: str) -> dict[str, str]:
    """The zone is compared by PSI: one set of edges, the bins of every group against those of the reference."""
    in_bins = """SELECT {key} len(list_filter(e, lambda x: x < value)) + CASE WHEN value = e[1] THEN 1 ELSE 0 END AS bin,
    count(*) AS c FROM {src}, edges WHERE value >= e[1] AND value <= e[len(e)] AND len(e) > 1 GROUP BY ALL"""
    return {
        "zref": f"SELECT CAST({ZONE} AS DOUBLE) AS value FROM ref",
        "zrows": f"SELECT {key}, CAST({ZONE} AS DOUBLE) AS value FROM {rows}",
        "edges": ZONE_EDGES.format(src="zref"),
        "rbin": in_bins.format(key="", src="zref"),
        "gbin": in_bins.format(key=f"{key},", src="zrows"),
        "slots": f"SELECT {key}, bin FROM (SELECT DISTINCT {key} FROM gbin), (SELECT unnest(range(1, len(e))) AS bin FROM edges)",
        "parts": f"""SELECT {key}, coalesce(a.c, 0) / (SELECT sum(c) FROM rbin) AS r,
    coalesce(b.c, 0) / sum(coalesce(b.c, 0)) OVER (PARTITION BY {key}) AS p
    FROM slots LEFT JOIN rbin a USING (bin) LEFT JOIN gbin b USING ({key}, bin)""",
        "psi": f"""SELECT {key}, sum(CASE WHEN r = 0 AND p = 0 THEN 0 WHEN r = 0 OR p = 0 THEN 'inf'::DOUBLE
    ELSE (p - r) * ln(p / r) END) AS psi FROM parts GROUP BY 1""",
    }


def _backtest_sql(body: str) -> str:
    from demandlab.catalog.drift import ks_steps

    steps = {**ks_steps("week_end, feature"), **BACKTEST_KS}
    return sql_over("preds", "ref", extra={
        **BACKTEST_STEPS, **steps, **grouped_psi_sql("week_end", "weekly"),
        "perf": f"""SELECT week_end, avg(abs(e)) AS mae, (avg(abs(e)) - {BASELINE}) / {BASELINE} * 100
        AS mae_increase_pct, count(*) AS samples
        FROM (SELECT week_end, by_challenger - actual_demand AS e FROM weekly) GROUP BY 1""",
        "drift": f"""SELECT week_end, count(*) AS total_features,
        count(*) FILTER (CASE WHEN feature = '{ZONE}' THEN psi > 0.1 ELSE p_value < 0.05 END) AS drifted_features
        FROM ksp JOIN psi USING (week_end) GROUP BY 1""",
        "checks": """SELECT week_end, round(mae, 6) AS mae, round(mae_increase_pct, 6) AS mae_increase_pct, samples,
        total_features, drifted_features, mae > 2.5 OR mae_increase_pct > 20 OR drifted_features > 0 AS should_retrain
        FROM perf JOIN drift USING (week_end)""",
    }, body=body)


def _weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    reference, _ = ad.reference_and_production(spark, sf_dir)
    return weekly_checks(ad.predictions(spark, sf_dir), reference, week_ends(START, WEEKS), BASELINE,
                         "by_challenger")


@query("m14_weekly_checks", _backtest_sql("SELECT * FROM checks"))
def weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_weekly(spark, sf_dir).select(
        "week_end", "mae", "mae_increase_pct", "samples", "total_features", "drifted_features", "should_retrain"))


@query("m14_backtest_summary", _backtest_sql(f"""
SELECT {WEEKS} AS total_weeks, count(*) FILTER (WHERE should_retrain) AS retrain_events,
  round(count(*) FILTER (WHERE should_retrain) / {WEEKS}, 6) AS retrain_frequency FROM checks"""))
def backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(backtest_summary(_weekly(spark, sf_dir), WEEKS))


# One-feature regressions have a closed form, so the chain of champions can be followed in SQL.
FIRST_END, LEARNED, LIMIT = "2024-01-09", "rolling_mean_4", 0.4
_weeks = ", ".join(f"({n}, TIMESTAMP '{e}', '{e}')" for n, e in enumerate(week_ends(START, WEEKS), 1))


def _retraining_sql() -> str:
    from demandlab.catalog.drift import ks_steps

    return sql_over("history", extra={
        "rowsx": f"""SELECT pickup_window AS t, CAST(actual_demand AS DOUBLE) AS y, {LEARNED} AS x FROM history
    WHERE lag_4 IS NOT NULL AND rolling_max_24 IS NOT NULL""",
        "wk": f"SELECT * FROM (VALUES {_weeks}) AS w(n, stop, week_end)",
        "week_rows": "SELECT n, week_end, y, x FROM rowsx, wk WHERE t <= stop AND t >= stop - INTERVAL 7 DAY",
        "learnable": "SELECT n, t, y, x FROM rowsx, wk WHERE t <= stop AND t >= stop - INTERVAL 30 DAY",
        "ranks": """SELECT n, t, percent_rank() OVER (PARTITION BY n ORDER BY t) AS r
    FROM (SELECT DISTINCT n, t FROM learnable)""",
        "fits": f"""SELECT n AS model, regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM learnable JOIN ranks USING (n, t)
    WHERE r <= 0.8 GROUP BY n UNION ALL
    SELECT 0, regr_slope(y, x), regr_intercept(y, x) FROM rowsx WHERE t <= TIMESTAMP '{FIRST_END}'""",
        "errors": """SELECT n, model, avg(abs(greatest(0, a * x + b) - y)) AS mae, count(*) AS records
    FROM week_rows, fits WHERE model <= n GROUP BY ALL""",
        "lprod": "SELECT week_end, 'x' AS feature, x AS value FROM week_rows",
        "lref": f"""SELECT week_end, 'x' AS feature, x AS value FROM rowsx, (SELECT DISTINCT week_end FROM week_rows)
    WHERE t <= TIMESTAMP '{FIRST_END}' AND t >= TIMESTAMP '{FIRST_END}' - INTERVAL 30 DAY""",
        **ks_steps("week_end, feature"),
        "steps": "SELECT wk.n, week_end, coalesce(p_value < 0.05, false) AS drifted FROM wk LEFT JOIN ksp USING (week_end)",
    }, body=f"""
SELECT week_end, CASE WHEN records IS NULL THEN 'no_data' WHEN NOT retrain THEN 'success_no_retrain'
  WHEN won THEN 'success_deployed' ELSE 'success_no_deployment' END AS status, coalesce(records, 0) AS records,
  round(mae, 6) AS mae, CASE WHEN records IS NOT NULL THEN retrain END AS should_retrain, 'v' || judged AS champion,
  CASE WHEN retrain THEN 'v' || versions END AS new_version,
  CASE WHEN retrain THEN CASE WHEN won THEN 'new' ELSE 'current' END END AS winner,
  CASE WHEN retrain THEN round(mae, 6) END AS champion_mae, CASE WHEN retrain THEN round(other, 6) END AS challenger_mae
FROM (WITH RECURSIVE chain AS (
  SELECT 0 AS n, '' AS week_end, 0 AS model, 0 AS version, 0 AS versions, 0 AS judged, false AS retrain, false AS won,
    CAST(NULL AS BIGINT) AS records, CAST(NULL AS DOUBLE) AS mae, CAST(NULL AS DOUBLE) AS other
  UNION ALL
  SELECT n, week_end, CASE WHEN won THEN n ELSE before END, CASE WHEN won THEN versions ELSE judged END, versions, judged,
    retrain, won, records, mae, other
  FROM (SELECT *, had + CAST(retrain AS INTEGER) AS versions, retrain AND other < mae AS won
    FROM (SELECT s.n, s.week_end, k.model AS before, k.version AS judged, k.versions AS had, c.records, c.mae, m.mae AS other,
      coalesce(c.mae > {LIMIT} OR (c.mae - {BASELINE}) / {BASELINE} * 100 > 20 OR s.drifted, false) AS retrain
      FROM chain k JOIN steps s ON s.n = k.n + 1 LEFT JOIN errors c ON c.n = s.n AND c.model = k.model
      LEFT JOIN errors m ON m.n = s.n AND m.model = s.n)))
  SELECT * FROM chain WHERE n > 0)""")


@query("m14_weekly_retraining", _retraining_sql())
def retraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, path = scratch_path(spark, "retraining"), scratch_path(spark, "demand")
    ad.demand(spark, sf_dir).write.parquet(path)
    demand = spark.read.parquet(path)
    window_index(demand).write.parquet(f"{base}/index")
    settings = CheckSettings(
        f"{base}/champion", f"{base}/registry", f"{base}/deployments", f"{base}/models", baseline_mae=BASELINE,
        mae_limit=LIMIT, features=[LEARNED], lags=(1, 4), index_path=f"{base}/index")
    save_model(train(range_rows(demand, None, FIRST_END, settings.lags), linear_model(), [LEARNED]), settings.model_path)
    weeks = weekly_retraining(spark, demand, week_ends(START, WEEKS), FIRST_END, settings, linear_model())
    return rounded(weeks.drop("error"))


@query("m15_error_table", sql_over("preds", extra=ZONES, body="""
SELECT pickup_window AS "Time", coalesce(name, 'Unknown') AS "Location", round(y, 1) AS "Actual", round(by_challenger, 1) AS "Predicted",
  round(y - by_challenger, 2) AS "Error", round(abs(y - by_challenger), 2) AS "Abs Error",
  round(abs(y - by_challenger) / (y + 1e-10) * 100, 1) AS "Error %"
FROM (SELECT *, CAST(actual_demand AS DOUBLE) AS y FROM preds) LEFT JOIN zones USING (PULocationID)
ORDER BY pickup_window DESC, PULocationID LIMIT 20"""))
def errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = error_table(with_zone(ad.predictions(spark, sf_dir), how="left"), predicted="by_challenger")
    newest = head(rows, 20, F.desc(WINDOW), ZONE)
    return newest.select(
        F.col(WINDOW).alias("Time"), F.col("name").alias("Location"),
        F.round(F.col(DEMAND).cast("double"), 1).alias("Actual"), F.round("by_challenger", 1).alias("Predicted"),
        F.round("error", 2).alias("Error"), F.round("abs_error", 2).alias("Abs Error"),
        F.round("error_pct", 1).alias("Error %"))
