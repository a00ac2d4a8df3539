"""The end-to-end check: performance, drift, decision, retraining, comparison, deployment."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlab.operators.lifecycle import (
    append_deployment, append_version, claim_version, registry_row, retrain_decision,
)
from demandlab.operators.metrics import compare_models, performance_check
from demandlab.operators.models import load_model, save_model, score
from demandlab.operators.ranking import settle
from demandlab.plans.drift_check import check_drift, range_rows
from demandlab.plans.training import retrain
from demandlab.schemas import CHECK_REPORT, FEATURES, LAGS
from demandlab.sources.reports import read_registry


# What data, storage or a deployment can do to a check.
FAILURES = (PySparkException, Py4JError, OSError, ValueError, RuntimeError)


@dataclass
class CheckSettings:
    """Where the model lives and what triggers retraining."""

    model_path: str
    registry_path: str
    deployments_path: str
    models_dir: str
    baseline_mae: float = 2.32
    mae_limit: float = 2.5
    p_limit: float = 0.05
    days_back: int = 7
    reference_days: int = 30
    training_days: int = 30
    dry_run: bool = False
    force_retrain: bool = False
    features: list[str] = field(default_factory=lambda: list(FEATURES))
    lags: tuple[int, ...] = LAGS
    index_path: str | None = None  # a stored window_index of the demand table bounds how far back is read


def _back(end: str, days: int) -> str:
    return (datetime.fromisoformat(end) - timedelta(days=days)).isoformat(sep=" ")


def run_check(spark: SparkSession, demand: DataFrame, end: str, reference_end: str, run_at: str,
              settings: CheckSettings, learner=None, deploy: Callable[[str], None] | None = None) -> DataFrame:
    """Runs one check and returns its report as one row.

    Only single-row metric tables reach the driver; the feature rows of the
    checked window are persisted because four steps read them.
    """
    report: dict = {"timestamp": run_at, "actions_taken": [], "config": {
        "days_back": settings.days_back, "end_date": end, "dry_run": settings.dry_run,
        "force_retrain": settings.force_retrain, "reference_days": settings.reference_days}}
    index = spark.read.parquet(settings.index_path) if settings.index_path else None
    rows = range_rows(demand, _back(end, settings.days_back), end, settings.lags, index).persist()
    try:
        _steps(spark, demand, index, rows, end, reference_end, run_at, settings, learner, deploy, report)
    except FAILURES as problem:  # the report must say what went wrong; mistakes in the code are raised
        report["status"] = "error"
        report["error"] = f"{type(problem).__name__}: {problem}"
    finally:
        rows.unpersist()
    return spark.createDataFrame([{name: report.get(name) for name in CHECK_REPORT.fieldNames()}], CHECK_REPORT)


def _steps(spark, demand, index, rows, end, reference_end, run_at, settings, learner, deploy, report) -> None:
    actions = report["actions_taken"]
    report["production_data_records"] = rows.count()
    if report["production_data_records"] == 0:
        report["status"] = "no_data"
        return
    champion = load_model(settings.model_path)
    performance = performance_check(score(champion, rows), settings.baseline_mae)
    reference = range_rows(demand, _back(reference_end, settings.reference_days), reference_end, settings.lags,
                           index)
    _, drift = check_drift(reference, rows, settings.features, p_limit=settings.p_limit)
    state = performance.withColumn("_d", drift.select(F.struct("*")).scalar()).select("*", "_d.*").drop("_d")
    decision = retrain_decision(state, settings.mae_limit).first()
    report["performance_metrics"] = {
        k: decision[k] for k in ("mae", "rmse", "r2", "mae_increase_pct", "samples")
    }
    report["drift_summary"] = {
        k: decision[k] for k in ("total_features", "drifted_features", "drift_detected", "drifted_feature_names")
    }
    report["should_retrain"] = settings.force_retrain or decision["should_retrain"]
    report["retrain_reasons"] = "Force retrain flag enabled" if settings.force_retrain else decision["reason"]
    if not report["should_retrain"]:
        report["status"] = "success_no_retrain"
        return
    actions.append("retrain_triggered")

    window_start = _back(end, settings.training_days)
    # Splitting, fitting and validating all read the training rows.
    training = range_rows(demand, window_start, end, settings.lags, index).persist()
    try:
        challenger, metrics = retrain(training, learner, settings.features)
        metrics = settle(metrics, "validation-metrics")
    finally:
        training.unpersist()
    # The same run, repeated after a failure, takes its own version up again.
    version = claim_version(spark, settings.registry_path, f"{run_at} {window_start} {end}")
    path = f"{settings.models_dir.rstrip('/')}/{version}"
    save_model(challenger, path, replace=True)
    append_version(registry_row(metrics, F.lit(version), path, run_at, window_start, end), settings.registry_path)
    report["new_model_version"] = version
    actions.append("model_retrained")

    both = score(challenger, score(champion, rows, "by_champion"), "by_challenger")
    result = compare_models(both, "by_champion", "by_challenger", ("current", "new")).first()
    report["model_comparison"] = {
        k: result[k] for k in ("champion_mae", "challenger_mae", "winner", "mae_improvement_pct")
    }
    if result["winner"] != "new":
        actions.append("deployment_skipped_worse_performance")
        report["status"] = "success_no_deployment"
    elif settings.dry_run:
        actions.append("deployment_skipped_dry_run")
        report["status"] = "success_dry_run"
    else:
        _deploy(spark, version, path, run_at, settings, deploy, report)


def _deploy(spark, version, path, run_at, settings, deploy, report) -> None:
    try:
        if deploy is not None:
            deploy(path)
        append_deployment(read_registry(spark, settings.registry_path), version, run_at, settings.deployments_path)
    except FAILURES as problem:
        report["actions_taken"].append("deployment_failed")
        report["status"] = "failure_deployment"
        report["error"] = f"{type(problem).__name__}: {problem}"
        return
    report["actions_taken"].append("model_deployed")
    report["status"] = "success_deployed"
