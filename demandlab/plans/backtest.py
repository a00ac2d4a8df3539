"""Weekly checks over past data: in one grouped job, or in turn with retraining."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlab.operators.drift import drift_summary, drift_table, grouped_sample_counts, integer_features
from demandlab.operators.lifecycle import retrain_decision
from demandlab.operators.metrics import performance_check
from demandlab.plans.continual import CheckSettings, run_check
from demandlab.schemas import BOOL, DBL, DEMAND, FEATURES, LONG, STR, WINDOW, ZONE, table

RETRAINED_WEEK = table(week_end=STR, status=STR, records=LONG, mae=DBL, should_retrain=BOOL, champion=STR,
                       new_version=STR, winner=STR, champion_mae=DBL, challenger_mae=DBL, error=STR)


def week_ends(start: date, weeks: int) -> list[date]:
    return [start + timedelta(weeks=w) for w in range(1, weeks + 1)]


def by_week(rows: DataFrame, ends: Sequence[date], days_back: int = 7, ts: str = WINDOW) -> DataFrame:
    """Each row once per week end whose trailing days hold it (both ends included)."""
    listed = F.array(*[F.lit(str(e)) for e in ends])
    t = F.col(ts)

    def holds(end):
        stop = end.cast("timestamp_ntz")
        return (t <= stop) & (t >= stop - F.make_dt_interval(F.lit(days_back)))

    return rows.withColumn("week_end", F.explode(F.filter(listed, holds)))


def weekly_checks(rows: DataFrame, reference: DataFrame, ends: Sequence[date], baseline_mae: float,
                  predicted: str = "predicted", features: Sequence[str] = FEATURES,
                  categorical: Sequence[str] = (ZONE,), days_back: int = 7) -> DataFrame:
    """Performance, drift and retraining decision of every week; weeks without rows are absent."""
    weekly = by_week(rows, ends, days_back)
    performance = performance_check(weekly, baseline_mae, DEMAND, predicted, ["week_end"])
    counts = grouped_sample_counts(reference, weekly, "week_end", [str(e) for e in ends], features)
    table = drift_table(counts, categorical, integer_features(reference, categorical), ["week_end", "feature"])
    drift = drift_summary(table, ["week_end"], features)
    # One row per listed week on both sides.
    return retrain_decision(performance.join(F.broadcast(drift), "week_end"))


def weekly_retraining(spark: SparkSession, demand: DataFrame, ends: Sequence[date], reference_end: str,
                      settings: CheckSettings, learner=None) -> DataFrame:
    """One row per week: the whole check with retraining, each week judging the champion the week before left.

    Every week sees only rows up to its end; its training set is the trailing window of the settings.
    The weeks are a short list and run in turn, since each needs the champion of the one before; what
    reaches the driver is one report a week. ``champion`` is the version that was judged, ``v0`` the first model.
    """
    champion, weeks = "v0", []
    for end in ends:
        path = settings.model_path if champion == "v0" else f"{settings.models_dir.rstrip('/')}/{champion}"
        report = run_check(spark, demand, f"{end} 00:00:00", reference_end, f"{end}T00:00:00",
                           replace(settings, model_path=path), learner).first()
        compared = report["model_comparison"]
        weeks.append((
            str(end), report["status"], report["production_data_records"],
            report["performance_metrics"] and report["performance_metrics"]["mae"], report["should_retrain"], champion,
            report["new_model_version"], compared and compared["winner"], compared and compared["champion_mae"],
            compared and compared["challenger_mae"], report["error"]))
        if report["status"] == "success_deployed":
            champion = report["new_model_version"]
    return spark.createDataFrame(weeks, RETRAINED_WEEK)


def backtest_summary(checks: DataFrame, weeks: int) -> DataFrame:
    events = F.count_if("should_retrain")
    return checks.agg(
        F.lit(weeks).alias("total_weeks"), events.alias("retrain_events"),
        (events / F.lit(float(weeks))).alias("retrain_frequency"),
    )
