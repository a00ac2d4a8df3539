from __future__ import annotations

from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandlab.functions.calendar import with_window_parts
from demandlab.operators.lifecycle import current_version, model_history, retrain_decision
from demandlab.operators.models import linear_model, load_model, save_model, score, train
from demandlab.plans.backtest import backtest_summary, by_week, week_ends
from demandlab.plans.continual import CheckSettings, run_check
from demandlab.plans.drift_check import range_rows
from demandlab.schemas import CHECK_REPORT, DEMAND, MODEL_REGISTRY, WINDOW, ZONE
from demandlab.session import scratch_path
from demandlab.sources.reports import append_report, newest_reports, read_registry

LAGS, COLUMNS = (1, 4), ["hour", "lag_1", "lag_4"]
END = "2024-01-13 00:00:00"


@pytest.fixture(scope="module")
def demand(spark):
    rng = np.random.default_rng(4)
    rows = []
    for zone in (4, 161):
        for i in range(96 * 12):
            hour = i // 4 % 24
            rows.append((datetime(2024, 1, 1) + timedelta(minutes=15 * i), zone, int(10 + hour + rng.integers(0, 3))))
    made = spark.createDataFrame(rows, f"{WINDOW} timestamp_ntz, {ZONE} int, {DEMAND} bigint")
    return with_window_parts(made).persist()


@pytest.fixture(scope="module")
def weak_model(spark, demand):
    """Trained on the first hours only, so it is easy to beat."""
    path = scratch_path(spark, "weak")
    early = range_rows(demand, "2024-01-01", "2024-01-01 06:00:00", LAGS)
    save_model(train(early, linear_model(), ["hour"]), path)
    return path


def settings(spark, model_path, **changes):
    base = scratch_path(spark, "lifecycle")
    given = dict(model_path=model_path, registry_path=f"{base}/registry", deployments_path=f"{base}/deployments",
                 models_dir=f"{base}/models", days_back=2, reference_days=5, training_days=8, features=COLUMNS, lags=LAGS)
    return CheckSettings(**{**given, **changes})


def check(spark, demand, chosen, **options):
    return run_check(spark, demand, END, "2024-01-08", "2024-01-13T00:00:00", chosen, linear_model(), **options).first()


def test_deploys_a_better_model(spark, demand, weak_model):
    chosen = settings(spark, weak_model)
    report = check(spark, demand, chosen)
    assert report["error"] is None and report["status"] == "success_deployed"
    assert report["actions_taken"] == ["retrain_triggered", "model_retrained", "model_deployed"]
    assert report["model_comparison"]["winner"] == "new" and report["new_model_version"] == "v1"
    assert report["performance_metrics"]["samples"] == report["production_data_records"]
    events = spark.read.schema("version string, deployed_at string").json(chosen.deployments_path)
    assert current_version(events).first()["current_production"] == "v1"
    registered = read_registry(spark, chosen.registry_path)
    assert registered.count() == 1
    assert load_model(f"{chosen.models_dir}/v1").transform(range_rows(demand, "2024-01-12 23:45:00", END, LAGS)).count() == 2


def test_dry_run_and_failed_deployment(spark, demand, weak_model):
    report = check(spark, demand, settings(spark, weak_model, dry_run=True))
    assert report["status"] == "success_dry_run"

    def broken(path):
        raise OSError("disk full")

    report = check(spark, demand, settings(spark, weak_model), deploy=broken)
    assert report["status"] == "failure_deployment" and "disk full" in report["error"]


def test_nothing_to_do_forced_or_no_data(spark, demand):
    path = scratch_path(spark, "good")
    save_model(train(range_rows(demand, None, END, LAGS), linear_model(), COLUMNS), path)
    calm = dict(baseline_mae=100.0, mae_limit=100.0, p_limit=0.0)
    report = check(spark, demand, settings(spark, path, **calm))
    assert (report["status"], report["retrain_reasons"]) == ("success_no_retrain", "All checks passed")
    report = check(spark, demand, settings(spark, path, force_retrain=True, **calm))
    assert report["retrain_reasons"] == "Force retrain flag enabled" and "model_retrained" in report["actions_taken"]
    empty = check(spark, demand.filter(F.col(WINDOW) < "2024-01-02"), settings(spark, path))
    assert empty["status"] == "no_data"
    assert check(spark, demand, settings(spark, "/nowhere/at/all"))["status"] == "error"


def test_report_round_trip(spark):
    path = scratch_path(spark, "reports")
    for day in range(1, 13):
        row = spark.createDataFrame([{"timestamp": f"2024-01-{day:02d}", "status": "s"} | {
            n: None for n in CHECK_REPORT.fieldNames() if n not in ("timestamp", "status")}], CHECK_REPORT)
        append_report(row, path, f"202401{day:02d}_000000")
    found = [r["timestamp"] for r in newest_reports(spark, path, CHECK_REPORT).collect()]
    assert found == [f"2024-01-{d:02d}" for d in range(12, 2, -1)]


def test_decision_texts(spark):
    schema = ("mae double, mae_increase_pct double, drift_detected boolean, drifted_features bigint, "
              "drifted_feature_names array<string>")
    rows = [(2.7, 30.26, True, 2, ["hour", "lag_1"]), (2.5, 20.0, False, 0, [])]
    first, second = retrain_decision(spark.createDataFrame(rows, schema)).collect()
    assert first["reason"] == ("Performance degradation: MAE 2.7000 > threshold 2.5000 | MAE increased by 30.3% "
                               "(threshold: 20%) | Data drift in 2 features: ['hour', 'lag_1']")
    assert (second["should_retrain"], second["reason"]) == (False, "All checks passed")


def test_registry_defaults_and_history(spark):
    assert read_registry(spark, scratch_path(spark, "no-registry")).count() == 0
    row = spark.createDataFrame([("v1.0.0", "2025-12-27T20:59:00", "models/m", (2.32, 4.47, 0.9626, 29.5),
                                  ("2024-01-01", "2024-12-31", 500000), True, "2025-12-27T20:59:00")], MODEL_REGISTRY)
    shown = model_history(row).first()
    assert tuple(shown) == ("v1.0.0", "2025-12-27 20:59", "2.3200", True, True)


def test_week_windows_include_both_ends(spark, demand):
    ends = week_ends(date(2023, 12, 31), 2)
    rows = by_week(demand, ends)
    per_week = {r["week_end"]: r["count"] for r in rows.groupBy("week_end").count().collect()}
    assert per_week == {"2024-01-07": 6 * 192 + 2, "2024-01-14": 6 * 192}
    checks = spark.createDataFrame([(True,), (False,)], "should_retrain boolean")
    assert tuple(backtest_summary(checks, 4).first()) == (4, 1, 0.25)


def test_scores_are_never_negative(spark, demand):
    rows = range_rows(demand, None, END, LAGS).withColumn(DEMAND, F.lit(-5))
    assert score(train(rows, linear_model(), COLUMNS), rows).agg(F.max("predicted")).first()[0] == 0.0


def test_every_row_of_a_report_file_comes_back(spark):
    path = scratch_path(spark, "reports")
    rows = spark.createDataFrame([(i, f"line {i}") for i in range(3)], "n int, note string").coalesce(1)
    for day in range(1, 13):
        append_report(rows, path, f"2024-01-{day:02d}")
    got = newest_reports(spark, path, rows.schema, limit=2).collect()
    assert sorted(r["n"] for r in got) == [0, 0, 1, 1, 2, 2]
    assert {r["source_file"].split("run_at=")[1][:10] for r in got} == {"2024-01-12", "2024-01-11"}


def test_versions_are_never_named_twice(spark):
    from demandlab.operators.lifecycle import next_version

    nothing = spark.createDataFrame([], MODEL_REGISTRY)
    assert next_version(nothing).first()["version"] == "v1"
    some = nothing.select("version").union(spark.createDataFrame([("v1",), ("v10",), ("other",)], "version string"))
    assert next_version(some).first()["version"] == "v11"


def uneven(demand):
    """Zone 4 loses most of its windows, zone 161 ends early, zone 90 begins late."""
    hole = (F.col(ZONE) == 4) & (F.col("hour") % 6 != 0)
    late = demand.filter((F.col(ZONE) == 161) & (F.col(WINDOW) >= "2024-01-10")).withColumn(ZONE, F.lit(90))
    early = demand.filter(~hole & ((F.col(ZONE) == 4) | (F.col(WINDOW) < "2024-01-06")))
    return early.unionByName(late)


@pytest.mark.parametrize("lags", [(1, 4), (1, 30), (1, 200), (1, 5000)])
def test_a_bounded_look_back_gives_the_same_features(spark, demand, lags):
    from demandlab.plans.drift_check import look_back, window_index

    rows = uneven(demand)
    index = window_index(rows)
    whole = range_rows(rows, "2024-01-11", END, lags)
    bounded = range_rows(rows, "2024-01-11", END, lags, index)
    assert bounded.columns == whole.columns and bounded.exceptAll(whole).count() == 0
    assert bounded.count() == whole.count()
    since = {r[ZONE]: str(r["since"]) for r in look_back(index, "2024-01-11", END, lags).collect()}
    assert set(since) == {4, 90} and since[90] == "2024-01-10"
    # Zone 4 has 16 windows a day: 23 or 30 take two days, 200 more than there are.
    assert since[4] == ("2024-01-09" if max(lags) <= 30 else "2024-01-01" if max(lags) > 160 else since[4])


def test_the_look_back_reaches_the_scan(spark, demand):
    from demandlab.plans.drift_check import window_index

    path = scratch_path(spark, "demand")
    demand.write.parquet(path)
    stored = spark.read.parquet(path)
    bounded = range_rows(stored, "2024-01-11", END, LAGS, window_index(stored))
    text = bounded._sc._jvm.PythonSQLUtils.explainString(bounded._jdf.queryExecution(), "formatted")
    assert f"GreaterThanOrEqual({WINDOW}," in text or f"({WINDOW}#" in text and "Subquery" in text


def test_each_week_judges_the_champion_of_the_week_before(spark, demand, weak_model):
    from demandlab.plans.backtest import weekly_retraining
    from demandlab.plans.drift_check import window_index

    index = scratch_path(spark, "index")
    window_index(demand).write.parquet(index)
    chosen = settings(spark, weak_model, index_path=index, baseline_mae=0.5, mae_limit=0.5, p_limit=0.0)
    ends = [date(2024, 1, 6), date(2024, 1, 9), date(2024, 3, 1)]
    weeks = weekly_retraining(spark, demand, ends, "2024-01-04", chosen, linear_model()).orderBy("week_end").collect()
    assert [w["error"] for w in weeks] == [None] * 3
    first, second, third = weeks
    assert (first["champion"], first["new_version"], first["status"]) == ("v0", "v1", "success_deployed")
    # What was deployed is judged next, on the later rows.
    assert second["champion"] == "v1"
    rows = range_rows(demand, "2024-01-07", "2024-01-09 00:00:00", LAGS)
    judged = score(load_model(f"{chosen.models_dir}/v1"), rows).agg(
        F.avg(F.abs(F.col("predicted") - F.col(DEMAND)))).first()[0]
    assert second["mae"] == pytest.approx(judged) and second["mae"] < first["mae"]
    assert (third["status"], third["records"]) == ("no_data", 0)


def test_a_repeated_run_keeps_its_version(spark, demand, weak_model):
    chosen = settings(spark, weak_model, dry_run=True)
    versions = [check(spark, demand, chosen)["new_model_version"] for _ in range(2)]
    assert versions == ["v1", "v1"] and read_registry(spark, chosen.registry_path).count() == 1
