from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandlab.operators.metrics import (
    METRIC_NAMES, compare_models, guarded_metrics, leaderboard, regression_metrics, running_score,
)
from demandlab.operators.observability import histogram, histogram_quantiles, sustained
from demandlab.operators.sampling import fixed_sample, label_by_month, label_by_position, split_by_month
from demandlab.sources.logs import metric_rows


@pytest.fixture(scope="module")
def forecasts(spark):
    rng = np.random.default_rng(11)
    y = rng.integers(0, 40, 801)
    p = y + rng.normal(0.5, 3, 801)
    rows = [("m", int(a), float(b), float(b + 1)) for a, b in zip(y, p)]
    return spark.createDataFrame(rows, "model string, actual_demand bigint, predicted double, other double"), y, p


def test_metric_set(forecasts):
    df, y, p = forecasts
    row, e = regression_metrics(df).first(), p - y
    want = {
        "rmse": np.sqrt((e**2).mean()), "mae": abs(e).mean(), "median_ae": np.median(abs(e)), "bias": e.mean(),
        "max_error": abs(e).max(), "within_5_trips": (abs(e) <= 5).mean() * 100,
        "within_10_pct": (abs(e / (y + 1e-8)) <= 0.1).mean() * 100,
        "r2_score": 1 - (e**2).sum() / ((y - y.mean()) ** 2).sum(),
        "mape": (abs(e) / np.maximum(abs(y), np.finfo(float).eps)).mean() * 100,
    }
    for name in METRIC_NAMES:
        assert row[name] == pytest.approx(want[name], rel=1e-9), name


def test_constant_target_has_no_r2(spark):
    df = spark.createDataFrame([("m", 2, 1.0), ("m", 2, 3.0)], "model string, actual_demand bigint, predicted double")
    assert regression_metrics(df).first()["r2_score"] is None
    assert guarded_metrics(df).first()["r2"] == pytest.approx(1 - 2 / 1e-10)


def test_champion_needs_a_strictly_better_challenger(forecasts):
    df, _, _ = forecasts
    assert compare_models(df, "predicted", "predicted").first()["winner"] == "v1"
    assert compare_models(df, "other", "predicted").first()["winner"] == "v2"


def test_leaderboard_ties_and_bias(spark):
    wide = spark.createDataFrame([("a", 1.0, -5.0, 0.9), ("b", 1.0, 0.1, 0.8)],
                                 "model string, mae double, bias double, r2_score double")
    names = ["mae", "bias", "r2_score"]
    rows = metric_rows(wide, names, ["model"])
    wins = {r["model"]: r["wins"] for r in leaderboard(rows, names).collect()}
    assert wins == {"a": 3, "b": 1}
    by_size = {r["model"]: (r["wins"], r["is_winner"]) for r in leaderboard(rows, names, bias="abs", order=["b", "a"]).collect()}
    assert by_size == {"a": (2, False), "b": (2, True)}


def test_running_score_of_nothing(spark):
    df = spark.createDataFrame([], "y double, p double, ok boolean")
    row = running_score(df, "y", "p", F.col("ok")).first()
    assert (row["total_requests"], row["mae"], row["success_rate_pct"]) == (0, None, 0.0)


def test_histogram_quantile(spark):
    df = spark.createDataFrame([(v,) for v in [0.5, 1.5, 1.6, 1.7, 9.0]], "x double").withColumn("l", F.lit("a"))
    buckets = histogram(df, "x", [1.0, 2.0, 4.0], ["l"])
    assert sorted(r["cumulative"] for r in buckets.collect()) == [1, 4, 4, 5]
    found = {r["q"]: r["estimate"] for r in histogram_quantiles(buckets, [0.5, 0.99], ["l"]).collect()}
    assert found[0.5] == pytest.approx(1 + (2.5 - 1) / 3)
    assert found[0.99] == 4.0


def test_sustained_runs(spark):
    minutes = [0, 1, 2, 3, 4, 5, 9, 10]
    rows = spark.createDataFrame([("a", m, True) for m in minutes] + [("a", 6, False)], "l string, m int, violating boolean")
    stamped = rows.withColumn("window_end", F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(mins="m"))
    runs = sustained(stamped, ["l"], 5).collect()
    assert [(r["windows"], r["minutes"]) for r in runs] == [(6, 5)]


def test_fixed_sample(spark):
    df = spark.range(20_000).withColumn("half", F.lit(1))
    first = [r["id"] for r in fixed_sample(df, 500, ["id"]).collect()]
    assert len(first) == len(set(first)) == 500
    assert sorted(first) == sorted(r["id"] for r in fixed_sample(df.repartition(13), 500, ["id"]).collect())
    by_hash = df.withColumn("h", F.md5(F.concat_ws("|", F.lit("42"), F.col("id").cast("string")))).orderBy("h").limit(500)
    assert sorted(first) == sorted(r["id"] for r in by_hash.collect())
    assert fixed_sample(df, 50_000, ["id"]).count() == 20_000
    # Few hash prefixes, so the completing prefix holds many rows.
    assert sorted(first) == sorted(r["id"] for r in fixed_sample(df, 500, ["id"], prefix_bits=4).collect())


@pytest.mark.parametrize("n, share", [(100, 0.8), (7, 0.5), (1, 0.8), (3, 0.0), (4, 1.0)])
def test_position_split(spark, n, share):
    rows = [(z, i) for z in (9, 3, 5) for i in range(n)]
    df = spark.createDataFrame(rows, "PULocationID int, i int")
    df = df.withColumn("pickup_window", F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("i")))
    got = sorted((r["PULocationID"], r["i"], r["part"]) for r in label_by_position(df, share).collect())
    cut = int(len(rows) * share)
    assert got == [(z, i, "train" if k < cut else "validation") for k, (z, i) in enumerate(sorted(rows))]


def test_month_split_is_disjoint_and_complete(spark, sf_dir):
    from demandlab.catalog import adapters

    df = adapters.demand_orders(spark, sf_dir)
    train, validation = split_by_month(df, 10)
    labelled = {r["part"]: r["n"] for r in label_by_month(df, 10).groupBy("part").agg(F.count("*").alias("n")).collect()}
    assert labelled == {"train": train.count(), "validation": validation.count()}
    assert sum(labelled.values()) == df.count()
    assert train.agg(F.max("year_month")).first()[0] < validation.agg(F.min("year_month")).first()[0]
