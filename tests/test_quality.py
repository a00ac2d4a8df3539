from __future__ import annotations

import pytest

from demandlab.operators.quality import (
    consistency_check, quality_profile, split_valid, valid_rows, validated_requests, validation_summary,
    with_rule_errors, write_split,
)

COLUMNS = ("PULocationID int, hour int, day_of_week int, month int, lag_1 double, lag_4 double, lag_96 double, "
           "rolling_mean_4 double")
GOOD = (237, 18, 4, 6, 15.0, 18.0, 20.0, 16.5)


def rows(spark, *changes):
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    made = [tuple(change.get(n, v) for n, v in zip(names, GOOD)) for change in changes]
    return spark.createDataFrame(made, COLUMNS)


def errors(df):
    return with_rule_errors(df).first()["errors"]


def test_good_row(spark):
    assert errors(rows(spark, {})) == []


def test_null_suppresses_the_other_rules_of_its_column(spark):
    assert errors(rows(spark, {"lag_1": None, "hour": 24})) == [
        "hour: Value 24.0 out of range [0, 23]", "lag_1: Value is None or NaN"]
    assert errors(rows(spark, {"lag_1": float("nan")})) == ["lag_1: Value is None or NaN"]


def test_extreme_value(spark):
    assert errors(rows(spark, {"lag_1": 67.55})) == ["lag_1: Statistical anomaly detected (z-score: 5.25)"]
    assert errors(rows(spark, {"lag_1": -40.0})) == [
        "lag_1: Value -40.0 out of range [0, inf]", "lag_1: Statistical anomaly detected (z-score: 5.50)"]


def test_missing_column_fails_every_row(spark):
    df = rows(spark, {}, {}).drop("lag_4")
    assert errors(df) == ["Missing features: lag_4"]
    assert valid_rows(df).count() == 0


def test_summary_and_split_agree(spark):
    df = rows(spark, {}, {"month": 13}, {"lag_96": None}, {})
    row = validation_summary(df).first()
    assert (row["total_records"], row["valid_records"], row["invalid_records"], row["validation_rate"]) == (4, 2, 2, 50.0)
    good, bad = split_valid(with_rule_errors(df))
    assert (good.count(), bad.count(), valid_rows(df).count()) == (2, 2, 2)


def test_empty_batch(spark):
    row = validation_summary(rows(spark, {}).limit(0)).first()
    assert (row["total_records"], row["validation_rate"]) == (0, None)


def test_sample_request_is_valid(spark):
    sample = {
        "PULocationID": 237, "hour": 18, "day_of_week": 4, "month": 6, "is_weekend": 0, "is_rush_hour": 1,
        "day_of_month": 15, "week_of_year": 24, "time_of_day": 2, "season": 2, "is_manhattan": 1, "lag_1": 15.0,
        "lag_4": 18.0, "lag_24": 17.5, "lag_96": 20.0, "lag_672": 18.5, "rolling_mean_4": 16.5, "rolling_std_4": 3.2,
        "rolling_max_24": 25.0, "rolling_min_24": 10.0}
    df = spark.createDataFrame([sample, {**sample, "hour": 24, "lag_1": None}])
    found = [r["errors"] for r in validated_requests(df).collect()]
    assert found == [[], ["hour: not in [0, 23]", "lag_1: missing"]]


def test_consistency(spark):
    df = spark.createDataFrame(
        [(1, 4, 10.0, 1.0, 2.0, 5.0), (1, 4, 1.0, 1.0, 1.0, 100.0), (2, 4, 1.0, 1.0, 1.0, 1.0)],
        "pickup_window int, PULocationID int, lag_1 double, lag_4 double, lag_96 double, rolling_mean_4 double")
    row = consistency_check(df).first()
    assert (row["lag_inconsistent"], row["mean_inconsistent"], row["duplicate_rows"], row["consistency_check"]) == (
        1, 1, 1, "failed")
    assert consistency_check(df.filter("pickup_window = 2")).first()["consistency_check"] == "passed"


def test_a_missing_value_is_not_inconsistent(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1, 4, nan, 1.0, 2.0, nan), (2, 4, None, 1.0, 1.0, 100.0), (3, 4, 9.0, 1.0, nan, 5.0)],
                               "pickup_window int, PULocationID int, lag_1 double, lag_4 double, lag_96 double, rolling_mean_4 double")
    assert consistency_check(df).first()["consistency_check"] == "passed"
    assert consistency_check(df.drop("lag_96", "rolling_mean_4")).first()["consistency_check"] == "passed"


def test_profile_counts_outliers_and_missing(spark):
    df = rows(spark, *[{"lag_1": float(v)} for v in [1, 2, 3, 4, 100]], {"lag_1": None})
    row = {r["feature"]: r for r in quality_profile(df).collect()}["lag_1"]
    assert (row["missing_count"], row["outlier_count"], row["median"], row["data_type"]) == (1, 1, 3.0, "double")
    assert row["outlier_pct"] == pytest.approx(100 / 6)


def test_split_makes_every_row_once_and_keeps_all(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    source = rows(spark, {}, {"month": 13}, {"lag_96": None}, {"lag_1": 67.55}, {})
    write_split(source.mapInArrow(seen, source.schema), f"{tmp_path}/good", f"{tmp_path}/bad")
    assert made.value == 5
    assert spark.read.parquet(f"{tmp_path}/good").columns == source.columns
    assert spark.read.parquet(f"{tmp_path}/good").count() == 2
    bad = spark.read.parquet(f"{tmp_path}/bad")
    assert sorted(r["errors"] for r in bad.collect()) == [
        ["lag_1: Statistical anomaly detected (z-score: 5.25)"], ["lag_96: Value is None or NaN"],
        ["month: Value 13.0 out of range [1, 12]"]]
    assert "lambda" not in with_rule_errors(source)._jdf.queryExecution().toString()
