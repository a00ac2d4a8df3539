from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from demandlab.functions import calendar as cal
from demandlab.functions import numeric as num
from demandlab.functions.documents import join_reasons, two_decimals


def values(df):
    return [r[0] for r in df.collect()]


def test_time_of_day_is_right_closed(spark):
    hours = spark.createDataFrame([(h,) for h in (0, 6, 7, 12, 13, 18, 19, 23)], "h int")
    assert values(hours.select(cal.time_of_day(F.col("h")))) == [0, 0, 1, 1, 2, 2, 3, 3]


def test_iso_week_and_monday_based_day(spark):
    days = spark.createDataFrame([("2024-12-30",), ("2025-01-05",), ("2023-01-01",)], "d string")
    ts = F.col("d").cast("timestamp_ntz")
    assert [tuple(r) for r in days.select(cal.iso_week(ts), cal.day_of_week(ts)).collect()] == [(1, 0), (1, 6), (52, 6)]


def test_seasons(spark):
    months = spark.createDataFrame([(m,) for m in range(1, 13)], "m int")
    assert values(months.select(cal.season(F.col("m")))) == [0, 0, 1, 1, 1, 2, 2, 2, 3, 3, 3, 0]


def test_times_do_not_depend_on_the_session_zone(spark):
    rows = spark.createDataFrame(
        [(datetime(2024, 3, 10, 1, 59, 30), datetime(2024, 3, 10, 3, 0, 30, 500000))], "a timestamp_ntz, b timestamp_ntz")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = rows.select(cal.floor_minutes("a"), cal.seconds_between("a", "b"), cal.epoch_seconds("a")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert tuple(row) == (datetime(2024, 3, 10, 1, 45), 3660.5, 1710035970)


def test_nan_and_null_guards(spark):
    x = spark.createDataFrame([(float("nan"),), (None,), (-1.0,), (2.0,), (float("inf"),)], "x double")
    assert values(x.select(num.non_negative(F.col("x")))) == [0.0, None, 0.0, 2.0, float("inf")]
    assert values(x.select(num.is_finite(F.col("x")))) == [False, False, True, True, False]
    assert values(x.select(num.nan_to_null(F.col("x"))))[:2] == [None, None]


@pytest.mark.parametrize("policy, expected", [("add", 0.5), ("floor", 0.5)])
def test_percent_error(spark, policy, expected):
    row = spark.range(1).select(num.percent_error(F.lit(-1.0), F.lit(2.0), 1e-12, policy)).first()
    assert row[0] == pytest.approx(expected)


def test_unknown_percent_policy():
    with pytest.raises(ValueError):
        num.percent_error(F.lit(1.0), F.lit(1.0), 0.1, "other")


def test_two_decimals_matches_exact_rounding(spark):
    numbers = [5.255, 5.125, 5.375, 67.005, 5.0, 8.115, 4096.125, 123456.785, 0.125, 0.005, 54.999, 1e7 + 0.625, 5e9 + 0.125, 1e15]
    df = spark.createDataFrame([(v,) for v in numbers], "x double")
    assert values(df.select(two_decimals(F.col("x")))) == [f"{v:.2f}" for v in numbers]


def test_join_reasons_default(spark):
    row = spark.range(1).select(
        join_reasons(F.lit(None).cast("string"), default="fine"), join_reasons(F.lit("a"), F.lit("b"))).first()
    assert tuple(row) == ("fine", "a | b")
