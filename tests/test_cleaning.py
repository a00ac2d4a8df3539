from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from demandlab.operators.cleaning import clean_trips, cleaning_funnel, duplicate_count, keep_first
from demandlab.operators.demand import build_demand, merge_demand
from demandlab.schemas import DEMAND, TRIPS, WINDOW, ZONE
from demandlab.session import scratch_path
from demandlab.sources.trips import check_columns, read_directory, read_trips, trailing

START = datetime(2024, 1, 5, 10, 7)


def trip(minutes, distance=1.0, zone=4, start=START):
    return start, start + timedelta(minutes=minutes), zone, distance


def frame(spark, rows, month=1):
    return spark.createDataFrame(rows, TRIPS).withColumn("expected_month", F.lit(month))


def test_duration_limits_are_strict(spark):
    rows = [trip(m) for m in (1.0, 1.0001, 299.99, 300.0)]
    assert clean_trips(frame(spark, rows), 2024).count() == 2


def test_nan_null_and_zero_distance_drop(spark):
    rows = [trip(10, d) for d in (float("nan"), None, 0.0, -1.0, 0.1)]
    assert clean_trips(frame(spark, rows), 2024).count() == 1


def test_null_zone_is_no_demand(spark):
    rows = frame(spark, [trip(10), trip(10, zone=None)])
    assert [(r[WINDOW], r[ZONE], r[DEMAND]) for r in build_demand(rows).collect()] == [
        (datetime(2024, 1, 5, 10, 0), 4, 1)]


def test_funnel_adds_up_and_counts_null_rows(spark):
    rows = [trip(10), trip(10, 0.0), trip(500), (START, None, 4, 1.0), (None, None, 4, 1.0),
            trip(10, start=datetime(2023, 1, 5)), trip(10, start=datetime(2024, 2, 5))]
    table = frame(spark, rows)
    for row in cleaning_funnel(table, 2024).collect():
        assert row["original_rows"] == row["date_dropped"] + row["quality_dropped"] + row["clean_rows"] == 7
        assert (row["date_dropped"], row["quality_dropped"], row["clean_rows"]) == (3, 3, 1)
    assert clean_trips(table, 2024).count() == 1


def test_funnel_of_nothing(spark):
    assert cleaning_funnel(frame(spark, []), 2024).filter("clean_rows > 0").count() == 0


def test_month_comes_from_the_file_name(spark):
    folder = scratch_path(spark, "months")
    rows = [trip(10), trip(10, start=datetime(2024, 2, 5)), trip(10, start=datetime(2023, 1, 5))]
    spark.createDataFrame(rows, TRIPS).write.parquet(f"{folder}/trips_2024-01.parquet")
    spark.createDataFrame(rows, TRIPS).write.parquet(f"{folder}/bad.parquet")
    assert clean_trips(read_trips(spark, f"{folder}/trips_2024-01.parquet"), 2024).count() == 1
    assert read_trips(spark, f"{folder}/trips_*.parquet").agg(F.max("expected_month")).first()[0] == 1
    lax = read_trips(spark, f"{folder}/bad.parquet", strict_month=False)
    assert lax.filter("expected_month IS NULL").count() == 3
    with pytest.raises(PySparkException, match="no month in file name"):
        read_trips(spark, f"{folder}/bad.parquet").collect()


def test_empty_directory_is_an_error(spark, sf_dir):
    with pytest.raises(Exception):
        read_directory(spark, sf_dir, "nothing-*.parquet", TRIPS)


def test_required_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert check_columns(df, ["a"]) == ["b"]
    with pytest.raises(ValueError, match="missing"):
        check_columns(df, ["a", "c"])


def test_duplicates(spark):
    rows = spark.createDataFrame([(1, 4, 3), (1, 4, 1), (1, 4, 2), (2, 4, 9)], "w int, z int, o int")
    assert duplicate_count(rows, ["w", "z"]).first()[0] == 2
    assert sorted(tuple(r) for r in keep_first(rows, ["w", "z"], ["o"]).collect()) == [(1, 4, 1), (2, 4, 9)]
    assert duplicate_count(rows.limit(0), ["w", "z"]).first()[0] == 0


def test_partial_demand_merges_to_the_whole(spark, sf_dir):
    from demandlab.catalog import adapters

    rows = adapters.events(spark, sf_dir)
    parts = [build_demand(rows.filter(F.col("event_id") % 3 == i), ts="ts") for i in range(3)]
    merged = merge_demand(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    whole = build_demand(rows, ts="ts")
    assert merged.exceptAll(whole).count() == 0 and whole.exceptAll(merged).count() == 0
    assert whole.agg(F.sum(DEMAND)).first()[0] == rows.count()


def test_trailing_cutoff_reaches_the_scan(spark, sf_dir):
    from demandlab.catalog import adapters

    plan = trailing(adapters.events(spark, sf_dir), "ts", hours=24)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" in text and "CartesianProduct" not in text and "NestedLoop" not in text
