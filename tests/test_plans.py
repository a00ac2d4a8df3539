"""The physical plans must stay ones that scale."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from demandlab.catalog import adapters, all_queries
from demandlab.operators.cleaning import clean_trips, keep_first
from demandlab.operators.features import recent_per_zone
from demandlab.operators.sampling import label_by_position
from demandlab.schemas import TRIPS, WINDOW, ZONE
from demandlab.session import scratch_path
from demandlab.sources.trips import read_trips


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


HEAVY = [
    "a1_demand_15min", "a3_cleaning_funnel", "a11_regression_metrics", "a18_latency_histogram", "d1_reference_stats",
    "d2_ks", "d3_psi_values", "d4_feature_drift", "d5_prediction_drift", "j6_prediction_vs_history",
    "j9_week_ago_comparison", "m2_position_split", "o7_fixed_sample", "q2_batch_validation", "q4_quality_profile",
    "u3_keep_first", "w6_feature_builder", "w6_feature_builder_spans", "w10_request_rates",
]


@pytest.mark.parametrize("name", HEAVY)
def test_no_cross_join_and_no_python(spark, sf_dir, name):
    text = plan(all_queries()[name](spark, sf_dir))
    for word in ("CartesianProduct", "NestedLoop", "ArrowEvalPython", "BatchEvalPython", "InPandas"):
        assert word not in text, word


def test_cleaning_filters_reach_the_scan(spark):
    path = f"{scratch_path(spark, 'plan')}/trips_2024-01.parquet"
    spark.createDataFrame([], TRIPS).write.parquet(path)
    cleaned = clean_trips(read_trips(spark, path), 2024).select("tpep_pickup_datetime", ZONE)
    text = cleaned._sc._jvm.PythonSQLUtils.explainString(cleaned._jdf.queryExecution(), "formatted")
    assert "regexp" not in text
    assert "GreaterThanOrEqual(tpep_pickup_datetime,2024-01-01" in text
    assert "LessThan(tpep_pickup_datetime,2025-01-01" in text
    assert "GreaterThan(trip_distance,0.0)" in text


def test_only_needed_columns_are_read(spark, sf_dir):
    text = plan(adapters.demand(spark, sf_dir))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in text


def test_copies_are_reduced_before_the_shuffle(spark, sf_dir):
    text = plan(keep_first(adapters.events(spark, sf_dir), [ZONE], ["ts", "event_id"]))
    assert "partial_min_by" in text and "Window" not in text


def test_groups_are_limited_before_the_shuffle(spark, sf_dir):
    text = plan(recent_per_zone(adapters.events(spark, sf_dir).withColumnRenamed("ts", WINDOW), 20))
    assert "WindowGroupLimit" in text


def test_labelled_rows_are_not_shuffled(spark, sf_dir):
    rows = adapters.events(spark, sf_dir).select(F.col("ts").alias(WINDOW), ZONE, "value")
    text = plan(label_by_position(rows))
    assert "Exchange" not in text.split("Subquer")[0]
