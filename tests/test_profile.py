"""A profile must give the drift table of the samples themselves."""

from __future__ import annotations

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandlab.operators.drift import feature_drift
from demandlab.operators.profile import extend_profile, profile_drift, read_profile, write_profile
from demandlab.session import scratch_path

NAMES = ["a", "b", "zone"]


def sample(spark, n, seed, shift=0.0):
    rng = np.random.default_rng(seed)
    rows = [(float(x) if x > -1.5 else None, float(np.round(y, 1)), int(z)) for x, y, z in zip(
        rng.normal(shift, 1, n), rng.normal(0, 2, n), rng.integers(1, 9, n), strict=True)]
    return spark.createDataFrame(rows, "a double, b double, zone int").repartition(3)


def rows(df):
    return {r["feature"]: r.asDict() for r in df.collect()}


def check(got, want):
    assert got.keys() == want.keys()
    for feature, row in want.items():
        assert got[feature] == pytest.approx(row, nan_ok=True), feature


def profiled(spark, reference, slice_values=7):
    path = scratch_path(spark, "profile-test")
    write_profile(reference, path, NAMES, ["zone"], slice_values)
    return read_profile(spark, path)


@pytest.mark.parametrize("shift", [0.0, 0.4, 50.0, -50.0])
def test_equal_to_the_samples(spark, shift):
    reference, production = sample(spark, 400, 1), sample(spark, 90, 2, shift)
    want = rows(feature_drift(reference, production, NAMES, ["zone"]))
    profile = profiled(spark, reference)
    assert profile.values.select("feature", "slice").distinct().count() > 20
    assert profile.values.groupBy("feature", "slice").count().agg(F.max("count")).first()[0] == 7
    check(rows(profile_drift(profile, production, NAMES, ["zone"])), want)


def test_gap_just_below_a_value(spark):
    reference = spark.createDataFrame([(float(x),) for x in range(10)], "a double")
    production = spark.createDataFrame([(9.5,), (9.0,)], "a double")
    path = scratch_path(spark, "profile-test")
    write_profile(reference, path, ["a"], [], 4)
    got = profile_drift(read_profile(spark, path), production, ["a"], []).first()
    assert got["drift_score"] == pytest.approx(0.9)


@pytest.mark.parametrize("empty", ["reference", "production", "both", "column"])
def test_empty_samples(spark, empty):
    reference, production = sample(spark, 60, 1), sample(spark, 30, 2)
    if empty in ("reference", "both"):
        reference = reference.limit(0)
    if empty in ("production", "both"):
        production = production.limit(0)
    if empty == "column":
        production = production.withColumn("b", F.lit(float("nan")))
        reference = reference.withColumn("a", F.lit(None).cast("double"))
    want = rows(feature_drift(reference, production, NAMES, ["zone"]))
    check(rows(profile_drift(profiled(spark, reference), production, NAMES, ["zone"])), want)


def test_few_distinct_integers_and_values_outside(spark):
    reference = spark.createDataFrame([(z,) for z in [4, 4, 7, 7, 9]], "zone int")
    production = spark.createDataFrame([(z,) for z in [4, 7, 7, 300, 1]], "zone int")
    path = scratch_path(spark, "profile-test")
    write_profile(reference, path, ["zone"], ["zone"])
    for empty_bin in ("inf", "floor"):
        want = rows(feature_drift(reference, production, ["zone"], ["zone"], empty_bin=empty_bin))
        check(rows(profile_drift(read_profile(spark, path), production, ["zone"], ["zone"], empty_bin)), want)


def test_extended_profile_equals_the_profile_of_all(spark):
    first, second, production = sample(spark, 120, 1), sample(spark, 200, 5, 0.5), sample(spark, 50, 2)
    path = scratch_path(spark, "profile-test")
    extend_profile(profiled(spark, first), second, path, NAMES, ["zone"], 9)
    want = rows(feature_drift(first.unionByName(second), production, NAMES, ["zone"]))
    check(rows(profile_drift(read_profile(spark, path), production, NAMES, ["zone"])), want)


def test_only_touched_slices_are_read_and_never_the_reference(spark):
    source = scratch_path(spark, "reference-rows")
    sample(spark, 400, 1).write.parquet(source)
    profile = profiled(spark, spark.read.parquet(source))
    few = spark.createDataFrame([(0.1, 0.2, 3)], "a double, b double, zone int")
    table = profile_drift(profile, few, NAMES, ["zone"])
    assert not any(f.removeprefix("file:").startswith(source) for f in table.inputFiles())
    scans = [line for line in table._jdf.queryExecution().executedPlan().toString().split("\n") if "cum_ref_n" in line
             and "FileScan" in line]
    assert scans and all(re.search(r"PartitionFilters: .*slice#\d+L = \d+", line) for line in scans)
