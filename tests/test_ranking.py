"""Exact ranks and quantiles, with one range of values and with several."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandlab.operators.ranking import exact_quantiles, running_totals, settle, value_counts

SHARES = [0.0, 0.1, 0.25, 0.5, 0.75, 0.95, 1.0]


@pytest.fixture(scope="module")
def samples():
    rng = np.random.default_rng(7)
    return {
        "spread": rng.normal(size=4000).tolist(),
        # One value holds two thirds of the rows.
        "hot": [3.0] * 4000 + rng.random(2000).tolist(),
        "few": rng.integers(0, 4, 500).astype(float).tolist(),
        "one": [5.0] * 10,
        "pair": [1.0, 2.0],
        None: [4.0, 1.0, 1.0],
    }


@pytest.fixture(params=["true", "false"])
def ranges(spark, request):
    """One range for small input, or as many as there are shuffle partitions."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, request.param)
    yield
    spark.conf.unset(key)


@pytest.fixture(scope="module")
def counts(spark, samples):
    rows = [(g, v) for g, values in samples.items() for v in values] + [("spread", float("nan")), ("spread", None)]
    return settle(value_counts(spark.createDataFrame(rows, "g string, v double"), ["g"], "v"), "test-counts")


def test_quantiles(counts, samples, ranges):
    got = {r["g"]: r["quantiles"] for r in exact_quantiles(counts, ["g"], "v", SHARES).collect()}
    assert set(got) == set(samples)
    for group, values in samples.items():
        np.testing.assert_allclose(got[group], np.quantile(values, SHARES), atol=1e-12, err_msg=str(group))


def test_running_totals(counts, samples, ranges):
    ranked = running_totals(counts.withColumn("w", F.col("n") * 2), ["g"], "v", ["n"], ["w"])
    seen = 0
    for row in ranked.collect():
        values = np.array(samples[row["g"]])
        assert row["cum_n"] == (values <= row["v"]).sum()
        assert row["all_n"] == len(values) and row["all_w"] == 2 * len(values)
        seen += 1
    assert seen == sum(len(set(v)) for v in samples.values())


def test_empty_input(counts):
    nothing = counts.limit(0)
    assert exact_quantiles(nothing, ["g"], "v", SHARES).count() == 0
    assert running_totals(nothing, ["g"], "v", ["n"]).count() == 0


def test_negative_zero_is_zero(spark):
    df = spark.createDataFrame([("a", 0.0), ("a", -0.0)], "g string, v double")
    assert value_counts(df, ["g"], "v").count() == 1
