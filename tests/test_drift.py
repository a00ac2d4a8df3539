from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandlab.operators.drift import (
    drift_summary, feature_drift, feature_drift_within, feature_stats, ks_table, prediction_stats, psi_table,
    ranked_counts, sample_counts,
)


def one(spark, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def psi(spark, reference, production, kind="double", **options):
    counts = sample_counts(one(spark, reference, kind), one(spark, production, kind), ["x"])
    integers = ["x"] if kind == "int" else []
    return psi_table(ranked_counts(counts), integers=integers, **options).first()["psi"]


def ks(spark, reference, production):
    counts = sample_counts(one(spark, reference), one(spark, production), ["x"])
    return ks_table(ranked_counts(counts)).first()


def brute_ks(a, b):
    points = np.unique(np.concatenate([a, b]))
    return max(abs((np.array(a) <= p).mean() - (np.array(b) <= p).mean()) for p in points)


def test_empty_bin_is_infinite(spark):
    reference, production = [1] * 10 + [2] * 10 + [3] * 10, [1, 1, 2, 2, 99]
    assert psi(spark, reference, production, "int") == math.inf
    floored = psi(spark, reference, production, "int", empty_bin="floor")
    want = (1 - 2 / 3) * math.log(1 / (2 / 3)) + (1e-4 - 1 / 3) * math.log(1e-4 / (1 / 3))
    assert floored == pytest.approx(want)


def test_constant_reference_has_no_bins(spark):
    assert psi(spark, [5.0] * 20, [1.0, 5.0, 9.0]) == 0.0
    assert psi(spark, [5] * 20, [1, 5, 9], "int") == 0.0


def test_identical_samples(spark):
    values = np.random.default_rng(3).normal(size=500).tolist()
    assert psi(spark, values, values) == 0.0
    row = ks(spark, values, values)
    assert (row["ks"], row["p_value"]) == (0.0, 1.0)


def test_psi_by_brute_force(spark):
    rng = np.random.default_rng(5)
    reference, production = rng.normal(size=3000), rng.normal(0.3, 1.1, 2000)
    edges = np.unique(np.quantile(reference, np.arange(11) / 10))

    def shares(x):
        slot = np.searchsorted(edges, x, side="left")
        slot[x == edges[0]] = 1
        kept = slot[(slot > 0) & (slot < len(edges))]
        return np.bincount(kept, minlength=len(edges))[1:] / len(kept)

    r, p = shares(reference), shares(production)
    want = ((p - r) * np.log(p / r)).sum()
    assert psi(spark, reference.tolist(), production.tolist()) == pytest.approx(want, abs=1e-9)


def test_ks_by_brute_force(spark):
    rng = np.random.default_rng(9)
    a = np.concatenate([rng.normal(size=400), np.full(300, 0.5)])
    b = rng.normal(0.2, 1, 350)
    row = ks(spark, a.tolist(), b.tolist())
    assert row["ks"] == pytest.approx(brute_ks(a, b), abs=1e-12)
    assert row["reference_mean"] == pytest.approx(a.mean()) and row["production_mean"] == pytest.approx(b.mean())
    assert row["reference_std"] == pytest.approx(a.std(ddof=1))
    assert row["production_std"] == pytest.approx(b.std(ddof=1))
    assert 0 <= row["p_value"] <= 1


def table(spark):
    rng = np.random.default_rng(1)
    rows = [(int(z), float(v), float(w), bool(i < 600)) for i, (z, v, w) in enumerate(
        zip(rng.integers(1, 5, 1000), rng.normal(size=1000), np.arange(1000.0)))]
    return spark.createDataFrame(rows, "PULocationID int, a double, b double, old boolean")


def test_one_table_and_two_tables_agree(spark):
    rows, features = table(spark), ["PULocationID", "a", "b"]
    two = feature_drift(rows.filter("old"), rows.filter("not old"), features)
    one_pass = feature_drift_within(rows, F.col("old"), ~F.col("old"), features)
    def key(r):
        return r["feature"]

    assert sorted(two.collect(), key=key) == sorted(one_pass.collect(), key=key)
    found = {r["feature"]: r for r in two.collect()}
    assert found["b"]["drift_detected"] and found["b"]["test"] == "KS" and found["b"]["drift_score"] == 1.0
    assert found["PULocationID"]["test"] == "PSI" and found["PULocationID"]["p_value"] is None
    summary = drift_summary(two, order=features).first()
    assert summary["drifted_feature_names"] == [f for f in features if found[f]["drift_detected"]]
    assert summary["total_features"] == 3


def test_statistics(spark):
    values = np.random.default_rng(2).gamma(2, size=999)
    row = feature_stats(one(spark, values.tolist()), ["x"]).first()
    assert row["median"] == pytest.approx(np.median(values))
    assert row["q25"] == pytest.approx(np.quantile(values, 0.25))
    assert row["std"] == pytest.approx(values.std(ddof=1))
    stats = prediction_stats(one(spark, values.tolist()), "x").first()
    assert stats["std"] == pytest.approx(values.std()) and stats["median"] == pytest.approx(np.median(values))


def test_unknown_bin_policy(spark):
    with pytest.raises(ValueError):
        psi(spark, [1.0, 2.0], [1.0], empty_bin="skip")


@pytest.mark.parametrize("a, b", [([], [1.0, 2.0]), ([1.0, 2.0], []), ([None, float("nan")], [1.0])])
def test_an_empty_side_is_no_drift(spark, a, b):
    frames = [spark.createDataFrame([(v,) for v in side], "x double") for side in (a, b)]
    row = feature_drift(*frames, ["x"]).collect()
    assert not row or (row[0]["p_value"] is None and not row[0]["drift_detected"])
