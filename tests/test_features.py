from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from demandlab.functions.calendar import with_window_parts
from demandlab.operators.features import (
    build_features, feature_row_counts, gap_report, recent_per_zone, with_history, with_history_spans,
)
from demandlab.schemas import DEMAND, LAGS, ROLLING_FEATURES, WINDOW, ZONE, lag_features

START = datetime(2024, 1, 1)


def series(spark, sizes, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for zone, n in sizes.items():
        # Windows with gaps: lags count rows, not time.
        steps = np.cumsum(rng.integers(1, 4, n))
        rows += [(START + timedelta(minutes=15 * int(s)), zone, int(v)) for s, v in zip(steps, rng.integers(0, 50, n))]
    return with_window_parts(spark.createDataFrame(rows, f"{WINDOW} timestamp_ntz, {ZONE} int, {DEMAND} bigint"))


def test_history_needs_672_rows(spark):
    assert build_features(series(spark, {4: 672})).count() == 0
    assert build_features(series(spark, {4: 673})).count() == 1


def test_same_values_as_pandas(spark):
    demand = series(spark, {4: 300, 161: 120, 237: 3})
    got = with_history(demand, (1, 4, 24, 96)).toPandas().sort_values([ZONE, WINDOW]).reset_index(drop=True)
    want = got[[ZONE, WINDOW, DEMAND]].copy()
    by_zone = want.groupby(ZONE)[DEMAND]
    for n in (1, 4, 24, 96):
        want[f"lag_{n}"] = by_zone.shift(n)
    want["rolling_mean_4"] = by_zone.transform(lambda x: x.rolling(4).mean())
    want["rolling_std_4"] = by_zone.transform(lambda x: x.rolling(4).std())
    want["rolling_max_24"] = by_zone.transform(lambda x: x.rolling(24).max())
    want["rolling_min_24"] = by_zone.transform(lambda x: x.rolling(24).min())
    for column in [*lag_features((1, 4, 24, 96)), *ROLLING_FEATURES]:
        np.testing.assert_allclose(got[column].astype(float), want[column].astype(float), atol=1e-9, err_msg=column)


@pytest.mark.parametrize("lags", [(1, 4), LAGS])
def test_spans_give_the_same_rows(spark, lags):
    demand = series(spark, {4: 2500, 161: 700})
    plain, spans = with_history(demand, lags), with_history_spans(demand, lags, span_days=1)
    columns = [ZONE, WINDOW, *[F.round(c, 9).alias(c) for c in [*lag_features(lags), *ROLLING_FEATURES]]]
    assert plain.count() == spans.count()
    assert plain.select(columns).exceptAll(spans.select(columns)).count() == 0


def test_row_counts(spark):
    row = feature_row_counts(series(spark, {4: 30, 161: 20}), (1, 4)).first()
    assert (row["rows_before"], row["rows_after"], row["rows_dropped"]) == (50, 7, 43)
    assert row["dropped_pct"] == pytest.approx(86.0)


def test_gaps_and_recent_rows(spark):
    demand = series(spark, {4: 50})
    stamps = pd.Series(sorted(r[WINDOW] for r in demand.collect()))
    gap = gap_report(demand).first()
    assert gap["max_gap_minutes"] == stamps.diff().max().total_seconds() / 60 and gap["steps"] == 49
    assert sorted(r[WINDOW] for r in recent_per_zone(demand, 10).collect()) == list(stamps[-10:])


def test_one_shuffle_on_the_zone(spark, sf_dir):
    from demandlab.catalog import adapters

    plan = adapters.features(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    initial = plan[plan.index("Initial Plan") :] if "Initial Plan" in plan else plan
    # One exchange for the counts, one on the zone for every windowed column, one sort.
    assert initial.count("Exchange hashpartitioning") == 2
    assert initial.count("Sort [") == 1 and initial.count("Window [") == 1
    assert "SinglePartition" not in initial
