"""Streams must give the rows of their batch twins."""

from __future__ import annotations

import os
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandlab.operators.demand import build_demand
from demandlab.operators.features import with_history
from demandlab.operators.metrics import running_score
from demandlab.operators.observability import (
    error_rate_alerts, folded_quantile, histogram, histogram_quantiles, latency_alerts, sustained,
)
from demandlab.schemas import DEMAND, DEMAND_TABLE, NTZ, ROLLING_FEATURES, WINDOW, ZONE, lag_features, table, DBL, INT, LONG, STR
from demandlab.session import scratch_path
from demandlab.streaming.demand import (
    demand_stream, distinct_stream, running_score_stream, sliding_latency, sustained_errors, sustained_latency,
)
from demandlab.streaming.features import feature_stream, moving_average_stream
from demandlab.streaming.io import (
    append_to_table, closable, close_stream, file_stream, newest_rows, newest_snapshot, open_for_closing,
    snapshots_to_table, upserts_to_table,
)

START = datetime(2024, 1, 1)
EVENT = table(id=LONG, ts=NTZ, PULocationID=INT)


def write_files(tmp_path, parts, name="part"):
    """One Parquet file per part, with modification times in order."""
    folder = tmp_path / name
    folder.mkdir()
    for i, pdf in enumerate(parts):
        file = folder / f"{i:03d}.parquet"
        pdf.to_parquet(file, index=False, coerce_timestamps="us")
        os.utime(file, (1_700_000_000 + i, 1_700_000_000 + i))
    return str(folder)


def event_parts(n_parts=4, per_part=200, seed=3):
    import pandas as pd

    rng = np.random.default_rng(seed)
    parts = []
    for i in range(n_parts):
        minutes = np.sort(rng.uniform(i * 240, (i + 1) * 240, per_part))
        parts.append(pd.DataFrame({
            "id": np.arange(per_part) + i * per_part,
            "ts": [START + timedelta(minutes=float(m)) for m in minutes],
            "PULocationID": rng.choice([4, 132, 237], per_part).astype("int32"),
        }))
    return parts


def stream_demand(spark, folder):
    path = scratch_path(spark, "demand-test")
    append_to_table(demand_stream(file_stream(spark, folder, EVENT, files_per_trigger=1), "ts"), path, f"{path}-checkpoint")
    return spark.read.schema(DEMAND_TABLE).parquet(path)


def test_demand_equals_the_batch_up_to_the_watermark(spark, tmp_path):
    parts = event_parts()
    folder = write_files(tmp_path, parts)
    closed = parts[-1]["ts"].max() - timedelta(minutes=30)
    batch = build_demand(spark.read.schema(EVENT).parquet(folder), ts="ts").filter(
        F.col(WINDOW) + F.make_dt_interval(mins=F.lit(15)) <= F.lit(closed))
    streamed = stream_demand(spark, folder)
    assert streamed.count() > 50
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_late_rows_are_dropped_from_the_stream_only(spark, tmp_path):
    import pandas as pd

    parts = event_parts()
    late = pd.DataFrame({"id": [10_000], "ts": [START + timedelta(minutes=1)], "PULocationID": np.array([4], "int32")})
    parts[3] = pd.concat([parts[3], late], ignore_index=True)
    folder = write_files(tmp_path, parts)
    first = (F.col(WINDOW) == F.lit(START)) & (F.col(ZONE) == 4)
    batch = build_demand(spark.read.schema(EVENT).parquet(folder), ts="ts").filter(first).first()[DEMAND]
    streamed = stream_demand(spark, folder).filter(first).first()
    assert batch - (streamed[DEMAND] if streamed else 0) == 1


def test_rerun_from_the_checkpoint_adds_nothing(spark, tmp_path):
    folder = write_files(tmp_path, event_parts())
    path, place = scratch_path(spark, "again"), scratch_path(spark, "again-checkpoint")
    for _ in range(2):
        append_to_table(file_stream(spark, folder, EVENT, files_per_trigger=1), path, place)
    assert spark.read.parquet(path).count() == 800


def demand_parts(late=False):
    import pandas as pd

    rng = np.random.default_rng(8)
    frames = []
    for zone, n in ((4, 150), (161, 90), (237, 2)):
        steps = np.cumsum(rng.integers(1, 3, n))
        stamps = [START + timedelta(minutes=15 * int(s)) for s in steps]
        frames.append(pd.DataFrame({WINDOW: stamps, ZONE: np.full(n, zone, "int32"), DEMAND: rng.integers(1, 30, n)}))
    rows = pd.concat(frames).sort_values([WINDOW, ZONE], ignore_index=True)
    rows["hour"], rows["day_of_week"], rows["month"] = (np.zeros(len(rows), "int32") for _ in range(3))
    cuts = np.array_split(np.arange(len(rows)), 4)
    parts = [rows.iloc[c].sample(frac=1, random_state=1) for c in cuts]
    if late:
        parts[3] = pd.concat([parts[3], rows.iloc[[0]]])
    return parts


def test_online_features_equal_the_batch(spark, tmp_path):
    folder, lags = write_files(tmp_path, demand_parts()), (1, 4, 24, 96)
    path = scratch_path(spark, "online-test")
    append_to_table(feature_stream(file_stream(spark, folder, DEMAND_TABLE, files_per_trigger=1), lags), path, f"{path}-checkpoint")
    names = [*lag_features(lags), *ROLLING_FEATURES]
    wanted = [WINDOW, ZONE, *[F.round(n, 9).alias(n) for n in names]]
    streamed = spark.read.parquet(path)
    batch = with_history(spark.read.schema(DEMAND_TABLE).parquet(folder), lags)
    assert streamed.filter("late").count() == 0 and streamed.count() == batch.count() == 242
    assert streamed.select(wanted).exceptAll(batch.select(wanted)).count() == 0


def test_out_of_order_rows_are_flagged(spark, tmp_path):
    folder, path = write_files(tmp_path, demand_parts(late=True)), scratch_path(spark, "late-test")
    append_to_table(feature_stream(file_stream(spark, folder, DEMAND_TABLE, files_per_trigger=1), (1, 4)), path, f"{path}-checkpoint")
    late = spark.read.parquet(path).filter("late").collect()
    assert len(late) == 1 and late[0]["lag_1"] is None and late[0]["rolling_mean_4"] is None


def test_moving_average(spark, tmp_path):
    folder, path = write_files(tmp_path, demand_parts()), scratch_path(spark, "mean-test")
    append_to_table(moving_average_stream(file_stream(spark, folder, DEMAND_TABLE, files_per_trigger=1), DEMAND), path, f"{path}-checkpoint")
    got = spark.read.parquet(path).toPandas().sort_values([ZONE, WINDOW])
    want = got.groupby(ZONE)[DEMAND].transform(lambda x: x.rolling(5, min_periods=1).mean())
    np.testing.assert_allclose(got["moving_average"], want)


def test_duplicates_across_files(spark, tmp_path):
    import pandas as pd

    parts = event_parts()
    parts = [parts[0], pd.concat([parts[1], parts[0].tail(5)], ignore_index=True), *parts[2:]]
    folder, path = write_files(tmp_path, parts), scratch_path(spark, "distinct-test")
    # The repeated rows are up to a file's span old, so the delay covers one file.
    stream = file_stream(spark, folder, EVENT, files_per_trigger=1)
    append_to_table(distinct_stream(stream, "ts", ["id", ZONE], "5 hours"), path, f"{path}-checkpoint")
    assert spark.read.parquet(path).count() == 800


def test_running_score_snapshots(spark, tmp_path):
    folder, path = write_files(tmp_path, demand_parts()), scratch_path(spark, "score-test")
    stream = file_stream(spark, folder, DEMAND_TABLE, files_per_trigger=1)
    ok = F.col(ZONE) != 237
    score = running_score_stream(stream, DEMAND, ZONE, ok)
    snapshots_to_table(score, path, f"{path}-checkpoint")
    got = newest_snapshot(spark, path, score.schema).first().asDict()
    want = running_score(spark.read.schema(DEMAND_TABLE).parquet(folder), DEMAND, ZONE, ok).first().asDict()
    assert got == pytest.approx(want)
    assert spark.read.parquet(path).select("batch_id").distinct().count() == 4


@pytest.mark.parametrize("every", [1, 3, 50])
def test_grouped_totals_over_files_a_restart_and_a_repeated_batch(spark, tmp_path, every):
    parts = event_parts(5)
    folder, path = write_files(tmp_path, parts[:3]), scratch_path(spark, "upsert-test")
    ok = F.col("id") % 7 != 0

    def run():
        stream = file_stream(spark, folder, EVENT, files_per_trigger=1)
        score = running_score_stream(stream, ZONE, "id", ok, [ZONE], "ts")
        upserts_to_table(score, path, f"{path}-checkpoint", [ZONE], every)
        found = newest_rows(spark, path, score.schema, [ZONE])
        return {r[ZONE]: r.asDict() for r in found.collect()}, found.count()

    def want():
        rows = spark.read.schema(EVENT).parquet(folder)
        zones = [r[0] for r in rows.select(ZONE).distinct().collect()]
        return {z: {ZONE: z, **running_score(rows.filter(F.col(ZONE).eqNullSafe(F.lit(z))), ZONE, "id", ok, "ts")
                    .first().asDict()} for z in zones}

    def equal(got, expected):
        assert got.keys() == expected.keys() and all(got[z] == pytest.approx(expected[z]) for z in got)

    got, n = run()
    assert n == len(got)
    equal(got, want())
    # The checkpoint forgets the last batch, so it is run again over its own output.
    for name in ("2", ".2.crc"):
        commit = f"{path}-checkpoint/commits/{name}"
        if os.path.exists(commit):
            os.unlink(commit)
    equal(run()[0], want())
    for i, pdf in enumerate(parts[3:], 3):
        file = tmp_path / "part" / f"{i:03d}.parquet"
        pdf.to_parquet(file, index=False, coerce_timestamps="us")
        os.utime(file, (1_700_000_000 + i, 1_700_000_000 + i))
    equal(run()[0], want())
    kinds = [k for k in ("base", "change") if os.path.exists(f"{path}/kind={k}")]
    folders = {k: sorted(f for f in os.listdir(f"{path}/kind={k}")) for k in kinds}
    assert len(folders.get("base", [])) <= 2 and len(folders.get("change", [])) <= 2 * every


def test_a_later_run_adds_to_the_table_and_to_the_quarantine(spark):
    from demandlab.schemas import FEATURES
    from demandlab.streaming.checks import quarantine_stream

    source, path = scratch_path(spark, "arriving"), scratch_path(spark, "kept")
    good, bad, place = (scratch_path(spark, n) for n in ("good", "bad", "quarantine-checkpoint"))
    schema = ", ".join(f"{c} double" for c in FEATURES)
    for run, size in enumerate((10, 25), 1):
        rows = [tuple(99.0 if c == "hour" and i % 5 == 0 else 1.0 for c in FEATURES) for i in range(size)]
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        stored = spark.read.parquet(source).schema
        append_to_table(file_stream(spark, source, stored), path, f"{path}-checkpoint")
        quarantine_stream(file_stream(spark, source, stored), good, bad, place)
        seen = 10 if run == 1 else 35
        assert spark.read.parquet(path).count() == seen
        kept, held = spark.read.parquet(good).count(), spark.read.parquet(bad).count()
        assert kept + held == seen and held >= seen // 5


def test_another_time_zone_is_refused(spark):
    from demandlab.streaming.io import event_time

    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        with pytest.raises(ValueError, match="UTC"):
            event_time(spark.range(1), "id")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


LOG = table(ts=NTZ, endpoint=STR, status=STR, seconds=DBL)


def log_part(begin, minutes, bad, endpoint="a"):
    """Ten requests a minute; in bad minutes all fail and take two seconds."""
    import pandas as pd

    rows = [(START + timedelta(minutes=begin + m, seconds=5 * i), endpoint, "error" if begin + m in bad else "success",
             2.0 if begin + m in bad else 0.01 * i) for m in range(minutes) for i in range(10)]
    return pd.DataFrame(rows, columns=["ts", "endpoint", "status", "seconds"])


def test_alerts_over_files_with_late_rows_a_restart_and_a_close(spark, tmp_path):
    bounds = (0.05, 0.5, 1.0, 5.0)
    bad = {*range(20, 29), *range(60, 62), *range(100, 112)}
    parts = [log_part(0, 40, bad), log_part(40, 40, bad), log_part(80, 40, bad)]
    folder = write_files(tmp_path, parts[:2])
    end = open_for_closing(spark, LOG, str(tmp_path / "end"))
    source = closable(file_stream(spark, folder, LOG, files_per_trigger=1), end)
    failed = F.col("status") == "error"
    streams = {
        "latency": sliding_latency(source, "ts", "seconds", bounds, delay="10 minutes"),
        "errors": sustained_errors(source, "ts", failed, delay="10 minutes"),
        "slow": sustained_latency(source, "ts", "seconds", bounds, delay="10 minutes"),
    }
    paths = {name: scratch_path(spark, name) for name in streams}

    def run():
        for name, stream in streams.items():
            append_to_table(stream, paths[name], f"{paths[name]}-checkpoint")

    run()
    late = log_part(1, 3, set(range(4)))  # far behind the watermark: must change nothing
    for i, pdf in enumerate((late, parts[2]), 2):
        pdf.to_parquet(f"{folder}/{i:03d}.parquet", index=False, coerce_timestamps="us")
        os.utime(f"{folder}/{i:03d}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))
    run()
    before = {name: spark.read.schema(s.schema).parquet(paths[name]).count() for name, s in streams.items()}
    close_stream(spark, LOG, "ts", end)
    run()
    run()

    import pandas as pd

    whole = spark.createDataFrame(pd.concat(parts)).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    rates, slow = error_rate_alerts(whole, "ts", failed), latency_alerts(whole, "ts", "seconds", bounds)
    want = {"latency": slow, "errors": sustained(rates, ["endpoint"], 5), "slow": sustained(slow, ["endpoint"], 5)}
    for name, batch in want.items():
        got = spark.read.schema(streams[name].schema).parquet(paths[name])
        assert before[name] <= got.count()
        rows = [sorted(map(tuple, df.select(sorted(batch.columns)).collect())) for df in (got, batch)]
        assert rows[0] == rows[1], name
    assert before["latency"] < want["latency"].count() and want["errors"].count() == 3


def test_state_of_an_idle_zone_is_evicted(spark, tmp_path):
    import pandas as pd

    def rows(zone, begin, n):
        return [(START + timedelta(minutes=15 * (begin + i)), zone, float(begin + i)) for i in range(n)]

    parts = [rows(1, 0, 6) + rows(2, 0, 6), rows(1, 6, 20), rows(1, 26, 10), rows(1, 36, 4) + rows(2, 36, 3), rows(2, 50, 2) + rows(1, 40, 14)]
    frames = [pd.DataFrame(p, columns=[WINDOW, ZONE, "x"]).astype({ZONE: "int32"}) for p in parts]
    folder = write_files(tmp_path, frames)
    schema = table(**{WINDOW: NTZ, ZONE: INT, "x": DBL})
    stream = moving_average_stream(file_stream(spark, folder, schema, files_per_trigger=1), "x", 5, lifetime=timedelta(hours=3))
    path, kept = scratch_path(spark, "lifetime"), []
    query = stream.writeStream.outputMode("append").format("parquet").option("path", path).option(
        "checkpointLocation", f"{path}-checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert 1 in kept and max(kept) == 2  # the silent zone's state went while the other went on
    want = {}
    for zone in (1, 2):
        series = pd.concat(frames).query(f"{ZONE} == {zone}").sort_values(WINDOW)
        life = (series[WINDOW].diff() > pd.Timedelta(hours=3)).cumsum()
        mean = series.x.groupby(life).transform(lambda v: v.rolling(5, min_periods=1).mean())
        want.update({(zone, t.to_pydatetime()): m for t, m in zip(series[WINDOW], mean)})
    got = {(r[ZONE], r[WINDOW]): r["moving_average"] for r in spark.read.parquet(path).collect()}
    assert got == pytest.approx(want) and len(got) == sum(map(len, parts))


def test_folded_quantiles_equal_the_windowed_ones(spark):
    rng, bounds = np.random.default_rng(5), (-1.0, 0.0, 0.1, 0.5, 2.0)
    log = spark.createDataFrame([(int(i % 7), float(x)) for i, x in enumerate(rng.normal(0.5, 1, 400))], "k int, x double")
    wide = log.groupBy("k").agg(*[F.count_if(F.col("x") <= b).alias(f"b{i}") for i, b in enumerate(bounds)],
                                F.count(F.lit(1)).alias("total"))
    counts = [F.col(f"b{i}") for i in range(len(bounds))] + [F.col("total")]
    for share in (0.0, 0.3, 0.95, 1.0):
        got = {r.k: r.q for r in wide.select("k", folded_quantile(bounds, counts, share).alias("q")).collect()}
        want = histogram_quantiles(histogram(log, "x", bounds, ["k"]), [share], ["k"]).collect()
        assert got == pytest.approx({r.k: r.estimate for r in want})
