from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from demandlab.operators.lifecycle import append_version, claim_version, registry_row
from demandlab.schemas import API_LOG
from demandlab.session import scratch_path
from demandlab.sources.claims import _rename, create_once, read_claims, take_block
from demandlab.sources.logs import append_log
from demandlab.sources.reports import read_registry


def test_one_writer_creates_a_file(spark):
    path = f"{scratch_path(spark, 'claims')}/one.json"
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda n: create_once(spark, path, f'{{"key": "{n}"}}'), range(8)))
    assert sum(won) == 1
    assert [r["key"] for r in read_claims(spark, path.rsplit("/", 1)[0]).collect()] == [str(won.index(True))]


def test_renaming_does_not_overwrite(spark):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = scratch_path(spark, "rename")
    names = [jvm.org.apache.hadoop.fs.Path(f"{folder}/{n}") for n in ("a", "b", "target")]
    files = names[0].getFileSystem(conf)
    for name in names[:2]:
        files.create(name, False).close()
    assert _rename(spark, files, names[0], names[2]) and not _rename(spark, files, names[1], names[2])
    assert files.exists(names[1])


def test_concurrent_runs_get_versions_of_their_own_and_a_repeated_run_none(spark):
    path = scratch_path(spark, "registry")
    metrics = spark.createDataFrame([(0.5, 0.6, 0.7, 9)], "mae double, rmse double, r2 double, samples long")

    def register(run):
        version = claim_version(spark, path, run)
        append_version(registry_row(metrics, F.lit(version), f"models/{version}", "2024-02-01T00:00:00"), path)
        return version

    runs = [f"run-{i}" for i in range(4)]
    with ThreadPoolExecutor(4) as pool:
        versions = list(pool.map(register, runs))
    assert sorted(versions) == ["v1", "v2", "v3", "v4"]
    assert [register(run) for run in runs] == versions
    assert read_registry(spark, path).count() == 4
    # A registry that was written before there were claims.
    old = scratch_path(spark, "registry")
    append_version(registry_row(metrics, F.lit("v7"), "models/v7", "2024-02-01T00:00:00"), old)
    assert claim_version(spark, old, "next") == "v8"


def rows(spark, start, count, parts=3):
    made = [(datetime(2024, 1, 1) + timedelta(hours=start + i), f"/e{i % 2}") for i in range(count)]
    return spark.createDataFrame(made, "timestamp timestamp_ntz, endpoint string").repartition(parts)


def ids(spark, path):
    return sorted(r["id"] for r in spark.read.schema(API_LOG).parquet(path).select("id").collect())


def test_ids_are_dense_over_appends_and_retries(spark):
    path = scratch_path(spark, "log")
    append_log(rows(spark, 0, 50), path, API_LOG, append_id="first")
    append_log(rows(spark, 50, 30, parts=7), path, API_LOG, append_id="second")
    append_log(rows(spark, 0, 50, parts=5), path, API_LOG, append_id="first")
    append_log(rows(spark, 0, 0), path, API_LOG)
    append_log(rows(spark, 80, 20), path, API_LOG)
    assert ids(spark, path) == list(range(1, 101))
    first = spark.read.schema(API_LOG).parquet(path).filter("id <= 50")
    assert first.agg(F.count_distinct("timestamp"), F.max("timestamp")).first()[0] == 50
    with pytest.raises(ValueError, match="50 rows and comes back with 49"):
        append_log(rows(spark, 0, 49), path, API_LOG, append_id="first")


def test_a_retry_keeps_the_time_of_the_first_try(spark):
    path = scratch_path(spark, "log")
    timeless = rows(spark, 0, 5).select("endpoint")
    append_log(timeless, path, API_LOG, append_id="a")
    first = spark.read.schema(API_LOG).parquet(path).agg(F.max("timestamp")).first()[0]
    append_log(timeless, path, API_LOG, append_id="a")
    again = spark.read.schema(API_LOG).parquet(path).select("timestamp", "created_at").distinct().collect()
    assert [tuple(r) for r in again] == [(first, first)]


def test_appends_at_the_same_time(spark):
    path = scratch_path(spark, "log")
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda k: append_log(rows(spark, 5 * k, 10 + k), path, API_LOG), range(3)))
    assert ids(spark, path) == list(range(1, 34))
    folder = scratch_path(spark, "claims")
    with ThreadPoolExecutor(3) as pool:
        blocks = list(pool.map(lambda k: take_block(spark, folder, f"k{k}", 10 + k), range(3)))
    taken = sorted(n for b in blocks for n in range(b["first"], b["first"] + b["rows"]))
    assert taken == list(range(1, 34))
