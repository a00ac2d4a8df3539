"""Log tables: defaults and ids on write, long metric rows."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandlab.functions.documents import as_json
from demandlab.operators.ranking import settle
from demandlab.schemas import METRIC_LOG
from demandlab.sources.claims import take_block


def with_log_defaults(df: DataFrame, schema: T.StructType, now: Column, version: str = "v1") -> DataFrame:
    """Fits rows to a log schema: NOW() for missing times, the default model version, NULL otherwise."""
    defaults = {"timestamp": now, "created_at": now, "model_version": F.lit(version)}

    def value(field: T.StructField) -> Column:
        given = F.col(field.name) if field.name in df.columns else F.lit(None)
        if field.name in defaults:
            given = F.coalesce(given, defaults[field.name])
        return given.cast(field.dataType).alias(field.name)

    return df.select(*[value(f) for f in schema.fields])


# Spark's increasing ids hold the partition above 33 bits of position.
POSITION_BITS = 33


def append_log(df: DataFrame, path: str, schema: T.StructType, now: Column | None = None,
               append_id: str | None = None) -> None:
    """Appends to a log table kept by day, so time filters skip whole days; ids go on without a gap.

    ``append_id`` names the append. Repeated with the same rows it replaces its own, which keep
    their block of ids and the time that stands for missing ones; appends at the same time get
    blocks of their own. The rows are written once with their place in their partition, counts per
    partition give each partition its first id, and no row is sorted for it.
    """
    spark, append_id = df.sparkSession, append_id or uuid.uuid4().hex
    place = F.monotonically_increasing_id()
    placed = settle(df.withColumns({
        "_part": F.shiftright(place, POSITION_BITS), "_at": place.bitwiseAND(F.lit((1 << POSITION_BITS) - 1)),
    }), "log-rows")
    # One row per partition.
    per_part = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    total = per_part.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    time_now = spark.range(1).select(F.current_timestamp().cast("timestamp_ntz").cast("string")).first()[0]
    block = take_block(spark, f"{path.rstrip('/')}_claims", append_id, total, time_now)
    before = F.sum("_n").over(W.orderBy("_part")) - F.col("_n") + F.lit(block["first"])
    starts = per_part.select("_part", before.alias("_first"))
    numbered = placed.join(F.broadcast(starts), "_part").withColumn("id", F.col("_first") + F.col("_at"))
    stamp = F.lit(block["at"]).cast("timestamp_ntz") if now is None else now
    rows = with_log_defaults(numbered, schema, stamp).withColumns({
        "log_date": F.to_date("timestamp"), "append_id": F.lit(append_id)})
    # Few files per day, with a large day split over several tasks.
    (rows.hint("rebalance", "log_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("log_date", "append_id").parquet(path))


def drift_log_rows(reports: DataFrame, report_type: str = "data_drift") -> DataFrame:
    """Drift reports (``drift_report``) as rows of the drift log: score is the share of drifted features."""
    found = F.col("summary")
    return reports.select(
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), F.lit(report_type).alias("report_type"),
        found["drift_detected"].alias("drift_detected"),
        F.try_divide(found["drifted_features"], found["total_features"]).alias("drift_score"),
        found["drifted_feature_names"].alias("features_affected"), as_json(*reports.columns).alias("report_json"))


def api_log_rows(requests: DataFrame) -> DataFrame:
    """Requests (ts, endpoint, status, error_type, latency_seconds) as rows of the request log."""
    failed = F.col("status") != "success"
    return requests.select(
        F.col("ts").alias("timestamp"), "endpoint", F.when(failed, 500).otherwise(200).alias("status_code"),
        (F.col("latency_seconds") * 1000).alias("latency_ms"),
        F.when(failed, F.col("error_type")).alias("error_message"))


def metric_rows(wide: DataFrame, metrics: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """Turns one column per metric into one row per metric."""
    values = wide.select(*ids, *[F.col(m).cast("double").alias(m) for m in metrics])
    return values.unpivot(list(ids), list(metrics), "metric_name", "metric_value")


def metric_log(wide: DataFrame, metrics: Sequence[str], now: Column, data_window: str,
               version: str = "v1") -> DataFrame:
    long = metric_rows(wide, metrics).withColumn("data_window", F.lit(data_window))
    return with_log_defaults(long, METRIC_LOG, now, version)
