"""Model registry, deployments and the retraining decision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from demandlab.functions.documents import join_reasons, nested_or
from demandlab.schemas import MODEL_REGISTRY
from demandlab.sources.claims import take_block
from demandlab.sources.reports import read_registry


def next_version(registry: DataFrame) -> DataFrame:
    """One row with the automatic version of the next model: the largest number so far and one."""
    number = F.regexp_extract("version", "^v([0-9]+)$", 1)
    largest = F.max(F.when(number != "", number.cast("int")))
    return registry.agg(F.concat(F.lit("v"), (F.coalesce(largest, F.lit(0)) + 1).cast("string")).alias("version"))


def claim_version(spark: SparkSession, registry_path: str, key: str) -> str:
    """A version that no other run gets: the next free number, or the one that the run ``key`` has already."""
    least = int(next_version(read_registry(spark, registry_path)).first()["version"][1:])
    return f"v{take_block(spark, f'{registry_path.rstrip("/")}_claims', key, least=least)['first']}"


def registry_row(metrics: DataFrame, version: Column, model_path: str, trained_at: str,
                 start_date: str | None = None, end_date: str | None = None) -> DataFrame:
    """One registry row from a one-row metric table (mae, rmse, r2, samples; mape if present)."""
    mape = F.col("mape") if "mape" in metrics.columns else F.lit(None).cast("double")
    return metrics.select(
        version.alias("version"), F.lit(trained_at).alias("trained_at"), F.lit(model_path).alias("model_path"),
        F.struct(F.col("mae"), F.col("rmse"), F.col("r2"), mape.alias("mape")).alias("performance"),
        F.struct(F.lit(start_date).cast("string").alias("start_date"),
                 F.lit(end_date).cast("string").alias("end_date"),
                 F.col("samples").alias("n_samples")).alias("training_data"),
        F.lit(False).alias("is_deployed"), F.lit(None).cast("string").alias("deployed_at"),
    )


def append_version(row: DataFrame, path: str) -> None:
    """One registered version is one small JSON object; registered again, it takes the place of its own."""
    _put(row.select(MODEL_REGISTRY.fieldNames()), path, F.col("version"))


def _put(event: DataFrame, path: str, name: Column) -> None:
    """Writes a small row to a folder of its own name. Writers at the same time stage apart, which appends do not."""
    (event.withColumn("entry", name).coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("entry").json(path))


def append_deployment(registry_rows: DataFrame, version: str, deployed_at: str, path: str) -> None:
    """Deployment is an event; earlier versions stay in the registry, and the same event is kept once."""
    event = registry_rows.filter(F.col("version") == version).limit(1)
    _put(event.select("version", F.lit(deployed_at).alias("deployed_at")), path,
         F.concat_ws(" ", "deployed_at", "version"))


def current_version(deployments: DataFrame) -> DataFrame:
    newest = F.struct("deployed_at", "version")
    return deployments.agg(
        F.max_by("version", newest).alias("current_production"), F.max("deployed_at").alias("deployed_at"),
        F.count(F.lit(1)).alias("deployments"),
    )


def model_history(registry: DataFrame, keep: int = 10) -> DataFrame:
    """The newest registered versions with their formatted time and error."""
    rows = registry.select(
        "version", F.date_format(F.to_timestamp("trained_at"), "yyyy-MM-dd HH:mm").alias("trained_at"),
        F.format_string("%.4f", nested_or("performance.mae", 0.0)).alias("mae"), "is_deployed",
        F.struct("trained_at", "version").alias("_order"),
    )
    # Top-k by time, then the newest of those is the current one.
    newest = rows.orderBy(F.desc("_order")).limit(keep)
    place = F.row_number().over(W.orderBy(F.desc("_order")))
    return newest.withColumn("is_current", place == 1).drop("_order")


def retrain_decision(state: DataFrame, mae_limit: float = 2.5, increase_limit: float = 20.0) -> DataFrame:
    """Whether to retrain, and why.

    ``state`` holds mae, mae_increase_pct, drift_detected, drifted_features and
    drifted_feature_names, one row per check.
    """
    names = F.concat(F.lit("['"), F.array_join("drifted_feature_names", "', '"), F.lit("']"))
    reasons = [
        F.when(F.col("mae") > mae_limit,
               F.format_string(f"Performance degradation: MAE %.4f > threshold {mae_limit:.4f}", F.col("mae"))),
        F.when(F.col("mae_increase_pct") > increase_limit,
               F.format_string(f"MAE increased by %.1f%% (threshold: {increase_limit:.0f}%%)",
                               F.col("mae_increase_pct"))),
        F.when(F.col("drift_detected"), F.concat(
            F.lit("Data drift in "), F.col("drifted_features").cast("string"), F.lit(" features: "), names)),
    ]
    triggered = F.lit(False)
    for reason in reasons:
        triggered = triggered | reason.isNotNull()
    return state.withColumns({
        "should_retrain": triggered, "reason": join_reasons(*reasons, default="All checks passed"),
    })
