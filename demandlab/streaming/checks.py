"""Quality, drift and performance checks on each arriving batch of feature rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlab.operators.drift import drift_summary
from demandlab.operators.lifecycle import retrain_decision
from demandlab.operators.metrics import performance_check
from demandlab.operators.profile import Profile, profile_drift, read_profile
from demandlab.operators.quality import validation_summary, write_split
from demandlab.schemas import FEATURES
from demandlab.streaming.io import each_batch


def batch_check(rows: DataFrame, reference: Profile, baseline_mae: float, predicted: str = "predicted",
                features: Sequence[str] = FEATURES) -> DataFrame:
    """One row: validation rate, error against the baseline, drift and the retraining decision."""
    performance = performance_check(rows, baseline_mae, predicted=predicted)
    drift = drift_summary(profile_drift(reference, rows, features), order=features)
    quality = validation_summary(rows)
    joined = performance.withColumns({
        "_d": drift.select(F.struct("*")).scalar(), "_q": quality.select(F.struct("*")).scalar(),
    })
    return retrain_decision(joined.select("*", "_d.*", "_q.*").drop("_d", "_q"))


def check_stream(rows: DataFrame, profile_path: str, baseline_mae: float, path: str, checkpoint: str,
                 predicted: str = "predicted", features: Sequence[str] = FEATURES) -> None:
    """Writes one check row per micro-batch; a repeated batch replaces its row, a later run adds rows.

    The reference is the profile that ``profile.write_profile`` left at ``profile_path``.
    """
    reference = read_profile(rows.sparkSession, profile_path)

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            check = batch_check(kept, reference, baseline_mae, predicted, features)
            check.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        finally:
            kept.unpersist()

    each_batch(rows, write, checkpoint)


def quarantine_stream(rows: DataFrame, good_path: str, bad_path: str, checkpoint: str) -> None:
    """Splits each micro-batch into good rows and quarantined rows."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_split(batch, f"{good_path}/batch_id={batch_id}", f"{bad_path}/batch_id={batch_id}", "overwrite")

    each_batch(rows, write, checkpoint)


