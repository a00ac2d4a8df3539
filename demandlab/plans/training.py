"""Demand table to trained and scored models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlab.operators.demand import build_demand
from demandlab.operators.cleaning import clean_trips
from demandlab.operators.features import build_features
from demandlab.operators.metrics import basic_metrics, regression_metrics
from demandlab.operators.models import score, train
from demandlab.operators.sampling import label_by_position, label_by_time, split_by_month
from demandlab.schemas import FEATURES, LAGS, WINDOW


def trips_to_features(trips: DataFrame, year: int, lags: Sequence[int] = LAGS) -> DataFrame:
    """Raw trips to feature rows in one lazy plan."""
    return build_features(build_demand(clean_trips(trips, year)), lags)


def train_and_evaluate(rows: DataFrame, train_months: int = 10, learner=None,
                       features: Sequence[str] = FEATURES) -> tuple[PipelineModel, DataFrame]:
    """Month split, fit, and the full metric set on the validation months."""
    training, validation = split_by_month(rows, train_months)
    model = train(training, learner, features)
    scored = score(model, validation).withColumn("model", F.lit("candidate"))
    return model, regression_metrics(scored)


def retrain(rows: DataFrame, learner=None, features: Sequence[str] = FEATURES, share: float = 0.8,
            mode: str = "time") -> tuple[PipelineModel, DataFrame]:
    """80/20 split, fit, and basic validation metrics.

    ``mode="position"`` splits by row position in (zone, window) order, which
    holds out whole zones; ``"time"`` holds out the newest windows.
    """
    label = {"time": label_by_time, "position": label_by_position}[mode]
    parts = label(rows, share, WINDOW)
    model = train(parts.filter(F.col("part") == "train"), learner, features)
    return model, basic_metrics(score(model, parts.filter(F.col("part") == "validation")))
