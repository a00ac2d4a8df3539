"""Feature vectors, learners, scoring and learner comparison on MLlib."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlab.functions.numeric import nan_to_null, non_negative
from demandlab.operators.cleaning import concat_tables
from demandlab.operators.metrics import METRIC_NAMES, regression_metrics
from demandlab.schemas import DEMAND, FEATURES

SEED = 42


def feature_vectors(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    return assembler(features).transform(df)


def assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features")


def boosted_trees(trees: int = 100, step: float = 0.1, depth: int = 5, seed: int = SEED) -> GBTRegressor:
    return GBTRegressor(labelCol=DEMAND, predictionCol="raw_prediction", maxIter=trees, stepSize=step,
                        maxDepth=depth, seed=seed)


def random_forest(trees: int = 100, depth: int = 5, seed: int = SEED) -> RandomForestRegressor:
    return RandomForestRegressor(labelCol=DEMAND, predictionCol="raw_prediction", numTrees=trees, maxDepth=depth,
                                 seed=seed)


def linear_model() -> LinearRegression:
    return LinearRegression(labelCol=DEMAND, predictionCol="raw_prediction")


def train(rows: DataFrame, learner=None, features: Sequence[str] = FEATURES) -> PipelineModel:
    """Training refuses rows with missing features; the model's scoring does not."""
    model = Pipeline(stages=[assembler(features), learner or boosted_trees()]).fit(rows)
    model.stages[0].setHandleInvalid("keep")
    return model


def score(model: PipelineModel, rows: DataFrame, predicted: str = "predicted") -> DataFrame:
    """Adds the clamped prediction, NULL where a feature is NULL or NaN; works on batches and streams alike."""
    complete = reduce(and_, [nan_to_null(F.col(c).cast("double")).isNotNull()
                             for c in model.stages[0].getInputCols()])
    scored = model.transform(rows).withColumn(
        predicted, F.when(complete, non_negative(F.col("raw_prediction"))))
    return scored.drop("features", "raw_prediction")


def learning_curve(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """RMSE on ``rows`` after each boosting round, before clamping; one pass over the rows for all rounds.

    One row per tree of the model.
    """
    vectors, trees = model.stages[0].transform(rows), model.stages[-1]
    errors = [float(e) for e in trees.evaluateEachIteration(vectors, "squared")]
    curve = rows.sparkSession.createDataFrame(list(enumerate(errors, 1)), "round int, squared double")
    return curve.select("round", F.sqrt("squared").alias("rmse"))


def save_model(model: PipelineModel, path: str, replace: bool = False) -> None:
    """Refuses a path that holds a model already, unless it is to be replaced."""
    writer = model.write()
    (writer.overwrite() if replace else writer).save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def compare_learners(training: DataFrame, validation: DataFrame, learners: Mapping[str, object],
                     features: Sequence[str]) -> DataFrame:
    """Trains every learner on the same split; one metric row per learner, with its training seconds."""
    scored, seconds = [], {}
    for name, learner in learners.items():
        started = time.monotonic()
        model = train(training, learner, features)
        seconds[name] = time.monotonic() - started
        scored.append(score(model, validation).select(F.lit(name).alias("model"), DEMAND, "predicted"))
    metrics = regression_metrics(concat_tables(scored))
    times = F.create_map(*[F.lit(v) for name, s in seconds.items() for v in (name, float(s))])
    return metrics.select("model", *METRIC_NAMES, "samples", times[F.col("model")].alias("train_seconds"))
