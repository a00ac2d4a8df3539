from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from demandlab.catalog import adapters
from demandlab.operators.metrics import METRIC_NAMES
from demandlab.operators.models import boosted_trees, compare_learners, linear_model, random_forest, score, train
from demandlab.operators.ranking import settle
from demandlab.operators.sampling import label_by_time
from demandlab.schemas import COMPARISON_FEATURES, DEMAND, WINDOW, ZONE
from demandlab.session import scratch_path
from demandlab.operators.profile import write_profile
from demandlab.streaming.checks import check_stream
from demandlab.streaming.demand import score_stream
from demandlab.streaming.io import append_to_table, file_stream


@pytest.fixture(scope="module")
def parts(spark, sf_dir):
    rows = settle(label_by_time(adapters.features(spark, sf_dir)), "test-features")
    return rows.filter("part = 'train'").drop("part"), rows.filter("part = 'validation'").drop("part")


def test_learners_are_compared_on_the_same_rows(parts):
    training, validation = parts
    learners = {"gbt": boosted_trees(trees=3), "forest": random_forest(trees=5), "linear": linear_model()}
    table = compare_learners(training, validation, learners, COMPARISON_FEATURES)
    rows = {r["model"]: r for r in table.collect()}
    assert set(rows) == set(learners) and set(METRIC_NAMES) <= set(table.columns)
    assert {r["samples"] for r in rows.values()} == {validation.count()}
    assert all(r["train_seconds"] > 0 for r in rows.values())


def test_trees_are_deterministic_and_beat_the_mean(parts):
    training, validation = parts
    first, second = (score(train(training, boosted_trees(trees=3)), validation) for _ in range(2))
    columns = [WINDOW, ZONE, "predicted"]
    assert first.select(columns).exceptAll(second.select(columns)).count() == 0
    mean = training.agg(F.avg(DEMAND)).first()[0]
    row = first.agg(F.avg(F.pow(F.col("predicted") - F.col(DEMAND), 2)), F.avg(F.pow(F.lit(mean) - F.col(DEMAND), 2)))
    got, plain = row.first()
    assert got < plain


def test_a_missing_field_ends_neither_batch_nor_stream(spark, parts):
    training, validation = parts
    model = train(training, linear_model(), ["hour", "lag_1"])
    broken = validation.withColumn("lag_1", F.when(F.col(ZONE) == 4, F.lit(None)).when(
        F.col("hour") == 3, F.lit(float("nan"))).otherwise(F.col("lag_1").cast("double")))
    missing = (F.col(ZONE) == 4) | (F.col("hour") == 3)
    assert score(model, broken).filter(missing & F.col("predicted").isNotNull()).count() == 0
    assert score(model, broken).filter(~missing & F.col("predicted").isNull()).count() == 0
    source, path = scratch_path(spark, "to-score"), scratch_path(spark, "scored")
    broken.write.parquet(source)
    append_to_table(score_stream(model, file_stream(spark, source, broken.schema)), path, f"{path}-checkpoint")
    scored = spark.read.parquet(path)
    assert scored.count() == broken.count()
    assert scored.filter(missing & F.col("predicted").isNotNull()).count() == 0
    assert scored.filter(missing & (F.size("errors") == 0)).count() == 0


def test_streaming_scores_equal_batch_scores(spark, parts):
    training, validation = parts
    model = train(training, linear_model())
    source, path = scratch_path(spark, "to-score"), scratch_path(spark, "scored")
    broken = validation.withColumn("hour", F.when(F.col(ZONE) == 4, 99).otherwise(F.col("hour")))
    broken.repartition(2).write.parquet(source)
    append_to_table(score_stream(model, file_stream(spark, source, broken.schema, files_per_trigger=1)), path, f"{path}-checkpoint")
    scored = spark.read.parquet(path)
    assert scored.count() == validation.count()
    assert scored.filter(f"{ZONE} = 4 AND predicted IS NOT NULL").count() == 0
    assert scored.filter(f"{ZONE} = 4 AND errors[0] = 'hour: not in [0, 23]'").count() > 0
    columns = [WINDOW, ZONE, F.round("predicted", 9)]
    batch = score(model, validation).filter(f"{ZONE} <> 4")
    assert batch.select(columns).exceptAll(scored.select(columns)).count() == 0


def test_one_check_per_batch(spark, parts):
    training, validation = parts
    source, path = scratch_path(spark, "to-check"), scratch_path(spark, "checked")
    rows = adapters.with_forecasts(validation).withColumnRenamed("by_champion", "predicted")
    rows.repartition(2).write.parquet(source)
    stream = file_stream(spark, source, rows.schema, files_per_trigger=1)
    write_profile(training, f"{path}-profile", ["hour", "lag_1"])
    check_stream(stream, f"{path}-profile", 0.5, path, f"{path}-checkpoint", features=["hour", "lag_1"])
    checks = spark.read.parquet(path).collect()
    assert len(checks) == 2 and sum(c["samples"] for c in checks) == validation.count()
    assert all(c["total_features"] == 2 and c["valid_records"] == c["samples"] for c in checks)


class Called(Exception):
    pass


def test_registered_learners_have_the_operators_full_size(spark, sf_dir, monkeypatch):
    from demandlab.catalog import models, streams
    from demandlab.schemas import FEATURES

    seen = []

    def call(*args, **named):
        seen.append((args, named))
        raise Called

    for module in (models, streams):
        for name in ("retrain", "compare_learners", "train"):
            if hasattr(module, name):
                monkeypatch.setattr(module, name, call)
    small = sf_dir.replace("sf0.01", "sf0.001")
    for run in (models.boosted, models.learner_comparison, models.batch_scoring, models.persisted_model,
                models.continual_check, streams.streaming_scores):
        with pytest.raises(Called):
            run(spark, small)
    assert seen[0][0][1].getMaxIter() == 100
    learners = seen[1][0][2]
    assert learners["gbt"].getMaxIter() == 100 and learners["forest"].getNumTrees() == 100
    # The others train the default learner (100 boosted trees) on the default list (all features).
    for args, named in seen[2:]:
        assert len(args) == 1 and not named
    assert train.__defaults__ == (None, FEATURES) and boosted_trees().getMaxIter() == 100


def test_the_learning_curve_ends_at_the_error_of_the_model(parts):
    from demandlab.operators.models import learning_curve

    training, validation = parts
    model = train(training, boosted_trees(trees=4))
    curve = [r["rmse"] for r in learning_curve(model, validation).orderBy("round").collect()]
    raw = model.transform(validation).agg(
        F.sqrt(F.avg(F.pow(F.col("raw_prediction") - F.col(DEMAND), 2)))).first()[0]
    assert len(curve) == 4 and curve[-1] == pytest.approx(raw, abs=1e-9)
    shorter = train(training, boosted_trees(trees=2))
    assert learning_curve(shorter, validation).agg(F.max("round")).first()[0] == 2
    assert curve[1] == pytest.approx(learning_curve(shorter, validation).filter("round = 2").first()["rmse"])
