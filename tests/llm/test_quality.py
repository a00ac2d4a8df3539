from __future__ import annotations

import numpy as np
import pyarrow as pa

from demandlab.llm import quality


def test_held_out_accuracy(spark, sf_dir):
    rows = {r.doc_id: r for r in quality.query(spark, sf_dir).collect()}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    held = [x for x in labels if rows[x.doc_id].held_out]
    assert len(held) > 50
    assert sum(rows[x.doc_id].predicted == x.quality for x in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())


def test_measures_of_odd_texts():
    texts = pa.array(["", None, "one", "a a a a", "A B!\n|", "x" * 50_000, "w " * 20_000])
    found = quality.measures(texts)
    assert found.shape[0] == 7 and np.isfinite(found).all() and (found[0] == found[1]).all()
    alone = np.concatenate([quality.measures(texts.slice(i, 1)) for i in range(7)])
    assert np.allclose(found, alone)


def test_one_label_value_or_none(spark, make_docs):
    docs = make_docs(["good text", "more text", None], clash=True)
    for rows, want in (([(0, 1), (1, 1)], 1.0), ([(0, 0)], 0.0), ([], 0.5), ([(0, None)], 0.5)):
        labels = spark.createDataFrame(rows, "doc_id long, quality int")
        got = quality.score(docs, quality.learn(docs, labels)).collect()
        assert [r.score for r in got] == [want] * 3 and got[0].features == "x"
    assert quality.score(make_docs([]), quality.rank(np.zeros((0, 1)), np.zeros(0), np.zeros(0, bool))).count() == 0


def test_ranking_prefers_the_better_rows():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3))
    label = (x[:, 1] + 0.3 * rng.normal(size=400) > 0.5).astype(int)
    model = quality.rank(x, label, np.arange(400) % 5 == 0)
    score = model.score(x)
    assert ((score >= 0.5) == label).mean() > 0.85 and abs(model.weights[1]) > 3 * abs(model.weights[[0, 2]]).max()


def test_every_labelled_row_is_learned(spark, make_docs):
    """The fit is that of all rows, of whole pairs, and its cut follows the share of worse rows among all of them."""
    rng = np.random.default_rng(3)
    words = ["good", "Fine", "plain!", "| x", "12"]
    texts = [" ".join(rng.choice(words, size=rng.integers(1, 12))) for _ in range(300)]
    quality_of = [int(t.count("good") + rng.normal() > 2) for t in texts]
    labels = spark.createDataFrame(list(enumerate(quality_of)), "doc_id long, quality int")
    model = quality.learn(make_docs(texts).repartition(7), labels)
    found, label = quality.measures(pa.array(texts)), np.array(quality_of)
    assert np.allclose(model.mean, found.mean(axis=0)) and np.allclose(model.scale, found.std(axis=0) + 1e-6)
    x = (found - model.mean) / model.scale
    scores = x @ model.weights
    assert np.isclose(model.threshold, np.quantile(scores, (label == 0).mean()))
    gap = (x[label == 1][:, None, :] - x[label == 0][None, :, :]).reshape(-1, x.shape[1])
    slope = gap.T @ (1 / (1 + np.exp(gap @ model.weights))) / len(gap) - quality.RIDGE * model.weights
    assert np.abs(slope).max() < 2e-4


def test_texts_are_measured_before_they_meet_labels(spark, make_docs, monkeypatch):
    """What is shuffled for the join is a row of measures; labels and documents that repeat make each pair."""
    plans, stored, settle = [], [], quality.settle

    def kept(df, label):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        stored.append(settle(df, label))
        return stored[-1]

    monkeypatch.setattr(quality, "settle", kept)
    docs = make_docs([(1, "good text"), (1, "good text"), (2, None), (3, "bad!"), (4, "no label"), (None, "no key")])
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, 0), (3, None), (None, 1)], "doc_id long, quality int")
    quality.learn(docs, labels)
    assert 0 <= plans[0].index("Join") < plans[0].index("MapInArrow")
    assert sorted(r.quality for r in stored[0].collect()) == [0, 1, 1, 1, 1]
    width = quality.measures(pa.array([""])).shape[1]
    assert {len(r.measures) for r in stored[0].collect()} == {width // 2}
