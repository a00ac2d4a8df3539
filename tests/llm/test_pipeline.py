from __future__ import annotations

import corpus_pipeline
from pyspark.sql import functions as F

from demandlab.llm import pieces, quality
from demandlab.llm.common import crc_remainder, settle

from .test_jaccard import brute
from .test_secrets import base


def test_stages(spark, sf_dir):
    small = sf_dir.replace("sf0.01", "sf0.001")
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, before, seen = docs.columns, docs, {}
    for name, stage in corpus_pipeline.STAGES:
        after = settle(stage(spark, before, small), "test-stage")
        seen[name] = ({r.doc_id: r for r in before.collect()}, {r.doc_id: r for r in after.collect()})
        assert name == "sentencepiece" or after.columns == columns
        before = after
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_copies", "decontamination", "secrets", "sentencepiece"]

    went, came = seen["quality"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    wrong = [i for i in went if i in labels and (i in came) != bool(labels[i])]
    assert len(wrong) <= 0.05 * len(labels)

    went, came = seen["near_copies"]
    assert sorted(came) == sorted({g for *_, g in brute([(i, r.text) for i, r in went.items()])})

    went, came = seen["decontamination"]
    assert 0 < len(went) - len(came) < 0.2 * len(went)

    went, came = seen["secrets"]
    assert set(went) == set(came)
    for i, r in went.items():
        assert came[i].n_chars == len(came[i].text) and not base(came[i].text)
        assert base(r.text) or "[SECRET]" in came[i].text or came[i].text == r.text

    went, came = seen["sentencepiece"]
    assert set(went) == set(came) and all(r.round_trip and r.parity and r.n_tokens == len(r.ids) for r in came.values())


def test_odd_rows_keep_their_columns(spark, sf_dir, make_docs):
    """All stages on odd rows: what stays has the values it came with, under names that operators use as well."""
    small = sf_dir.replace("sf0.01", "sf0.001")
    good = spark.read.parquet(f"{small}/documents.parquet").where("text IS NOT NULL").orderBy("doc_id")
    texts = [(None, None), (1, ""), (1, ""), (2, "word " * 30_000), (3, None), (4, 'password: "abcdefgh1234"')]
    docs = make_docs(texts + [(100 + r.doc_id, r.text) for r in good.limit(60).collect()], clash=True)
    docs = docs.withColumns({"_id": F.lit("mine"), "_text": F.lit("own"), "a.b`c": F.lit("dot"),
                             "score": F.concat(F.lit("s"), F.xxhash64("text").cast("string"))})
    columns, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = settle(stage(spark, before, small), "test-odd")
        assert after.columns == columns, name
        was = {tuple(r) for r in before.drop("text", "n_chars").collect()}
        now = [tuple(r) for r in after.drop("text", "n_chars").collect()]
        assert now and set(now) <= was, name
        before = after
    last = corpus_pipeline.STAGES[-1][1](spark, before, small)
    assert last.count() == before.count() and "_id" in last.columns


def test_empty_documents(spark, sf_dir, make_docs):
    docs = make_docs([])
    for _, stage in corpus_pipeline.STAGES:
        docs = settle(stage(spark, docs, sf_dir.replace("sf0.01", "sf0.001")), "test-empty")
    assert docs.count() == 0
