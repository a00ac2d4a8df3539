from __future__ import annotations

from demandlab.llm import langid


def test_held_out_accuracy_and_range(spark, sf_dir):
    rows = langid.query(spark, sf_dir).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(docs) and 0.2 < len(held) / len(rows) < 0.5
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows) and sum(r.rejected for r in held) <= 0.1 * len(held)


def test_odd_rows(spark, make_docs):
    texts = [None, "", "1234 !!", "日本", "the and of with that this", "der die und das mit nicht", "der und " * 20000]
    lines = ["the and of with that this is", "der die und das mit nicht ist"] * 30
    train = spark.createDataFrame([(f"{t} {i}", ("en", "de")[i % 2] if i % 7 else None) for i, t in enumerate(lines)],
                                  "text string, lang string")
    got = {r.doc_id: r for r in langid.predict(make_docs(texts, clash=True), langid.learn(train)).collect()}
    assert [got[i].lang_pred for i in (0, 1, 2)] == ["und"] * 3 and got[0].score == 0.0 and got[0].rejected
    assert [got[i].lang_pred for i in (4, 5, 6)] == ["en", "de", "de"] and got[3].lang_pred in ("en", "de")
    assert got[4].features == "x"


def test_nothing_learned(spark, make_docs):
    empty = spark.createDataFrame([], "text string, lang string")
    assert [r.lang_pred for r in langid.predict(make_docs(["text"]), langid.learn(empty)).collect()] == ["und"]
    one = spark.createDataFrame([("some words here", "en")] * 3, "text string, lang string")
    assert [r.lang_pred for r in langid.predict(make_docs(["text"]), langid.learn(one)).collect()] == ["en"]
    assert langid.predict(make_docs([]), None).count() == 0


def test_a_rare_language_is_learned(spark, make_docs):
    lines = {"en": "the and of with that this is for you", "de": "der die und das mit nicht ist auch ein",
             "hu": "egy nem hogy csak meg volt ezt mint azt"}
    rows = [(f"{lines[lang]} {i % 50}", lang) for lang, n in (("en", 6000), ("de", 3000), ("hu", 12)) for i in range(n)]
    model = langid.learn(spark.createDataFrame(rows, "text string, lang string"), sample_rows=200)
    assert model.langs == ["de", "en", "hu"]
    got = langid.predict(make_docs([f"{lines['hu']} {k}" for k in range(60, 70)]), model).collect()
    assert [r.lang_pred for r in got] == ["hu"] * 10


def test_whole_texts_are_learned():
    """What tells two languages apart may stand at the end of a long text."""
    ends = [("zzyzx", "a"), ("qwrtp", "b")]
    rows = [(langid.bag(langid.LOWERED[langid.np.frombuffer(f"{'word ' * 400}{(end + ' ') * 40}".encode(), "u1")]), lang, i)
            for i in range(40) for end, lang in ends]
    model = langid.train(rows)
    seen, share = rows[0][0]
    assert model.langs[int((share @ model.votes[seen] + model.bias).argmax())] == "a"
