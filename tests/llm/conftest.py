from __future__ import annotations

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from texts, or from (doc_id, text) pairs; more columns clash with names that operators use."""

    def made(texts, clash=False):
        rows = [(t if isinstance(t, tuple) else (i, t)) for i, t in enumerate(texts)]
        df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCUMENTS)
        if clash:
            for name in ("score", "predicted", "n_words", "items", "spans", "hit_words", "contaminated", "secrets", "ids",
                         "n_tokens", "key", "text_hash", "root", "label", "features", "lang_pred", "range"):
                df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return made


@pytest.fixture(scope="session")
def some_documents(spark, sf_dir):
    """The small documents table of the test data."""
    return spark.read.parquet(f"{sf_dir.replace('sf0.01', 'sf0.001')}/documents.parquet")
