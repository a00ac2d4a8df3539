"""Registered queries of the text operators and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from demandlab.llm import decontam, jaccard, langid, licenses, lm, merkle, neighbours, pieces, quality, ranked, secrets, spotsigs, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": warc.query,
    "op2_ngram_jaccard": jaccard.query,
    "op3_secrets": secrets.query,
    "op4_lm_score": lm.query,
    "op5_decontamination": decontam.query,
    "op6_licenses": licenses.query,
    "op7_language": langid.query,
    "op8_quality": quality.query,
    "op9_sentencepiece": pieces.query,
    "op10_spot_signatures": spotsigs.query,
    "op11_nearest_neighbours": neighbours.query,
    "op12_merkle": merkle.query,
    "op13_ranked_search": ranked.query,
}

SQL: dict[str, str] = {
    "op1_warc": warc.SQL,
    "op5_decontamination": decontam.SQL,
    "op10_spot_signatures": spotsigs.SQL,
    "op12_merkle": merkle.SQL,
    "op13_ranked_search": ranked.SQL,
}
