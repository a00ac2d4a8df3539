from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from demandlab.llm import spotsigs

TEXTS = [None, "", "The cat of the house sat on a mat", "the the the", "zebra common word", "line\nbreak\n\nand more words here",
         "The cat of the house sat on a mat", "é" * 5 + " der Hund ist groß 😀 und", "x " * 4000, "THE " * 1000 + "end"]


def after(rows):
    order = sorted(rows, key=lambda r: r[1] or "")
    order = sorted(order, key=lambda r: (r[0] is None, -(r[0] or 0)))
    return [(a, order[(i + 1) % len(order)]) for i, a in enumerate(order)]


@pytest.mark.parametrize("range_bytes", [16 << 20, 400])
def test_next_document(make_docs, monkeypatch, range_bytes):
    monkeypatch.setattr(spotsigs, "RANGE_BYTES", range_bytes)
    rows = list(enumerate(TEXTS)) + [(None, "z"), (None, "y"), (3, "other text"), (-4, "below zero"), (10 ** 12, "far")]
    got = sorted(((r.doc_id, r.text, r.next_text) for r in spotsigs.with_next(make_docs(rows, clash=True)).collect()), key=repr)
    assert got == sorted(((a[0], a[1] or "", b[1] or "") for a, b in after(rows)), key=repr)


def test_one_row_and_none(make_docs):
    assert [r.next_text for r in spotsigs.with_next(make_docs(["only"])).collect()] == ["only"]
    assert spotsigs.with_next(make_docs([])).count() == 0


def test_signatures_are_anchor_and_content_words(make_docs):
    got = make_docs(["Rain fell; the cat and dog of a house slept in it all day\nnew line"]).select(
        spotsigs.signatures(F.col("text")).alias("s")).first().s
    assert got == ["§ rain fell cat", "the cat dog", "and dog house slept", "of house slept", "a house slept all",
                   "in all day new", "it all day new", "§ new line"]


def test_fingerprints(make_docs):
    rows = make_docs(TEXTS).select("doc_id", spotsigs.fingerprint(F.col("text")).alias("f")).collect()
    f = {r.doc_id: r.f for r in rows}
    assert f[2] == f[6] and f[0] == f[1] == [] and f[2] != f[5]
    assert all(x == sorted(set(x)) for x in f.values())
    one = hashlib.md5("§ zebra common word".encode()).hexdigest()[:12]
    assert f[4] == [one]


def test_pairs_against_brute_force(spark):
    sets = {i: sorted({f"{(i // 4) * 50 + k:03d}" for k in range(10 + i % 7)} | {f"x{i % 3}"}) for i in range(40)}
    sets[99] = []
    df = spark.createDataFrame(list(sets.items()), "id long, fingerprint array<string>")
    want = {(min(a, b), max(a, b)) for a in sets for b in sets if a < b and sets[a] and sets[b]
            and len(set(sets[a]) & set(sets[b])) >= 0.8 * len(set(sets[a]) | set(sets[b])) - 1e-9}
    got = {(min(r.a, r.b), max(r.a, r.b)) for r in spotsigs.similar_pairs(df).collect()}
    assert got == want and want
