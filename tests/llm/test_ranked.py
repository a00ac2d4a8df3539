"""Ranked search next to a plain scorer."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest

from demandlab.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, k=20):
    held = [(i, terms(t)) for i, t in docs]
    n_docs, n_words = sum(bool(w) for _, w in held), sum(len(w) for _, w in held)
    df = Counter(t for _, w in held for t in set(w))
    out = []
    for item, text in items:
        asked, scores = Counter(terms(text)), []
        for doc, words in held:
            if not words:
                continue
            m, tf = 75 + 25 * len(words) * n_docs // n_words, Counter(words)
            score = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (10**9 * tf[t] // (1000 * tf[t] + 12 * m)) for t, times in asked.items() if tf[t])
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def run(make_docs, spark, docs, items, **options):
    asked = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, item string, score int")
    found = ranked.search(make_docs(docs, clash=True), asked, **options)
    assert found.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    return sorted((tuple(r) for r in found.collect()), key=repr)


@pytest.mark.parametrize("options", [{}, {"shard_counts": 700}, {"shard_counts": 700, "block_bytes": 200}])
def test_equals_plain_scores(make_docs, spark, options):
    rng = np.random.default_rng(3)
    words = np.array([f"w{k}" for k in range(300)])
    chance = 1 / np.arange(1, 301)
    text = lambda size: " ".join(rng.choice(words, size, p=chance / chance.sum()))
    docs = [(i, text(int(rng.integers(1, 60)))) for i in range(400)] + [(900 + i, "w7 w8 W9, w7") for i in range(60)]
    items = [(i, text(12)) for i in range(12)] + [(50, "w7 w8 w9"), (51, "w299"), (52, "nowhere")]
    assert run(make_docs, spark, docs, items, **options) == plain(docs, items)


def test_nulls_ties_repeats_and_long_texts(make_docs, spark):
    docs = [(None, "red fox"), (None, None), (1, ""), (2, None), (3, "red fox"), (3, "red fox"), (4, "Red-FOX é1"),
            (5, "blue " * 200_000 + "fox"), *[(7, "hare and hound")] * 30]
    items = [(None, "red red fox"), (1, None), (2, ""), (3, "blue é1"), (3, "blue é1"), (4, "hare, HOUND")]
    assert run(make_docs, spark, docs, items) == plain(docs, items)


def test_empty_tables(make_docs, spark):
    assert run(make_docs, spark, [], [(1, "a")]) == []
    assert run(make_docs, spark, [(1, "a")], []) == []


def test_stops_before_the_end_of_its_lists():
    rng = np.random.default_rng(1)
    counts = rng.zipf(1.5, 5000).clip(1, 10_000)
    shard = ranked.Shard(np.full(5000, 50), np.ones(5000, int), np.zeros(5000, int), counts, 1, 5000, 250_000)
    docs, scores = shard.best(np.array([0]), np.array([3]), 20, 0)
    assert len(docs) < 5000 and np.sort(scores)[::-1][:20].tolist() == np.sort(3 * shard.impact)[::-1][:20].tolist()
