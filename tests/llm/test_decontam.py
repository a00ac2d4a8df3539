from __future__ import annotations

import re

import pytest

from demandlab.llm import decontam

LONG = " ".join(f"q{i}" for i in range(30))
ITEMS = [(1, LONG), (2, "short answer, five words here"), (3, None), (4, "?!"), (None, "item without id but thirteen words in it "
         "so that it is one window"), (5, LONG), (12, "é ü"), (1, LONG)]


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def by_hand(text):
    mine, hit, items = words(text), set(), set()
    for item, t in ITEMS:
        w = words(t)
        n = min(13, len(w))
        for at in range(len(w) - n + 1) if n else ():
            for i in range(len(mine) - n + 1):
                if mine[i:i + n] == w[at:at + n]:
                    hit.update(range(i, i + n))
                    items.add("" if item is None else str(item))
    return len(mine), len(hit), sorted(items)


TEXTS = [None, "", "no hit at all", "Short ANSWER five-words: here", f"intro {LONG} outro é Ü ü É ü", " ".join(LONG.split()[4:17]),
         " ".join(LONG.split()[4:16]), "short answer five words here " * 3, "x " * 5000 + LONG + " y" * 5000,
         "item without id but thirteen words in it so that it is one window", "é ü", "é  ü é ü", "q" * 100_000, "!!!"]


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_against_brute_force(spark, make_docs, block_bytes):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = decontam.find_contamination(make_docs(TEXTS, clash=True), bench, block_bytes=block_bytes).collect()
    assert len(found) == len(TEXTS)
    for r in found:
        n_words, n_hit, items = by_hand(TEXTS[r.doc_id])
        assert (r.n_words, r.n_hit, r["items"]) == (n_words, n_hit, items)
        assert r.contaminated == (n_hit > 0 and 20 * n_hit >= n_words)
        # Spans of the original text hold exactly the hit words.
        assert len(words(" | ".join((TEXTS[r.doc_id] or "")[s.start:s.end] for s in r.spans))) == n_hit
        assert r.label == "x"


def test_empty_tables(spark, make_docs):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert [r.n_hit for r in decontam.find_contamination(make_docs(["a b"]), bench).collect()] == [0]
    assert decontam.find_contamination(make_docs([]), spark.createDataFrame(ITEMS, "item_id long, text string")).count() == 0
