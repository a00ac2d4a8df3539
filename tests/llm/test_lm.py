from __future__ import annotations

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest

from demandlab.llm import lm
from demandlab.llm.common import crc_remainder


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


def rows(n=120):
    rng = random.Random(6)
    made = [(i, " ".join(rng.choice(["the", "of", "a", "É", "x" + str(rng.randrange(40))]) for _ in range(rng.randrange(60))))
            for i in range(n)]
    return [*made, (None, None), (500, ""), (501, "The\tTHE\n of"), (7, made[7][1]), (502, "the " * 3000), (503, "unseen words")]


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(make_docs, small):
    # Small: many ranges, several filters per range, several passes. So many bits that false hits are rare.
    how = {"bits_per_entry": 200, **({"reducer_entries": 200, "filter_bytes": 400} if small else {})}
    data = rows()
    words, pairs = collections.Counter(), collections.Counter()
    for doc_id, text in data:
        if not held(doc_id):
            w = tokens(text)
            words.update(w)
            pairs.update(zip([None, *w[:-1]], w, strict=True))
    n, v = sum(words.values()), len(words)
    docs = make_docs(data, clash=True)
    out = crc_remainder(docs.doc_id, 10) == 0
    filters, got_n, got_v, ranges = lm.train(docs.where(~out), **how)
    assert (got_n, got_v) == (n, v) and (ranges > 1) == small
    assert (filters.where('parts > 1').count() > 0) == small
    got = lm.score(docs, filters, got_n, got_v, ranges, **({"block_bytes": 3000} if small else {})).collect()
    assert len(got) == len(data)
    by_id = collections.defaultdict(list)
    for doc_id, text in data:
        w = tokens(text)
        p = {x: (words[x] + 0.1) / (n + 0.1 * (v + 1)) for x in w}

        def middle(c):
            return (3 * 2 ** (int(math.log2(c))) - 1) / 2 if c else 0

        full = sum(math.log10((middle(pairs[a, b]) + lm.STRENGTH * p[b]) / (words[a] + lm.STRENGTH))
                   for a, b in zip([None, *w[:-1]], w, strict=True))
        by_id[doc_id].append((len(w), sum(words[x] > 0 for x in w), sum(math.log10(p[x]) for x in w), full))
    off = 0
    for r in got:
        same = [want for want in by_id[r.doc_id] if (r.n_tokens, r.n_known) == want[:2]
                and r.base_score == pytest.approx(want[2])]
        assert same, r
        # A filter has false hits; the score of a text without one is that of the quantised counts.
        off += not any(r.score == pytest.approx(want[3], abs=1e-6) for want in same)
        assert any(r.score == pytest.approx(want[3], rel=0.1) for want in same), r
    assert off <= 3


def test_nothing_to_learn_from(spark, make_docs):
    docs = make_docs(["a b", None])
    filters, n, v, ranges = lm.train(docs.where("false"))
    got = sorted((r.doc_id, r.n_tokens, r.n_known) for r in lm.score(docs, filters, n, v, ranges).collect())
    assert (n, v, got) == (0, 0, [(0, 3, 0), (1, 1, 0)])
    assert lm.score(make_docs([]), filters, n, v, ranges).count() == 0


def test_filter_names_the_level_of_counts():
    rng = np.random.default_rng(2)
    entries = rng.integers(0, 1 << 62, 5000, dtype=np.uint64)
    counts = rng.integers(1, 200, 5000)
    packed = lm.build_filter(entries, counts)
    bits = lm.filter_bits(counts)
    level = lm.look_up(packed, bits, entries)
    assert (level >= lm._levels(counts)).all() and (level == lm._levels(counts)).mean() > 0.97
    absent = rng.integers(1 << 62, 1 << 63, 5000, dtype=np.uint64)
    assert (lm.look_up(packed, bits, absent) > 0).mean() < 0.03
