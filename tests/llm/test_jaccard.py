from __future__ import annotations

import random
import re

import numpy as np
import pytest

from demandlab.llm import jaccard


def words(text):
    return re.sub(r"[\x00-\x2F\x3A-\x40\x5b-\x60\x7B-\x7F]", " ", text.lower()).split()


def runs(text):
    w = words(text or "")
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """(doc_id, n_links, group_id) of distinct doc_ids, all pairs compared."""
    sets = {i: runs(t) for i, t in rows}
    same = {i: (t or "") for i, t in rows}
    links, root = {i: 0 for i, _ in rows}, {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            near = both >= 0.8 * (len(sets[a]) + len(sets[b]) - both) - 1e-9 if sets[a] and sets[b] else \
                not sets[a] and not sets[b] and same[a] == same[b]
            if near:
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted((i, links[i], find(i)) for i in ids)


def corpus(seed=1, copies=40):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 60))) for _ in range(60)]
    base = [rng.choice(vocabulary) for _ in range(120)]
    for _ in range(copies):  # a group of near copies, some of them beyond the threshold
        edited = list(base)
        for _ in range(rng.randrange(0, 5)):
            edited[rng.randrange(len(edited))] = rng.choice(vocabulary)
        rows.append(" ".join(edited))
    rows += [rows[0].upper(), rows[1].replace(" ", ", "), rows[70], None, "", "...", "...", "one two", "one two"]
    return list(enumerate(rows))


@pytest.mark.parametrize("options", [{}, {"block": 7}, {"block_bytes": 3000}])
def test_links_and_groups_against_all_pairs(make_docs, options, monkeypatch):
    if "block_bytes" in options:
        monkeypatch.setattr(jaccard, "CHUNK", 5)
    rows = corpus()
    got = jaccard.join_near_copies(make_docs(rows, clash=True), **options)
    assert sorted((r.doc_id, r.n_links, r.group_id) for r in got.collect()) == brute(rows)


def test_one_of_each_group_stays(make_docs):
    rows = corpus(seed=2)
    kept = sorted(r.doc_id for r in jaccard.keep_one_per_group(make_docs(rows)).collect())
    assert kept == sorted({group for *_, group in brute(rows)})


def test_null_and_repeated_ids(make_docs):
    text = " ".join(f"a{i}" for i in range(40))
    near = text + " more"
    rows = [(None, text), (None, near), (None, "quite another text of six words"), (5, text), (5, text), (5, "alone here")]
    got = jaccard.join_near_copies(make_docs(rows)).collect()
    assert len(got) == 6
    assert sorted(r.n_links for r in got) == [0, 0, 3, 3, 3, 3]
    assert jaccard.keep_one_per_group(make_docs(rows)).count() == 3


def test_thousands_of_null_ids(make_docs):
    """Classes without an id, near and equal, are as cheap as others and lose no link."""
    base = [f"a{i}" for i in range(60)]
    near = [" ".join(base[:k] + [f"x{k}"] + base[k + 1:]) for k in range(40)]
    rows = [(None, t) for t in near * 50] + [(None, f"alone {k} with five words more {k}") for k in range(3000)]
    got = jaccard.join_near_copies(make_docs(rows)).groupBy("n_copies", "n_links").count().collect()
    sets = [runs(t) for t in near]
    linked = [sum(len(a & b) >= 0.8 * len(a | b) for b in sets) for a in sets]
    want = {(1, 0): 3000}
    for n in linked:
        want[(50, 50 * n - 1)] = want.get((50, 50 * n - 1), 0) + 50
    assert {(r.n_copies, r.n_links): r["count"] for r in got} == want


def test_own_columns_are_kept(make_docs):
    docs = make_docs(["one two three four five six", "quite another text of six words"]).selectExpr(
        "*", "'mine' AS _id", "doc_id AS _text", "'k' AS text_hash")
    kept = jaccard.keep_one_per_group(docs)
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect())) == sorted(map(tuple, docs.collect()))


def test_query_against_all_pairs(spark, sf_dir):
    small = sf_dir.replace("sf0.01", "sf0.001")
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    got = jaccard.query(spark, small)
    assert sorted((r.doc_id, r.n_links, r.group_id) for r in got.collect()) == brute(rows)


def test_empty_table(make_docs):
    assert jaccard.join_near_copies(make_docs([])).count() == 0


def test_pruning_needs_fewer_agreements_than_the_threshold_suggests():
    least = jaccard.fewest_matches(0.8, 1e-9)
    assert least[0] == 0 and all(a <= b for a, b in zip(least, least[1:], strict=False))
    assert 0 < least[96] < 0.8 * 96


def test_compare_is_exact_for_similar_sets():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 1 << 60, 300, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[:300 - k], rng.integers(0, 1 << 60, k, dtype=np.uint64)])) for k in range(0, 90, 3)]
    a, b = np.triu_indices(len(sets), 1)
    want = [len(set(sets[i]) & set(sets[j])) >= 0.8 * len(set(sets[i]) | set(sets[j])) for i, j in zip(a, b)]
    assert jaccard.compare(sets, a, b).tolist() == want
    few = slice(0, 20)
    assert jaccard.compare(sets, a[few], b[few]).tolist() == want[few]
