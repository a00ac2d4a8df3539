"""Neighbours found next to all products."""

from __future__ import annotations

import numpy as np
import pytest

from demandlab.llm import neighbours

SCHEMA = "vec_id long, embedding array<double>, label int, vector string, dim string, rank int, score int, ids string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v if v is None else [None if x is None else float(x) for x in v], 1, "v", "d", 1, 2, "i")
                                  for i, v in rows], SCHEMA)


def sound(v):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)


def plain(rows, k=20, every=20):
    kept = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None and sound(v)]
    out = {}
    for q, (query, v) in enumerate(kept):
        if query % every == 0:
            near = []
            for j, (i, w) in enumerate(kept):
                if j != q and len(w) == len(v):
                    score = 0.0
                    for a, b in zip(v, w, strict=True):
                        score += a * b
                    near.append((-score, i))
            out.setdefault(query, []).append([(i, -s) for s, i in sorted(near)[:k]])
    return out


def lists(found):
    out = {}
    for r in found.collect():
        out.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    return {q: [ranks[k] for k in sorted(ranks)] for q, ranks in out.items()}


def test_small_tables_are_exact_with_nulls_ties_and_repeats(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.integers(-2, 3, 5).tolist()) for i in range(70)] + [(200 + i, [1, 2, 3, 0, 0]) for i in range(60)]
    rows += [(None, [1, 1, 1, 1, 1]), (300, None), (320, []), (340, [0, 0, 0, 0, 0]), (360, [1, None, 1, 1, 1]),
             (380, [float("nan"), 1, 1, 1, 1]), (400, [float("inf"), 1, 1, 1, 1]), (420, [1, 2]), (421, [3, 4]), (440, [7]),
             (460, [-0.0, 1, 0, 0, 0]), (461, [0.0, 1, 0, 0, 0]), (480, [1e30, 1, 1, 1, 1]), (481, [5, 5, 5, 5, 5])]
    got, want = lists(neighbours.search(frame(spark, rows))), plain(rows)
    assert got == {q: w[0] for q, w in want.items() if w[0]}


def test_repeated_rows_are_rows_of_their_own(spark):
    rows = [(20, [1, 0]), (20, [1, 0]), (3, [0, 1]), (4, [1, 1])]
    found = sorted((r["rank"], r["vec_id"], r["score"]) for r in neighbours.search(frame(spark, rows)).collect())
    assert found == sorted([(1, 4, 1.0), (2, 20, 1.0), (3, 3, 0.0)] * 2)


@pytest.mark.parametrize("spread", [0.0, 1.0])
def test_recall_over_several_shards_and_blocks(spark, spread):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((40, 32)) * spread
    made = centres[rng.integers(0, 40, 6000)] + rng.standard_normal((6000, 32))
    rows = [(i, v) for i, v in enumerate(made.tolist())]
    found = lists(neighbours.search(frame(spark, rows), shard_bytes=400_000, block_bytes=60_000, least=100))
    products = made @ made.T
    hits = total = 0
    for q in range(0, 6000, 20):
        products[q, q] = -np.inf
        best = np.argsort(-products[q])[:20]
        assert len(found[q]) == 20 and np.allclose([s for _, s in found[q]], [made[q] @ made[i] for i, _ in found[q]])
        hits, total = hits + len({i for i, _ in found[q]} & set(best.tolist())), total + 20
    print(hits / total)
    assert hits >= 0.9 * total


def test_equal_vectors_beyond_all_bounds(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(3000)] + [(3001, [2.0, 2.0, 3.0])]
    found = lists(neighbours.search(frame(spark, rows)))
    assert found[40] == [(3001, 15.0)] + [(i, 14.0) for i in range(19)]
    assert found[0] == [(3001, 15.0)] + [(i, 14.0) for i in range(1, 20)]


def test_empty_table(spark):
    assert neighbours.search(frame(spark, [])).collect() == []


def test_query_reaches_its_recall(spark, sf_dir):
    found = lists(neighbours.query(spark, sf_dir))
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    want = plain(rows)
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in want[q][0]}) for q in want)
    assert hits >= 0.9 * 20 * len(want) and set(found) == set(want)
