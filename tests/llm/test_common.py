from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from demandlab.llm import common


def test_words_of_rows_are_told_apart_by_content_only():
    texts = ["Alpha beta", None, "", "beta, ALPHA!", "ab", "a b", "é1 x" * 10]
    h, first = common.word_hashes(pa.array(texts), common.WORDS)
    assert list(np.diff(first)) == [2, 0, 0, 2, 1, 2, 11]
    assert h[0] == h[first[3] + 1] and h[1] == h[first[3]]
    assert h[first[4]] not in h[first[5]:first[6]]


def test_a_long_row_is_hashed_in_pieces(monkeypatch):
    text = " ".join(f"w{i % 977}" for i in range(5000))
    whole, _ = common.word_hashes(pa.array([text]), common.WORDS)
    monkeypatch.setattr(common, "STEP_BYTES", 512)
    pieces, _ = common.word_hashes(pa.array([text]), common.WORDS)
    assert (whole == pieces).all()


def test_hashing_a_step_takes_little_memory_and_keeps_less(monkeypatch):
    monkeypatch.setattr(common, "_powers", {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)})
    column = pa.array([" ".join(f"word{i % 977}" for i in range(30_000))] * 40)
    tracemalloc.start()
    common.word_hashes(column, common.WORDS)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 16 * column.nbytes
    assert sum(x.nbytes for x in common._powers.values()) <= 16 * common.PIECE_BYTES


def test_a_word_longer_than_a_piece(monkeypatch):
    monkeypatch.setattr(common, "_powers", {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)})
    column = pa.array(["one " + "x" * 5000 + " two", "x" * 5000, "two one"])
    whole, _ = common.word_hashes(column, common.WORDS)
    monkeypatch.setattr(common, "_powers", {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)})
    monkeypatch.setattr(common, "PIECE_BYTES", 64)
    pieces, _ = common.word_hashes(column, common.WORDS)
    assert (whole == pieces).all() and pieces[1] == pieces[3]
    assert max(map(len, common._powers.values())) <= 64


def test_memory_is_handed_back_after_the_last_batch(monkeypatch):
    told = []
    monkeypatch.setattr(common, "give_back", lambda: told.append("back"))
    assert list(common.handed_back(lambda batches: (told.append(b) or b for b in batches))(iter([1, 2]))) == [1, 2]
    assert told == [1, 2, "back"]


def test_steps_keep_every_row():
    batch = pa.RecordBatch.from_pydict({"text": ["x" * n for n in (0, 50, 3, 0, 99, 1)]})
    assert [r for part in common.steps(batch, limit=52) for r in part.column("text").to_pylist()] \
        == batch.column("text").to_pylist()


def test_sliced_columns():
    column = pa.array(["aa", "bb cc", None, "dd"])
    h, first = common.word_hashes(column.slice(1, 3), common.WORDS)
    assert list(first) == [0, 2, 2, 3] and len(h) == 3


def test_components_against_brute_force(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)]
    edges += [(200, x) for x in range(201, 240)] + [(300, 300)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = common.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == {x: find(x) for x in root} and len(got) == len(root)


def test_components_of_nothing(spark):
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0
