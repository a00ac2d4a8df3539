"""Manifests next to a plain recursive tree."""

from __future__ import annotations

from hashlib import sha256

from pyspark.sql import functions as F

from demandlab.llm import merkle


def hashed(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf(row, change=None) -> str:
    out = ""
    for name in merkle.COLUMNS:
        value = row[name] if change is None or name != "text" or row[name] is None else change(row[name])
        out += "-" if value is None else f"{len(str(value).encode())}:{value}"
    return hashed(out)


def tree(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """Last node, and for each leaf its steps (before, after)."""
    steps, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, place in enumerate(at):
            run = nodes[place // 8 * 8:place // 8 * 8 + 8]
            steps[i].append(("".join(run[:place % 8]), "".join(run[place % 8 + 1:])))
        at = [place // 8 for place in at]
        nodes = [hashed("".join(nodes[k:k + 8])) for k in range(0, len(nodes), 8)]
    return (nodes[0] if nodes else None), steps


def expected(rows, change):
    groups: dict = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    made = []
    for name in names:
        groups[name].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        made.append(tree([leaf(r) for r in groups[name]]))
    root, upper = tree([m[0] for m in made])
    out = []
    for name, (subroot, steps), more in zip(names, made, upper, strict=True):
        for row, own in zip(groups[name], steps, strict=True):
            path, h = own + more, leaf(row, change)
            for before, after in path:
                h = hashed(before + h + after)
            out.append((row["doc_id"], leaf(row), subroot, root, hashed("".join(b + a for b, a in path)), h, h == root))
    return out


def check(docs):
    changed = {"text": F.translate("text", merkle.UPPER, merkle.LOWER)}
    lower = str.maketrans(merkle.UPPER, merkle.LOWER)
    got = [tuple(r) for r in merkle.prove(docs, tampered=changed).collect()]
    want = expected([r.asDict() for r in docs.collect()], lambda t: t.translate(lower))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    return got


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, path int, run int, n string"


def rows(spark, made):
    return spark.createDataFrame([(i, t, g, "s", len(t or ""), "k", 1, 2, "n") for i, t, g in made], SCHEMA)


def test_groups_of_many_sizes_and_names(spark):
    made = [(i, f"Text {i} é", f"g{k}") for k, size in enumerate([1, 2, 7, 8, 9, 63, 64, 65, 130, 600, 8, 3]) for i in range(size)]
    got = check(rows(spark, made))
    assert not any(r[-1] for r in got)  # every text has a capital letter


def test_nulls_ties_repeats_and_clashing_names(spark):
    made = [(None, None, None), (None, "", None), (None, "A", "x"), (3, "b", ""), (3, "a", ""), (3, "a", ""), (3, None, "é"),
            (-1, "z" * 200_000, "x"), *[(5, "same", "hot")] * 100]
    got = check(rows(spark, made))
    assert sum(r[-1] for r in got) == len(made) - 1


def test_one_row_is_its_own_root(spark):
    (row,) = check(rows(spark, [(1, "only", "en")]))
    assert row[1] == row[2] == row[3] == row[5] and row[4] == hashed("")


def test_empty_table(spark):
    assert check(rows(spark, [])) == []
