"""Merkle dataset manifest: one root for a table, and for each row a proof that it belongs to it.

Leaves. A row's leaf is the digest of its columns, each written as byte count, colon and value, so
that no two rows share a text by chance. Leaves of a group (``lang``) ascend by ``doc_id``. Their
positions come from a range partitioning, whose partitions are counted, so no group is ordered in
one task.

Levels. While a group has several nodes, every eight consecutive ones become the digest of their
digests. A window over each run takes the seven nodes before and after every node with lag and lead
at fixed offsets; what lies outside the run is masked by the node's slot and the run's length. A run's first
row hashes the whole run into the parent. The groups' last nodes are the leaves of a second tree of
the same kind, whose last node is the root.

Proofs. Levels are joined from the root downwards, each with the one above, on (group, run): a level is an
eighth of the one below and a parent meets eight children at most, however large a group is. Levels
above the leaves are written to the shared folder; the text stays in the tasks that read it.

Defined cases: a null column is ``-``, so null and empty text differ; null groups and null ids are first;
rows that share a doc_id are ordered by leaf, equal rows have a slot each; a null doc_id is never
tampered with; further columns of the input are ignored; texts are hashed whole, whatever their
length; a table of one row has its leaf as root and an empty proof; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandlab.llm.common import settle, table

FANOUT = 8
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_STEPS = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    """Lower-case hex sha256 of the parts written one after another."""
    return F.sha2(F.concat(*parts) if len(parts) > 1 else parts[0], 256)


def leaf(*values: Column) -> Column:
    def written(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return digest(*[written(v) for v in values])


def group_key(value: Column) -> Column:
    """A key that is never null; null comes first, the others bytewise."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


def numbered(rows: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """Adds ``pos``, the row's place in its ``key`` from 0, and ``n``, the key's number of rows.

    Rows that are equal in ``order`` are told apart by ``tie``, so a value with very many rows is cut into
    several ranges like any other.
    """
    sort = ["key", *order, "tie"]
    told = settle(rows.withColumn("tie", F.monotonically_increasing_id()), f"{label}-rows")
    dealt = settle(told.repartitionByRange(*sort).sortWithinPartitions(*sort).drop("tie").withColumns(
        {"part": F.spark_partition_id(), "row": F.monotonically_increasing_id()}), f"{label}-ranges")
    # One row per key and range it reaches into.
    pieces = dealt.groupBy("key", "part").agg(F.min("row").alias("low"), F.count(F.lit(1)).alias("size"))
    whole = Window.partitionBy("key")
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = settle(pieces.select("key", "part", "low", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("skip"),
                                  F.sum("size").over(whole).alias("n")), f"{label}-pieces")
    return dealt.join(pieces, ["key", "part"]).withColumn("pos", F.col("skip") + F.col("row") - F.col("low")).drop(
        "part", "row", "low", "skip")


def with_siblings(nodes: DataFrame) -> DataFrame:
    """Adds run, slot, and the digests before and after each node in its run."""
    placed = nodes.withColumns({"run": F.expr(f"pos div {FANOUT}"), "slot": F.col("pos") % FANOUT})
    length = F.least(F.lit(FANOUT), F.col("n") - F.col("run") * FANOUT)
    run = Window.partitionBy("key", "run").orderBy("pos")
    before = [F.when(F.col("slot") >= k, F.lag("hash", k).over(run)).otherwise("") for k in range(FANOUT - 1, 0, -1)]
    after = [F.when(F.col("slot") + k < length, F.lead("hash", k).over(run)).otherwise("") for k in range(1, FANOUT)]
    return placed.withColumns({"before": F.concat(*before), "after": F.concat(*after)})


def parents(nodes: DataFrame) -> DataFrame:
    """The level above: first rows hash their runs."""
    return with_siblings(nodes.where("n > 1").select("key", "pos", "n", "hash")).where("slot = 0").select(
        "key", F.col("run").alias("pos"), F.expr(f"(n + {FANOUT - 1}) div {FANOUT}").alias("n"),
        digest(F.col("hash"), F.col("after")).alias("hash"))


def grow(leaves: DataFrame, label: str) -> tuple[list[DataFrame], DataFrame]:
    """All levels, from the leaves (key, pos, n, hash) up, and the last node of each key."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    levels = [leaves]
    while most > 1:
        levels.append(settle(parents(levels[-1]), f"{label}-level"))
        most = -(-most // FANOUT)
    tops = reduce(DataFrame.unionByName, [nodes.where("n = 1").select("key", "hash") for nodes in levels])
    return levels, settle(tops, f"{label}-tops")


def descend(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The leaves with subroot and ``path``, the steps (before, after) from the leaf up to the root.

    ``tops`` has a row per key: key, subroot and the path of its last node.
    """
    above = None
    for nodes in reversed(levels):
        here = nodes.where("n = 1").join(tops, "key")
        if above is not None:
            inner = with_siblings(nodes.where("n > 1")).join(above, ["key", "run"])
            step = F.array(F.struct("before", "after"))
            inner = inner.withColumn("path", F.concat(step, F.col("path"))).drop("run", "slot", "before", "after")
            here = here.unionByName(inner)
        above = here.select("key", F.col("pos").alias("run"), "subroot", "path")
        leaves = here
    return leaves


def manifest(leaves: DataFrame, order: Sequence[str]) -> tuple[DataFrame, str | None]:
    """Rows of ``leaves`` (key, hash and any more columns) with subroot and path, and the root.

    Leaves of a key are ordered by ``order``, then by ``hash``.
    """
    levels, tops = grow(numbered(leaves, [*order, "hash"], "merkle"), "merkle")
    heads = tops.select(F.lit("").alias("key"), F.col("key").alias("group"), "hash")
    head_levels, last = grow(numbered(heads, ["group"], "merkle-heads"), "merkle-heads")
    root = last.first()
    ends = last.select("key", F.col("hash").alias("subroot"), F.array().cast(NO_STEPS).alias("path"))
    tops = descend(head_levels, ends).select(F.col("group").alias("key"), F.col("hash").alias("subroot"), "path")
    return descend(levels, settle(tops, "merkle-heads-paths")), root["hash"] if root else None


def proof(path: Column) -> Column:
    """Digest of all siblings, level by level from the leaf up."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""))


def folded(value: Column, path: Column) -> Column:
    """The root that follows from a leaf and its siblings."""
    return F.aggregate(path, value, lambda h, s: digest(s["before"], h, s["after"]))


def prove(docs: DataFrame, columns: Sequence[str] = COLUMNS, group: str = "lang", order: str = "doc_id",
          tampered: dict[str, Column] | None = None) -> DataFrame:
    """A row per row of ``docs``: the order column, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``tampered`` names columns whose value has changed since the manifest was made, and the value found now:
    folded_root follows from the row as found and the siblings of the manifest.
    """
    found = [(tampered or {}).get(c, F.col(c)) for c in columns]
    leaves = docs.select(F.col(order).alias("place"), group_key(F.col(group)).alias("key"),
                         leaf(*[F.col(c) for c in columns]).alias("hash"), leaf(*found).alias("found"))
    rows, root = manifest(leaves, ["place"])
    again = folded(F.col("found"), F.col("path"))
    return rows.select(F.col("place").alias(order), F.col("hash").alias("leaf"), "subroot",
                       F.lit(root).cast("string").alias("root"), proof(F.col("path")).alias("proof_sha256"),
                       again.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    chosen = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    lowered = F.when(chosen, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
    return prove(table(spark, sf_dir, "documents"), tampered={"text": lowered})


def _written(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR)::VARCHAR || ':' || {column}::VARCHAR, '-')"


_LEAF = "sha256(" + " || ".join(_written(c) for c in COLUMNS) + ")"
_CHANGED = "sha256(" + " || ".join(_written(c) for c in COLUMNS[:-1]) + " || " + \
    _written(f"translate(text, '{UPPER}', '{LOWER}')") + ")"
# crc32 by its bits: a character is exclusive-ored in, then eight shifts (-1) follow.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
    lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda c, e: CASE WHEN e >= 0 THEN xor(c, e)
    ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295::BIGINT)"""


def _tree_sql(name: str, source: str) -> str:
    """Nodes of all levels, and their runs."""
    return f"""{name} AS (
  SELECT 0 AS level, k, pos, h, n FROM {source}
  UNION ALL
  SELECT level + 1, k, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (max(n) + 7) // 8 FROM {name} WHERE n > 1
  GROUP BY level, k, pos // 8
), {name}_runs AS (
  SELECT level, k, pos // 8 AS run, list(h ORDER BY pos) AS hs FROM {name} WHERE n > 1 GROUP BY ALL
)"""


def _fold_sql(name: str, start: str, runs: str) -> str:
    left, right = "array_to_string(r.hs[1:f.pos % 8], '')", "array_to_string(r.hs[f.pos % 8 + 2:], '')"
    return f"""{name} AS (
  {start}
  UNION ALL
  SELECT f.rid, f.level + 1, f.k, f.pos // 8, sha256({left} || f.h || {right}), f.proof || {left} || {right}
  FROM {name} f JOIN {runs} r ON r.level = f.level AND r.k = f.k AND r.run = f.pos // 8
)"""


SQL = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || lang, '') AS k, {_LEAF} AS leaf,
    CASE WHEN {_CRC} % 3 = 0 THEN {_CHANGED} ELSE {_LEAF} END AS changed FROM documents
), p AS (
  SELECT rid, doc_id, k, leaf AS h, changed, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY k) AS n FROM d
), {_tree_sql('nodes', 'p')}, s AS (
  SELECT '' AS k, k AS of_key, h, row_number() OVER (ORDER BY k) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1
), {_tree_sql('heads', 's')},
{_fold_sql('low', "SELECT rid, 0 AS level, k, pos, changed AS h, '' AS proof FROM p", 'nodes_runs')},
low_end AS (SELECT rid, arg_max(h, level) AS h, arg_max(proof, level) AS proof FROM low GROUP BY rid),
{_fold_sql('high', '''SELECT e.rid, 0 AS level, s.k, s.pos, e.h, e.proof
  FROM low_end e JOIN p USING (rid) JOIN s ON s.of_key = p.k''', 'heads_runs')},
high_end AS (SELECT rid, arg_max(h, level) AS h, arg_max(proof, level) AS proof FROM high GROUP BY rid)
SELECT p.doc_id, p.h AS leaf, s.h AS subroot, root.h AS root, sha256(e.proof) AS proof_sha256, e.h AS folded_root,
  e.h = root.h AS verified
FROM p JOIN s ON s.of_key = p.k JOIN high_end e USING (rid) CROSS JOIN (SELECT h FROM heads WHERE n = 1) root
"""
