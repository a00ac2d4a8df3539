"""Approximate nearest neighbours by largest inner product, in a forest of hash prefixes.

Vectors. Equal vectors are one entry with the smallest ids that any query could return, so a vector with very
many copies is no larger than another.

Forest. Entries are dealt to shards of bounded size. Each shard has ``TREES`` trees; a tree is the sorted array
of its entries' hash strings of ``LETTERS`` letters. A letter is the largest of ``ROWS`` random projections with
its sign. Inner products become angles by one more component, which lengthens every vector to the longest of
the shard (a query has 0 there), so queries are hashed once for all shards. Shards are written as one row each.

Search. A query descends every tree by binary search to the longest prefix it shares with an entry, which
differs from tree to tree. From the longest of these the trees ascend together: at each length the entries
that share such a prefix with the query, in any tree, are candidates, until ``share`` of the shard's entries,
and ``least`` at any rate, are found; a query without enough of them reaches the empty prefix, which is the
whole shard. Candidates are cut by single-precision products, with a margin for their error, and the
rest is scored in double precision, from the first component to the last, on the original vectors.

Queries meet all shards, in blocks of about ``BLOCK_BYTES`` that are sent to the tasks one at a time; every shard gives
its best k + 1 rows of a query, which are ranked once more. That is the work of a stated query
set against all rows: queries x shards, a fraction of each shard per query. For vectors without any
structure (the test data) nine tenths of the true neighbours take about a quarter of all entries,
hence the default ``share``; data with clusters stop at longer prefixes with a smaller one.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and rows without
an id, take no part; vectors are compared with those of the same length only; a repeated id is a row of its own;
equal scores are ordered by id; fewer than k candidates are all returned; further columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandlab.llm.common import settle, table

K = 20
TREES, LETTERS, ROWS = 48, 4, 64
SHARE = 0.26
LEAST = 2048
SHARD_BYTES = 8 << 20
BLOCK_BYTES = 16 << 20


@lru_cache(maxsize=64)
def projections(width: int, tree: int) -> np.ndarray:
    """Random directions of a tree's letters for vectors of ``width`` components, the last one being the added one."""
    return np.random.default_rng([width, tree]).standard_normal((width + 1, LETTERS * ROWS), dtype=np.float32)


def hash_strings(vectors: np.ndarray, added: np.ndarray | None, tree: int) -> np.ndarray:
    """Strings of a tree, a byte a letter, as numbers that sort like them."""
    turned = projections(vectors.shape[1], tree)
    out = np.zeros(len(vectors), dtype=np.uint32)
    for low in range(0, len(vectors), 4096):
        part = slice(low, low + 4096)
        made = vectors[part] @ turned[:-1]
        if added is not None:
            made += added[part, None] * turned[-1]
        made = made.reshape(-1, LETTERS, ROWS)
        largest = np.abs(made).argmax(axis=2)
        sign = np.take_along_axis(made, largest[:, :, None], 2)[:, :, 0] > 0
        for letter in (2 * largest + sign).astype(np.uint32).T:
            out[part] = (out[part] << np.uint32(8)) | letter
    return out


def _scaled(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors in units of the longest, in single precision, and the component that lengthens them to it."""
    wide = vectors.astype(np.float64)
    wide /= np.abs(wide).max()
    lengths = np.sqrt((wide * wide).sum(axis=1))
    wide /= lengths.max()
    added = np.sqrt(np.maximum(0.0, 1 - (lengths / lengths.max()) ** 2))
    return wide.astype(np.float32), added.astype(np.float32)


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


SHARDS = "dim int, size int, vectors binary, strings binary, places binary, ids binary, first_id binary, h1 binary, h2 binary"
SHARDS_ARROW = pa.schema([("dim", pa.int32()), ("size", pa.int32()), *((name, pa.binary()) for name in (
    "vectors", "strings", "places", "ids", "first_id", "h1", "h2"))])


def _plant(trees: int):
    def run(rows: pa.Table) -> pa.Table:
        dim, size = rows.column("dim")[0].as_py(), rows.num_rows
        vectors = _matrix(rows.column("vector"), dim)
        scaled, added = _scaled(vectors)
        strings, places = np.empty((trees, size), np.uint32), np.empty((trees, size), np.int32)
        for t in range(trees):
            made = hash_strings(scaled, added, t)
            places[t] = np.argsort(made, kind="stable")
            strings[t] = made[places[t]]
        ids = rows.column("ids").combine_chunks()
        first_id = np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy())]).astype(np.int64)
        return pa.table({
            "dim": [dim], "size": [size], "vectors": [vectors.astype(np.float64).tobytes()], "strings": [strings.tobytes()],
            "places": [places.tobytes()], "ids": [ids.flatten().to_numpy().tobytes()], "first_id": [first_id.tobytes()],
            "h1": [rows.column("h1").to_numpy().tobytes()], "h2": [rows.column("h2").to_numpy().tobytes()]}, SHARDS_ARROW)

    return run


def shared_prefix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of leading letters two strings share."""
    return sum((a >> np.uint32(8 * k) == b >> np.uint32(8 * k)).astype(np.int64) for k in range(LETTERS))


class Forest:
    def __init__(self, vectors: np.ndarray, strings: np.ndarray, places: np.ndarray):
        self.vectors, self.strings, self.places = vectors, strings, places
        self.scaled, _ = _scaled(vectors)

    def descend(self, asked: np.ndarray) -> np.ndarray:
        """Longest prefix that each query (row) shares with an entry of each tree (column)."""
        out = np.zeros(asked.shape, dtype=np.int64)
        for t, held in enumerate(self.strings):
            at = np.searchsorted(held, asked[:, t])
            for near in (np.maximum(at - 1, 0), np.minimum(at, len(held) - 1)):
                out[:, t] = np.maximum(out[:, t], shared_prefix(held[near], asked[:, t]))
        return out

    def candidates(self, asked: np.ndarray, wanted: int) -> Iterator[tuple[int, np.ndarray]]:
        """(query, entries): trees ascend together until ``wanted`` entries share a prefix with the query."""
        size = self.strings.shape[1]
        longest = self.descend(asked).max(axis=1)
        open_ = np.arange(len(asked))
        for length in range(LETTERS, 0, -1):
            ready = open_[longest[open_] >= length]
            shift = np.uint64(8 * (LETTERS - length))
            low = asked[ready].astype(np.uint64) >> shift
            begin, end = np.empty(low.shape, np.int64), np.empty(low.shape, np.int64)
            for t, held in enumerate(self.strings):
                cut = held.astype(np.uint64) >> shift
                begin[:, t] = np.searchsorted(cut, low[:, t], side="left")
                end[:, t] = np.searchsorted(cut, low[:, t], side="right")
            enough = (end - begin).sum(axis=1) >= wanted
            done = []
            for i in np.flatnonzero(enough):
                mark = np.zeros(size, dtype=bool)
                for t in range(len(self.strings)):
                    mark[self.places[t, begin[i, t]:end[i, t]]] = True
                found = np.flatnonzero(mark)
                if len(found) >= wanted:
                    done.append(ready[i])
                    yield int(ready[i]), found
            open_ = np.setdiff1d(open_, done)
        for q in open_:
            yield int(q), np.arange(size)

    def search(self, queries: np.ndarray, asked: np.ndarray, k: int, share: float, least: int) -> tuple[np.ndarray, ...]:
        """(query, entry, score) of at least the k best candidates of each query."""
        wanted = min(len(self.vectors), max(least, int(np.ceil(share * len(self.vectors)))))
        units = (queries / np.linalg.norm(queries, axis=1, keepdims=True)).astype(np.float32)
        margin = 4e-7 * (queries.shape[1] + 8)
        who, which = [], []
        for q, found in self.candidates(asked, wanted):
            near = self.scaled[found] @ units[q]
            if len(found) > k:
                found = found[near >= np.partition(near, len(near) - k)[len(near) - k] - margin]
            who.append(np.full(len(found), q))
            which.append(found)
        who, which = np.concatenate(who), np.concatenate(which)
        score = np.zeros(len(who))
        for c in range(queries.shape[1]):  # component after component, so that a score is the same in every task
            score += queries[who, c] * self.vectors[which, c]
        return who, which, score


FOUND = "h1 long, h2 long, vec_id long, score double, own boolean"
FOUND_ARROW = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()),
                         ("own", pa.bool_())])


def _meet(shared, k: int, share: float, least: int):
    """Best k + 1 rows of every query in every shard; ``own`` marks rows equal to the query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                if row["dim"] not in shared.value:
                    continue
                queries, asked, q1, q2 = shared.value[row["dim"]]
                size = row["size"]
                trees = asked.shape[1]
                forest = Forest(np.frombuffer(row["vectors"], np.float64).reshape(size, -1),
                                np.frombuffer(row["strings"], np.uint32).reshape(trees, size),
                                np.frombuffer(row["places"], np.int32).reshape(trees, size))
                ids, first = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["first_id"], np.int64)
                h1, h2 = np.frombuffer(row["h1"], np.int64), np.frombuffer(row["h2"], np.int64)
                for low in range(0, len(queries), 512):
                    part = slice(low, low + 512)
                    who, which, score = forest.search(queries[part], asked[part], k + 1, share, least)
                    who = who + low
                    times = first[which + 1] - first[which]
                    place = np.repeat(first[which] - np.concatenate([[0], np.cumsum(times)[:-1]]), times) + np.arange(times.sum())
                    who, which, score, found = np.repeat(who, times), np.repeat(which, times), np.repeat(score, times), ids[place]
                    order = np.lexsort((found, -score, who))
                    who = who[order]
                    rank = np.arange(len(who)) - np.searchsorted(who, who)
                    order, who = order[rank <= k], who[rank <= k]
                    which = which[order]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(q1[who]), pa.array(q2[who]), pa.array(found[order]), pa.array(score[order]),
                        pa.array((h1[which] == q1[who]) & (h2[which] == q2[who]))], schema=FOUND_ARROW)

    return run


def usable(vector: Column) -> Column:
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(sound & F.exists(vector, lambda x: x != 0), F.lit(False))


def plant(rows: DataFrame, k: int, shard_bytes: int, trees: int) -> DataFrame:
    """The index, one row per shard: rows of (vec_id, vector, h1, h2, dim)."""
    # Of equal vectors the k + 1 smallest ids can be returned; tasks cut to them before they meet.
    first = Window.partitionBy("h1", "h2", "dim").orderBy("vec_id")
    some = rows.withColumn("place", F.row_number().over(first)).where(F.col("place") <= k + 1)
    classes = settle(some.groupBy("h1", "h2", "dim").agg(
        F.first("vector").alias("vector"), F.sort_array(F.collect_list("vec_id")).alias("ids")), "neighbours-classes")
    sizes = classes.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) * F.col("dim") * 8 / shard_bytes).cast("int").alias("shards"))
    dealt = classes.join(sizes, "dim").withColumn("shard", F.pmod("h1", F.col("shards")))
    return settle(dealt.drop("shards").groupBy("dim", "shard").applyInArrow(_plant(trees), SHARDS), "neighbours-index")


def _hashed_queries(queries: DataFrame, trees: int) -> DataFrame:
    """Queries with their strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                vector = np.array(row["vector"], dtype=np.float64)
                unit = (vector / np.abs(vector).max()).astype(np.float32)[None, :]
                strings = np.concatenate([hash_strings(unit, None, t) for t in range(trees)])
                yield pa.RecordBatch.from_pylist([{"h1": row["h1"], "h2": row["h2"], "dim": row["dim"],
                                                   "vector": vector.tobytes(), "strings": strings.tobytes()}])

    return queries.mapInArrow(run, "h1 long, h2 long, dim long, vector binary, strings binary")


def search(table_: DataFrame, every: int = K, k: int = K, share: float = SHARE, least: int = LEAST,
           shard_bytes: int = SHARD_BYTES, block_bytes: int = BLOCK_BYTES, trees: int = TREES,
           vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for rows whose id ``every`` divides, the k nearest found among the others."""
    rows = table_.select(F.col("vec_id").cast("long"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    # Adding 0.0 folds -0.0 into 0.0: equal vectors have equal hashes.
    rows = rows.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))
    rows = settle(rows.select("vec_id", "vector", F.xxhash64("vector").alias("h1"),
                              F.xxhash64(F.lit(1), F.reverse("vector")).alias("h2"), F.size("vector").alias("dim")),
                  "neighbours-rows")
    index = plant(rows, k, shard_bytes, trees)
    mine = rows.where(F.col("vec_id") % every == 0)
    asked = settle(_hashed_queries(mine.groupBy("h1", "h2", "dim").agg(F.first("vector").alias("vector")), trees),
                   "neighbours-queries")
    size = asked.agg(F.sum(F.octet_length("vector") + F.octet_length("strings"))).first()[0] or 0
    blocks = size // block_bytes + 1
    found = None
    for block in range(blocks):
        held: dict[int, tuple] = {}
        got = asked.where(F.pmod("h2", F.lit(blocks)) == block).toArrow()
        for dim in sorted(set(got.column("dim").to_pylist())):
            some = got.filter(pc.equal(got.column("dim"), dim))
            held[dim] = (np.frombuffer(b"".join(some.column("vector").to_pylist()), np.float64).reshape(-1, dim),
                         np.frombuffer(b"".join(some.column("strings").to_pylist()), np.uint32).reshape(-1, trees),
                         some.column("h1").to_numpy(), some.column("h2").to_numpy())
        shared = table_.sparkSession.sparkContext.broadcast(held)
        one = settle(index.mapInArrow(_meet(shared, k, share, max(least, 4 * k)), FOUND), "neighbours-found")
        shared.destroy()
        found = one if found is None else found.unionByName(one)
    best = Window.partitionBy("h1", "h2").orderBy(F.desc("score"), "vec_id")
    lists = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1).groupBy("h1", "h2").agg(
        F.sort_array(F.collect_list(F.struct("place", "vec_id", "score", "own"))).alias("best"))
    # A vector that is a query very many times meets its one list in a join of two plain tables, which can be split.
    lists = settle(lists, "neighbours-lists")
    met = mine.select("vec_id", "h1", "h2").join(lists, ["h1", "h2"])
    itself = F.array_position(F.transform("best", lambda b: b["own"] & (b["vec_id"] == F.col("vec_id"))), True)
    others = F.slice(F.filter("best", lambda b: b["place"] != itself), 1, k)
    return met.select(F.col("vec_id").alias("query_id"), F.posexplode(others).alias("at", "near")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("near.vec_id").alias("vec_id"),
        F.col("near.score").alias("score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: query_id, rank, vec_id, score."""
    return search(table(spark, sf_dir, "embeddings"))
