"""N-gram Jaccard join: which texts share at least 0.8 of their five-word runs.

1. Texts with the same words (A-Z lowered, anything that is no letter or digit is a
   blank) are one class; later steps handle a class once.
2. Each class gets MinHash values over its five-word runs. Values in bands of four
   choose candidates: classes that agree in a band. Bands link every class to the
   smallest one of a bucket, never to all others, and the linked classes form
   candidate groups.
3. Within a candidate group every pair is compared: MinHash values in steps of 16, a
   pair is dropped as soon as the posterior probability (uniform prior on the
   similarity, binomial agreement) of reaching the threshold falls below the
   tolerance, and what is left is decided by exact set intersection.

Groups larger than ``BLOCK`` classes or ``BLOCK_BYTES`` of text are cut into blocks and each pair of
blocks is a task of its own, so a task holds about two blocks whatever the group's size; inside it pairs
are compared ``CHUNK`` by ``CHUNK``. A group of b blocks ships each text b times and compares all its pairs.
Tasks return sums per class, not pairs, so results stay in proportion to the documents.

With 24 bands of 4 a pair at exactly 0.8 shares no band with probability 3e-6, and even
then is found if both are linked through others. A class is known by 64 bits of a hash
of its words.

Defined cases: null text is empty; texts without words are one class per exact
text; fewer than five words are one run of all of them; null or repeated doc_id
rows stay rows of their own, however many share an id: a class has its text from rows that agree in
id and text hash, and takes it once; input columns beyond doc_id and text are not looked at, whatever
their names; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlab.llm.common import (
    PIECE_BYTES,
    WORDS,
    components,
    give_back,
    handed_back,
    settle,
    shingle_hashes,
    steps,
    table,
    text_bytes,
    token,
    word_hashes,
)

RUN = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 4
HASHES = BANDS * ROWS
STEP = 16
TOLERANCE = 1e-9
BLOCK = 1024
BLOCK_BYTES = 4 << 20
CHUNK = 256

_rng = np.random.default_rng(5)
MULTIPLIERS = _rng.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADDENDS = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def _keys_and_runs(column: pa.Array) -> tuple[list[int], list[np.ndarray]]:
    words, first = word_hashes(column, WORDS)
    raw, offsets = text_bytes(column)
    keys, runs = [], []
    for i in range(len(column)):
        mine = words[first[i]:first[i + 1]]
        seen = mine.tobytes() if len(mine) else b"-" + raw[offsets[i]:offsets[i + 1]].tobytes()
        keys.append(int.from_bytes(hashlib.md5(seen).digest()[:8], "little", signed=True))
        runs.append(shingle_hashes(mine, RUN))
    return keys, runs


def min_hashes(runs: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    """The k-th MinHash of each non-empty slice of ``runs``."""
    return np.minimum.reduceat((runs * MULTIPLIERS[k] + ADDENDS[k]) >> np.uint64(32), first)


SIGNED = "doc_id long, text_hash long, size long, key long, bands array<long>"
SIGNED_ARROW = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("size", pa.int64()), ("key", pa.int64()),
                          ("bands", pa.list_(pa.int64()))])


def sign(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, key (class of equal words) and a hash per band of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, limit=2 << 20):
                keys, runs = _keys_and_runs(part.column("text"))
                sizes = np.array([len(r) for r in runs])
                bands = [[] for _ in keys]
                full = np.flatnonzero(sizes)
                if len(full):
                    joined = np.concatenate([runs[i] for i in full])
                    first = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
                    made = np.empty((len(full), BANDS), dtype=np.uint64)
                    for band in range(BANDS):
                        h = np.full(len(full), band + 1, dtype=np.uint64)
                        for k in range(band * ROWS, (band + 1) * ROWS):
                            h = (h ^ min_hashes(joined, first, k)) * np.uint64(0x9E3779B97F4A7C15)
                            h ^= h >> np.uint64(29)
                        made[:, band] = h
                    for i, row in zip(full, made.view(np.int64).tolist(), strict=True):
                        bands[i] = row
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": part.column("doc_id"), "text_hash": part.column("text_hash"),
                     "size": part.column("size"), "key": keys, "bands": bands}, schema=SIGNED_ARROW)

    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long"), text.alias("text"), text_hash(),
                       F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("size")).mapInArrow(handed_back(run), SIGNED)


def text_hash() -> Column:
    """With doc_id it tells rows apart whose ids repeat; null is empty text."""
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text_hash")


@lru_cache(maxsize=8)
def fewest_matches(threshold: float, tolerance: float) -> tuple[int, ...]:
    """For n values compared: the fewest agreements with which a pair is still kept.

    With a uniform prior the posterior of "similarity >= t" after m of n agreements is
    the chance that a binomial(n + 1, t) is at most m.
    """
    kept = [0]
    for n in range(1, HASHES + 1):
        total, m = 0.0, -1
        while total < tolerance and m < n:
            m += 1
            total += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        kept.append(m)
    return tuple(kept)


def _intersections(runs: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the listed pairs of sets."""
    if len(a) <= 64:
        return np.array([len(np.intersect1d(runs[i], runs[j], assume_unique=True)) for i, j in zip(a, b, strict=True)],
                        dtype=np.int64)
    joined = np.concatenate(runs)
    owner = np.repeat(np.arange(len(runs)), [len(r) for r in runs])
    _, column, count = np.unique(joined, return_inverse=True, return_counts=True)
    rank = np.cumsum(count > 1) - 1
    shared = count[column] > 1
    column, owner = rank[column[shared]], owner[shared]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    total = np.zeros((len(runs), len(runs)), dtype=np.float32)
    wide = 4096
    for low in range(0, int(rank[-1]) + 1, wide):
        lo, hi = np.searchsorted(column, [low, low + wide])
        held = np.zeros((len(runs), wide), dtype=np.float32)
        held[owner[lo:hi], column[lo:hi] - low] = 1
        total += held @ held.T
    return np.rint(total[a, b]).astype(np.int64)


def signatures(runs: list[np.ndarray]) -> np.ndarray:
    """All MinHash values of each set, a row per set."""
    joined = np.concatenate(runs)
    first = np.concatenate([[0], np.cumsum([len(r) for r in runs])[:-1]])
    return np.stack([min_hashes(joined, first, k) for k in range(HASHES)], axis=1).astype(np.uint32)


def compare(runs: list[np.ndarray], a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD,
            tolerance: float = TOLERANCE, signed: np.ndarray | None = None) -> np.ndarray:
    """Which pairs (a[i], b[i]) of sets reach the threshold: Bayesian pruning, then exact."""
    signed = signatures(runs) if signed is None else signed
    sizes = np.array([len(r) for r in runs])
    least = fewest_matches(threshold, tolerance)
    alive, matches = np.arange(len(a)), np.zeros(len(a), dtype=np.int64)
    for low in range(0, HASHES, STEP):
        if not len(alive):
            break
        values = signed[:, low:low + STEP]
        matches = matches + (values[a[alive]] == values[b[alive]]).sum(axis=1)
        kept = matches >= least[low + STEP]
        alive, matches = alive[kept], matches[kept]
    linked = np.zeros(len(a), dtype=bool)
    if len(alive):
        i, j = a[alive], b[alive]
        both = _intersections(runs, i, j)
        linked[alive] = both + 1e-9 >= threshold * (sizes[i] + sizes[j] - both)
    return linked


VERIFIED = "key long, links long, low long"
VERIFIED_ARROW = pa.schema([("key", pa.int64()), ("links", pa.int64()), ("low", pa.int64())])


def _group_roots(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member that each member is connected to, by what ``root`` knows and the links (a, b)."""
    mine = np.arange(len(root))
    a, b = np.concatenate([a, mine]), np.concatenate([b, root])
    while True:
        before = root.copy()
        np.minimum.at(root, a, root[b])
        np.minimum.at(root, b, root[a])
        root = root[root]
        if (root == before).all():
            return root


def _chunks(left: np.ndarray, right: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """All pairs of two lists, or within one, in pieces: (rows, a, b) with a and b places in rows."""
    for i in range(0, len(left), CHUNK):
        some = left[i:i + CHUNK]
        if right is None:
            yield some, *np.triu_indices(len(some), 1)
        others = left[i + CHUNK:] if right is None else right
        for j in range(0, len(others), CHUNK):
            more = others[j:j + CHUNK]
            a, b = np.meshgrid(np.arange(len(some)), np.arange(len(more)))
            yield np.concatenate([some, more]), a.ravel(), b.ravel() + len(some)


def _verify(threshold: float, tolerance: float):
    def compared(task: pa.Table) -> pa.Table:
        wanted = task.column("key").to_pylist()
        found, runs = _keys_and_runs(task.column("text").combine_chunks())
        # Sorted, so that a group's result does not depend on the order in which its rows arrive.
        rows = sorted((i for i, key in enumerate(wanted) if found[i] == key and len(runs[i])), key=wanted.__getitem__)
        if not rows:
            return VERIFIED_ARROW.empty_table()
        keys = np.array([wanted[i] for i in rows])
        copies = np.array(task.column("n_copies").to_pylist())[rows]
        side = np.array(task.column("side").to_pylist())[rows]
        sets = [np.unique(runs[i]) for i in rows]
        signed = signatures(sets)
        low, high = task.column("lo")[0].as_py(), task.column("hi")[0].as_py()
        left, right = np.flatnonzero(side == low), np.flatnonzero(side == high) if low != high else None
        links, root = np.zeros(len(rows), dtype=np.int64), np.arange(len(rows))
        for place, a, b in _chunks(left, right):
            linked = compare([sets[i] for i in place], a, b, threshold, tolerance, signed[place])
            a, b = place[a[linked]], place[b[linked]]
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            root = _group_roots(root, a, b)
        return pa.table({"key": keys, "links": links, "low": keys[root]}, schema=VERIFIED_ARROW)

    def run(task: pa.Table) -> pa.Table:
        made = compared(task)
        if task.nbytes > PIECE_BYTES:
            give_back()
        return made

    return run


def join_near_copies(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE,
                     block: int = BLOCK, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row per document: doc_id, class_id (smallest doc_id with the same words), n_copies
    (documents of the class), n_links (other documents that reach the threshold, copies
    included) and group_id (smallest doc_id that links lead to); text_hash and group_key (the
    group without regard to ids) serve callers that keep some rows of ``docs``."""
    signed = settle(sign(docs), "jaccard-signed")
    lowest = -(1 << 63)
    classes = settle(signed.groupBy("key").agg(
        F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("n_copies"),
        F.max("size").alias("size"), F.max(F.struct(F.coalesce("doc_id", F.lit(lowest)).alias("fetch_id"), "text_hash"))
        .alias("fetch")).select("key", "class_id", "n_copies", "size", "fetch.*"), "jaccard-classes")

    buckets = signed.select("key", F.explode("bands").alias("bucket"))
    # Tables of one row per bucket, group or root are written before rows meet them: a join of two plain
    # tables is one that Spark can split where a bucket or a group is large.
    shared = settle(buckets.groupBy("bucket").agg(F.min("key").alias("a"), F.max("key").alias("most"))
                    .where("a <> most").select("bucket", "a"), "jaccard-buckets")
    edges = (buckets.join(shared, "bucket").where("key <> a")
             .select("a", F.col("key").alias("b")).distinct())
    groups = settle(components(edges, "jaccard-candidates"), "jaccard-groups")

    placed = settle(groups.withColumnRenamed("node", "key").join(classes, "key"), "jaccard-placed")
    parts = F.greatest(F.count(F.lit(1)) / block, F.sum("size") / block_bytes)
    sizes = settle(placed.groupBy("root").agg(F.ceil(parts).cast("int").alias("blocks")), "jaccard-sizes")
    members = placed.join(sizes, "root").select(
        "key", "n_copies", "root", "blocks", "fetch_id", "text_hash",
        F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int").alias("side"))
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(lowest)).alias("fetch_id"), text_hash(),
                        F.col("text").cast("string").alias("text"))
    # Rows that repeat both id and text give the class its text as often as they occur; one is kept, before
    # they are shuffled again.
    held = members.join(texts, ["fetch_id", "text_hash"]).groupBy("key").agg(
        *(F.first(c).alias(c) for c in ("n_copies", "side", "root", "blocks", "text")))
    tasks = (held.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
             .select("key", "n_copies", "side", "text", "root", F.least("side", "other").alias("lo"),
                     F.greatest("side", "other").alias("hi")))
    verified = settle(tasks.groupBy("root", "lo", "hi").applyInArrow(_verify(threshold, tolerance), VERIFIED),
                      "jaccard-verified")
    roots = components(verified.select(F.col("key").alias("a"), F.col("low").alias("b")).distinct(), "jaccard-links")
    linked = (verified.groupBy("key").agg(F.sum("links").alias("links"))
              .join(roots.withColumnRenamed("node", "key"), "key", "left"))
    info = settle(classes.join(linked, "key", "left").withColumn("root", F.coalesce("root", "key")), "jaccard-info")
    named = settle(info.groupBy("root").agg(F.min("class_id").alias("group_id")), "jaccard-named")
    info = info.join(named, "root").select(
        "key", "class_id", "n_copies", (F.coalesce("links", F.lit(0)) + F.col("n_copies") - 1).alias("n_links"),
        "group_id", F.col("root").alias("group_key"))
    return signed.select("doc_id", "text_hash", "key").join(info, "key").drop("key")


def keep_one_per_group(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without near copies, with their own columns: of each group the row with the smallest
    doc_id, null last; of rows that agree in doc_id and text, any one."""
    id_, hash_ = f"id_{token()}", f"hash_{token()}"
    found = join_near_copies(docs, **options)
    last = F.lit((1 << 63) - 1)
    kept = found.groupBy("group_key").agg(F.min(F.struct(
        F.coalesce("doc_id", last).alias(id_), F.col("text_hash").alias(hash_))).alias("first"))
    mine = docs.withColumns({id_: F.coalesce(F.col("doc_id").cast("long"), last), hash_: text_hash()})
    return mine.join(kept.select("first.*"), [id_, hash_], "left_semi").dropDuplicates([id_, hash_]).drop(id_, hash_)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: a row per document with its class, its number of links and its group."""
    found = join_near_copies(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "class_id", "n_copies", "n_links", "group_id")
