"""Helpers of the text operators: intermediate tables, word hashes and connected groups."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlab.session import scratch_path

# Bytes of text that one numpy step handles; a single longer text is one step of its own.
STEP_BYTES = 8 << 20
# Bytes of a step that are summed at once for word hashes; it takes about 50 times this, and its tables of powers stay.
PIECE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it again: the lineage ends there."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc_remainder(key: Column, divisor: int) -> Column:
    """crc32 of the key as text, modulo ``divisor``; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % divisor


def bounded_sample(df: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` rows with their hash ``h``: the first in the order of a hash of the row, so repeatable.

    Rows are counted first and all but a little more than ``rows`` are left out by their
    hash alone, so that tasks together send that many to the final cut, however many tasks there are.
    """
    hashed = df.withColumn("h", F.xxhash64(*df.columns))
    share = 1.25 * rows / max(df.count(), 1)
    if share < 1:
        hashed = hashed.where(F.col("h") <= int((2 * share - 1) * (1 << 63)))
    return hashed.orderBy("h").limit(rows)


def lowered(keep) -> np.ndarray:
    """Byte table: A-Z become a-z, bytes that ``keep`` refuses become a blank."""
    made = np.arange(256, dtype=np.uint8)
    made[65:91] += 32
    for byte in range(256):
        if not keep(byte):
            made[byte] = 32
    return made


# Words of letters and digits; every byte of a character beyond ASCII belongs to a word.
WORDS = lowered(lambda b: 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)
# Words between blanks.
BLANKS = lowered(lambda b: b != 32 and not 9 <= b <= 13)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and where each row begins in them; null is empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if column.buffers()[2] is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def steps(batch: pa.RecordBatch, column: str = "text", limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts a batch where its texts exceed ``limit`` bytes."""
    if not batch.num_rows:
        return
    _, offsets = text_bytes(batch.column(column))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def give_back() -> None:
    """Returns freed memory to the system: Python workers live on between tasks and would keep it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def handed_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for mapInArrow; freed memory is returned after its last batch."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return whole


def mix(h: np.ndarray) -> np.ndarray:
    """Finisher that spreads every input bit over 64 output bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)
BYTE_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_powers = {"up": np.ones(1, dtype=np.uint64), "down": np.ones(1, dtype=np.uint64)}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    known = _powers
    if len(known["up"]) < n:
        known = {}
        for name, base in (("up", BASE), ("down", BASE_INVERSE)):
            steps_ = np.full(n, base, dtype=np.uint64)
            steps_[0] = 1
            known[name] = np.multiply.accumulate(steps_)
        if n <= PIECE_BYTES:  # those of a longer word are not kept
            _powers.update(known)
    return known["up"][:n], known["down"][:n]


def word_places(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each word in cleaned bytes, and the first word of each row."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = data != 32
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < n]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(column: pa.Array, cleaning: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word of every row, and the first word of each row.

    A word's hash is a polynomial over its bytes, taken from a running sum over
    pieces of the step, so the work is a few numpy passes whatever the words are.
    """
    raw, offsets = text_bytes(column)
    data = cleaning[raw]
    starts, ends, first = word_places(data, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), first
    out = np.empty(len(starts), dtype=np.uint64)
    at, limit = 0, min(STEP_BYTES, PIECE_BYTES)
    while at < len(starts):  # in pieces, so that the running sum stays small
        low = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, low + limit, side="right")))
        high = int(ends[to - 1])
        up, down = _power_tables(high - low)
        total = np.zeros(high - low + 1, dtype=np.uint64)
        np.cumsum(BYTE_VALUES[data[low:high]] * up, out=total[1:])
        s, e = starts[at:to] - low, ends[at:to] - low
        out[at:to] = mix((total[e] - total[s]) * down[s])
        at = to
    return out, first


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of runs of ``size`` words; fewer words, but some, are one run."""
    if not len(words):
        return np.zeros(0, np.uint64)
    size = min(size, len(words))
    n = len(words) - size + 1
    out = np.full(n, size, dtype=np.uint64)
    for k in range(size):
        out = out * np.uint64(BASE) + words[k:k + n]
    return mix(out)


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) of every node in ``edges`` (a, b); the root is the group's smallest node.

    Alternates the two star steps of the known large-star / small-star method: each
    links a node's neighbours to its smallest neighbour. Only minima per node are
    aggregated, so a node with very many edges is combined before the shuffle, and
    edges meet minima in joins of two plain tables, which Spark splits where they are
    skewed; for that the minima are written first. Every round is written to the
    shared folder. Self-edges name single nodes.
    """
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    links = settle(edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
                   .distinct(), label)
    while True:
        both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(links.select("lo", "hi"))
        least = settle(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")),
                       f"{label}-least")
        large = (both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
                 .where("hi <> lo").distinct())
        down = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(down, "hi").select(F.explode(F.array("lo", "hi")).alias("hi"), F.col("m").alias("lo"))
                 .where("hi <> lo").distinct())
        after = settle(small, label)
        # Done when no low end is itself a high end and every high end has one low end.
        tops = after.groupBy("hi").agg(F.count(F.lit(1)).alias("n"))
        several = tops.where("n > 1").limit(1).count()
        chained = 0 if several else after.join(tops.select(F.col("hi").alias("lo")), "lo", "left_semi").limit(1).count()
        links = after
        if not several and not chained:
            break
    return nodes.join(links.withColumnRenamed("hi", "node"), "node", "left").select(
        "node", F.coalesce("lo", "node").alias("root"))


def token() -> str:
    return uuid.uuid4().hex
