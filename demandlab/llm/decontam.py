"""Benchmark decontamination with one Aho-Corasick automaton over the benchmark's word windows.

Texts are lower-cased (A-Z) and reduced to words joined by single blanks; every
window of 13 benchmark words becomes a pattern with a blank at either end, so a match
is a match of whole words. A text is scanned once; matches are mapped back to words
and, for reporting, to code points of the original text.

The automaton lives in the tasks. A benchmark is cut into blocks of at most about
``BLOCK_BYTES`` of item text by a hash of the item; each block has its automaton and
its pass, and passes hand on what they have found. An ordinary benchmark is one block.

Defined cases: null and wordless texts have no words, no hits and are not
contaminated; wordless items have no windows; a null item_id is named as the empty
string; repeated items count once; an input column with the name of a result column is
left out; an empty benchmark hits nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from demandlab.llm.common import WORDS, handed_back, settle, steps, table, text_bytes, word_places

WINDOW = 13
# Item text per automaton; its trie has up to WINDOW nodes per byte of this.
BLOCK_BYTES = 256 << 10
SPAN = StructType([StructField("start", LongType()), StructField("end", LongType())])
FOUND = [StructField("n_words", LongType()), StructField("n_hit", LongType()),
         StructField("items", ArrayType(StringType())), StructField("spans", ArrayType(SPAN)),
         StructField("hit_words", ArrayType(SPAN))]
SPANS_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _plain(text: str | None) -> bytes:
    return b" ".join((text or "").encode().translate(WORDS.tobytes()).split())


def build_automaton(items: list[tuple[str, str | None]], window: int = WINDOW):
    """Patterns of all items; a pattern's value is its length in words and its items. None without patterns."""
    patterns: dict[str, tuple[int, set]] = {}
    for item, text in items:
        words = _plain(text).decode("latin-1").split(" ")
        if words == [""]:
            continue
        size = min(window, len(words))
        for at in range(len(words) - size + 1):
            patterns.setdefault(f" {' '.join(words[at:at + size])} ", (size, set()))[1].add(item)
    if not patterns:
        return None
    machine = ahocorasick.Automaton()
    for pattern, (size, owners) in patterns.items():
        machine.add_word(pattern, (len(pattern), size, tuple(owners)))
    machine.make_automaton()
    return machine


def _runs(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def _scan_batch(batch: pa.RecordBatch, machine) -> dict[str, pa.Array]:
    raw, offsets = text_bytes(batch.column("text"))
    clean = WORDS[raw]
    starts, ends, first = word_places(clean, offsets)
    n_words = np.diff(first)
    items = batch.column("items").to_pylist()
    spans = batch.column("spans").to_pylist()
    hit_words = batch.column("hit_words").to_pylist()
    n_hit = [sum(r["end"] - r["start"] for r in x) for x in hit_words]
    for i in np.flatnonzero(n_words) if machine is not None else ():
        low, high = int(offsets[i]), int(offsets[i + 1])
        line = f" {b' '.join(clean[low:high].tobytes().split()).decode('latin-1')} "
        found = list(machine.iter(line))
        if not found:
            continue
        blanks = np.flatnonzero(np.frombuffer(line.encode("latin-1"), dtype=np.uint8) == 32)
        at = np.searchsorted(blanks, [end - length + 1 for end, (length, _, _) in found])
        cover = np.zeros(n_words[i] + 1, dtype=np.int64)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + np.array([size for _, (_, size, _) in found]), -1)
        for r in hit_words[i]:
            cover[r["start"]] += 1
            cover[r["end"]] -= 1
        hit = np.cumsum(cover[:-1]) > 0
        a, b = _runs(hit)
        chars = np.concatenate([[0], np.cumsum((raw[low:high] & 0xC0) != 0x80)])
        mine = slice(int(first[i]), int(first[i + 1]))
        s, e = chars[starts[mine][a] - low], chars[ends[mine][b - 1] - low]
        hit_words[i] = [{"start": int(x), "end": int(y)} for x, y in zip(a, b, strict=True)]
        spans[i] = [{"start": int(x), "end": int(y)} for x, y in zip(s, e, strict=True)]
        items[i] = sorted(set(items[i]).union(*(owners for _, (_, _, owners) in found)))
        n_hit[i] = int(hit.sum())
    return {"n_words": pa.array(n_words, pa.int64()), "n_hit": pa.array(n_hit, pa.int64()),
            "items": pa.array(items, pa.list_(pa.string())), "spans": pa.array(spans, SPANS_ARROW),
            "hit_words": pa.array(hit_words, SPANS_ARROW)}


def _pass(docs: DataFrame, items: list[tuple[str, str | None]], window: int, keep: list[str]) -> DataFrame:
    """One automaton over all rows; ``keep`` names the input columns to hand on."""
    shared = docs.sparkSession.sparkContext.broadcast(items)
    fields = [f for f in docs.schema.fields if f.name in keep] + FOUND

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = build_automaton(shared.value, window)
        for batch in batches:
            for part in steps(batch):
                found = _scan_batch(part, machine)
                yield pa.RecordBatch.from_pydict(
                    {f.name: found.get(f.name, part.column(f.name) if f.name in keep else None) for f in fields})

    return docs.mapInArrow(handed_back(scan), StructType(fields))


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                       block_bytes: int = BLOCK_BYTES, with_text: bool = True) -> DataFrame:
    """``docs`` with n_words, n_hit, items (ids with occurring windows), spans
    (code points of runs of hit words), hit_words (the same in words) and contaminated."""
    names = {f.name for f in FOUND} | {"contaminated"}
    mine = docs.select([c for c in docs.columns if c not in names])
    keep = [c for c in mine.columns if with_text or c != "text"]
    texts = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                             F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = int(total // block_bytes) + 1
    found = mine.select("*", F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"),
                        F.array().cast("array<string>").alias("items"),
                        F.array().cast(ArrayType(SPAN)).alias("spans"),
                        F.array().cast(ArrayType(SPAN)).alias("hit_words"))
    for k in range(n_blocks):
        block = texts.where(F.pmod(F.xxhash64("item"), F.lit(n_blocks)) == k).collect()
        last = k == n_blocks - 1
        found = _pass(found, [(r.item, r.text) for r in block], window, keep if last else mine.columns)
        if not last:
            found = settle(found, "contamination")
    return found.withColumn("contaminated", F.expr("n_hit > 0 AND 20 * n_hit >= n_words"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans (start:end, comma-joined)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"), with_text=False)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), "contaminated")


_WORDS_SQL = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
              r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS_SQL} AS w FROM documents
), b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS_SQL} AS w FROM benchmark
), k AS (
  SELECT item, w, least(len(w), 13) AS n FROM b WHERE len(w) > 0
), win AS (
  SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS p
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM k)
), dw AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS p
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)
), hits AS (
  SELECT r, i, n, item FROM dw JOIN win USING (n, p)
), words AS (
  SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS j FROM hits) GROUP BY r
), items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""
