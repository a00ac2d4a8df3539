"""Ranked lexical search with the Best Position Algorithm.

Impacts. A word's impact in a document is ``w * ((10^9 tf) div (1000 tf + 12 m))``: ``w`` grows with
the word's rarity, ``m`` with the document's length; a document's score for an item is the sum over the
item's words, repeats included. Counts of documents and words are taken over the whole corpus first.

Index. One pass over the texts keeps, of every document, its length and the counts of the words that
any item asks for. Documents are dealt to shards of a bounded number of such counts; a
shard has an impact list per word, highest first, and finds a document's place in each list (direct access).

Search. An item reads its lists in parallel, in steps that double. Each document met for the first time is
looked up in all lists, which gives its score and marks its positions as seen. A list's best position is the
last one before the first position not seen; the threshold is the sum of the impacts there, which no
document not yet met can exceed. Because direct accesses mark positions far below the last one read, it falls
faster than one taken from the positions last read. The search stops when the threshold is strictly
below the k-th score, so documents with equal scores are all met.

A first eighth of the shards gives each item a k-th score; in the other shards a threshold strictly
below it ends the search as well, and documents below it are not returned: they cannot be among
the k. The rows of all shards are then ranked once more.

Bounds: a shard holds ``SHARD_COUNTS`` counts (and one document's more); items are searched in blocks of about
``BLOCK_BYTES`` of their text, and what is broadcast is the words of a block.

Defined cases: null or empty text has no words; documents and items without words give no rows;
a null doc_id ranks last among equal scores; repeated documents are ranked each, repeated items
(or ids) have a ranking each; fewer than k documents with a score above 0 are all returned;
further columns are ignored; words are known by 64-bit hashes; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandlab.llm.common import WORDS, settle, steps, table, word_hashes

K = 20
SHARD_COUNTS = 1_000_000
BLOCK_BYTES = 4 << 20
FIRST_STEP = 16
LATE = (1 << 63) - 1

COUNTED = "doc_id long, n long, terms array<int>, counts array<int>"
COUNTED_ARROW = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())),
                           ("counts", pa.list_(pa.int32()))])


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def count_words(docs: DataFrame, words: np.ndarray) -> DataFrame:
    """Of each document its id, its number of words, and how often it has each of ``words`` (sorted hashes)."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for part in steps(batch, limit=4 << 20):
                found, first = word_hashes(part.column("text"), WORDS)
                place = np.minimum(np.searchsorted(known, found), len(known) - 1)
                hit = known[place] == found
                owner = np.repeat(np.arange(part.num_rows), np.diff(first))[hit]
                pairs, counts = np.unique(owner * len(known) + place[hit], return_counts=True)
                sizes = np.bincount(pairs // len(known), minlength=part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(first), pa.int64()),
                     _lists(pairs % len(known), sizes), _lists(counts, sizes)], schema=COUNTED_ARROW)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, COUNTED)


def document_counts(counted: DataFrame, size: int) -> np.ndarray:
    """Number of documents that have each word; tasks count first, so a row per word and task meets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            total += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"term": some.astype(np.int32), "df": total[some]})

    rows = counted.select("terms").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
    out = np.zeros(size, dtype=np.int64)
    for r in rows.collect():  # at most one row per word of a block of items
        out[r["term"]] = r["df"]
    return out


def _spread(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All numbers of the ranges low[i] .. high[i] - 1."""
    sizes = high - low
    return np.repeat(low - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())


class Shard:
    """Impact lists of some documents: ``places`` reads them in order, ``of_document`` directly."""

    def __init__(self, n: np.ndarray, sizes: np.ndarray, terms: np.ndarray, counts: np.ndarray, size: int,
                 documents: int, words: int):
        self.term, tf = terms.astype(np.int64), counts.astype(np.int64)
        self.owner = np.repeat(np.arange(len(n)), sizes)
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        m = 75 + 25 * n * documents // max(words, 1)
        self.impact = 1_000_000_000 * tf // (1000 * tf + 12 * m[self.owner])
        self.places = np.lexsort((-self.impact, self.term))
        self.place_of = np.empty(len(self.places), dtype=np.int64)
        self.place_of[self.places] = np.arange(len(self.places))
        self.start = np.searchsorted(self.term[self.places], np.arange(size + 1))

    def of_document(self, docs: np.ndarray) -> np.ndarray:
        return _spread(self.first[docs], self.first[docs + 1])

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents met and their scores: all whose score may be among the k highest and reaches ``floor``."""
        low, high = self.start[terms], self.start[terms + 1]
        some = (high > low) & (weights > 0)
        terms, weights, low, high = terms[some], weights[some], low[some], high[some]
        size = high - low
        local = np.full(len(self.start), -1)
        local[terms] = np.arange(len(terms))
        begin = np.concatenate([[0], np.cumsum(size)])
        seen = np.zeros(begin[-1], dtype=bool)
        met = np.zeros(len(self.first) - 1, dtype=bool)
        best, docs, scores = np.zeros(len(terms), dtype=np.int64), [], []
        kth, depth, step = 0, 0, FIRST_STEP
        while len(terms):
            read = self.places[_spread(low + np.minimum(depth, size), low + np.minimum(depth + step, size))]
            new = self.owner[read]
            new = np.unique(new[~met[new]])
            met[new] = True
            entry = self.of_document(new)
            which = local[self.term[entry]]
            entry, which = entry[which >= 0], which[which >= 0]
            seen[begin[which] + self.place_of[entry] - low[which]] = True
            total = np.zeros(len(new), dtype=np.int64)
            np.add.at(total, np.searchsorted(new, self.owner[entry]), weights[which] * self.impact[entry])
            docs.append(new)
            scores.append(total)
            threshold = 0
            for i in range(len(terms)):
                ahead = seen[begin[i] + best[i]:begin[i + 1]]
                if len(ahead):
                    gap = int(ahead.argmin())
                    best[i] += len(ahead) if ahead[gap] else gap
                if best[i] < size[i]:  # a list seen to its end has nothing for documents not met
                    threshold += int(weights[i]) * int(self.impact[self.places[low[i] + best[i] - 1]])
            all_scores = np.concatenate(scores)
            if len(all_scores) >= k:
                kth = int(np.partition(all_scores, len(all_scores) - k)[len(all_scores) - k])
            if threshold < max(kth, floor, 1):
                break
            depth, step = depth + step, 2 * step
        if not docs:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        docs, scores = np.concatenate(docs), np.concatenate(scores)
        kept = scores >= max(kth, floor, 1)
        return docs[kept], scores[kept]


FOUND = "item long, doc_id long, score long"
FOUND_ARROW = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def _search(shared, k: int):
    def run(rows: pa.Table) -> pa.Table:
        items, size, documents, words = shared.value
        terms, counts = (rows.column(c).combine_chunks() for c in ("terms", "counts"))
        sizes = np.diff(terms.offsets.to_numpy()).astype(np.int64)
        shard = Shard(rows.column("n").to_numpy(), sizes, terms.flatten().to_numpy(), counts.flatten().to_numpy(),
                      size, documents, words)
        ids = rows.column("doc_id").combine_chunks()
        order = ids.fill_null(LATE).to_numpy()
        out = []
        for number, slots, weights, floor in items:
            docs, scores = shard.best(slots, weights, k, floor)
            top = np.lexsort((order[docs], -scores))[:k]
            out.append(pa.table([pa.array(np.full(len(top), number)), ids.take(pa.array(docs[top])),
                                 pa.array(scores[top])], schema=FOUND_ARROW))
        return pa.concat_tables(out) if out else FOUND_ARROW.empty_table()

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    place = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)


def _block(docs: DataFrame, items: list[tuple[int, np.ndarray]], k: int, shard_counts: int) -> DataFrame | None:
    """item, rank, doc_id, score of a block of items: (number, hashes of its words)."""
    spark = docs.sparkSession
    words = np.unique(np.concatenate([h for _, h in items] or [np.zeros(0, np.uint64)]))
    if not len(words):
        return None
    counted = settle(count_words(docs, words).withColumn("row", F.monotonically_increasing_id()), "ranked-counts")
    stats = counted.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("words"),
                        F.sum(F.size("terms")).alias("held")).first()
    if not stats["held"]:
        return None
    df = document_counts(counted, len(words))
    weight = np.floor(1000 * np.log((2 * stats["docs"] + 2) / (2 * df + 1))).astype(np.int64)
    asked = []
    for number, hashes in items:
        own, times = np.unique(hashes, return_counts=True)
        slots = np.searchsorted(words, own)
        asked.append((number, slots, weight[slots] * times))

    shards = -(-stats["held"] // shard_counts)
    dealt = counted.where("size(terms) > 0").withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)))
    first = max(1, shards // 8)
    floors: dict[int, int] = {}
    found = None
    for wanted in (F.col("shard") < first, F.col("shard") >= first):
        if found is not None and first == shards:
            break
        shared = spark.sparkContext.broadcast((
            [(number, slots, weights, floors.get(number, 0)) for number, slots, weights in asked], len(words),
            stats["docs"], stats["words"]))
        one = settle(dealt.where(wanted).groupBy("shard").applyInArrow(_search(shared, k), FOUND), "ranked-found")
        shared.destroy()
        if found is None and first < shards:  # one row per item
            floors = {r["item"]: r["score"] for r in _ranked(one, k).where(F.col("rank") == k).collect()}
        found = one if found is None else found.unionByName(one)
    return _ranked(found, k)


def search(docs: DataFrame, items: DataFrame, k: int = K, block_bytes: int = BLOCK_BYTES,
           shard_counts: int = SHARD_COUNTS) -> DataFrame:
    """item_id, rank, doc_id, score: the k highest-scoring documents of each item."""
    asked = settle(items.select("item_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
                   .withColumn("item", F.monotonically_increasing_id()), "ranked-items")
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = size // block_bytes + 1
    found = None
    for block in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).select("item", "text").toArrow()
        hashes, first = word_hashes(mine.column("text").combine_chunks(), WORDS) if mine.num_rows else ([], [0])
        numbers = mine.column("item").to_pylist()
        one = _block(docs, [(numbers[i], hashes[first[i]:first[i + 1]]) for i in range(len(numbers))], k, shard_counts)
        if one is not None:
            one = settle(one, "ranked-block") if blocks > 1 else one
            found = one if found is None else found.unionByName(one)
    if found is None:
        found = docs.sparkSession.createDataFrame([], FOUND + ", rank int")
    return found.join(asked.select("item", "item_id"), "item").select(
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: item_id, rank, doc_id, score."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS ws FROM documents
), s AS (SELECT count(*) FILTER (len(ws) > 0) AS n_docs, CAST(sum(len(ws)) AS BIGINT) AS n_words FROM d
), m AS (
  SELECT rid, doc_id, ws, 75 + (25 * len(ws)::BIGINT * n_docs) // greatest(n_words, 1) AS m FROM d, s
), p AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(ws) AS term FROM d) GROUP BY ALL
), w AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM p GROUP BY term), s
), b AS (SELECT row_number() OVER () AS item, item_id, {_TERMS} AS ws FROM benchmark
), q AS (SELECT item, item_id, term, count(*) AS times FROM (SELECT item, item_id, unnest(ws) AS term FROM b) GROUP BY ALL
), r AS (
  SELECT item, item_id, rid, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN p USING (term) JOIN m USING (rid) GROUP BY item, item_id, rid, doc_id
), o AS (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM r WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM o WHERE rank <= {K}
"""
