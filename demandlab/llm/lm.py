"""Language-model scores from a log-frequency Bloom filter of quantised n-gram counts.

Counting. Tasks hash words and pairs of neighbouring words (a text begins and ends with
an end token), count them, and after ``TASK_ENTRIES`` of them send each reducer one sorted packet of
(hash, count), so a frequent word is one entry per packet. The leading bits of an entry
are those of its last word; a reducer owns a range of these bits and so holds a
word together with all pairs that end in it.

Filter. A pair with count c is entered once for each level 1 .. 1 + floor(log2 c); a
lookup probes level after level until it misses, and the last hit names the count up to a
factor of two. Reducers make filters of at most ``FILTER_BYTES`` each, with the exact
counts of their words; larger ranges give several filters, cut by pair.

Scoring. Filters are sent to the tasks in blocks of at most ``BLOCK_BYTES``, measured before
they are sent, one at a time; each block is one pass over the texts and yields sums per text that are
written and added up, so a corpus of any size is scored with bounded memory, in as many passes as
its filter has blocks.

    p(w | v) = (c(v w) + S * p(w)) / (c(v) + S),  p(w) = (c(w) + 0.1) / (N + 0.1 (V + 1))

Defined cases: null text is empty and has only its end token; with no training rows all
counts are zero; null doc_id counts as empty text for the split; repeated rows are
learned, and scored, as often as they occur; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlab.llm.common import BLANKS, crc_remainder, give_back, mix, settle, steps, table, word_hashes

END = np.uint64(0x5851F42D4C957F2D)
PLUS = 0.1
STRENGTH = 20.0
BITS_PER_ENTRY = 10
PROBES = 6
LEAD_BITS = 16
REDUCER_ENTRIES = 1_000_000
TASK_ENTRIES = 500_000
STEP_BYTES = 1 << 20
FILTER_BYTES = 4 << 20
BLOCK_BYTES = 64 << 20
LEAD = np.uint64(64 - LEAD_BITS)


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes with an end token after each text, and where each text begins."""
    words, first = word_hashes(column, BLANKS)
    return np.insert(words, first[1:], END), first + np.arange(len(first))


def _pairs(tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Entry of (previous token, token); the leading bits are the token's."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[first[:-1]] = END
    both = mix(before * np.uint64(0x9E3779B97F4A7C15) + tokens)
    return ((tokens >> LEAD) << LEAD) | (both >> np.uint64(LEAD_BITS))


def _counted(values: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and their summed counts."""
    if not len(values):
        return values.astype(np.uint64), np.zeros(0, np.int64)
    if counts is None:
        return np.unique(values, return_counts=True)
    order = np.argsort(values, kind="stable")
    values, counts = values[order], counts[order]
    at = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    return values[at], np.add.reduceat(counts, at)


PACKETS = "lead int, words binary, word_counts binary, pairs binary, pair_counts binary"
PACKETS_ARROW = pa.schema([("lead", pa.int32()), ("words", pa.binary()), ("word_counts", pa.binary()),
                           ("pairs", pa.binary()), ("pair_counts", pa.binary())])


def _packets(words, pairs, ranges: int) -> Iterator[pa.RecordBatch]:
    """One packet, and so one row, per range of leading bits, a batch for each."""
    bounds = np.arange(1, ranges, dtype=np.uint64) << np.uint64(64 - (ranges.bit_length() - 1)) \
        if ranges > 1 else np.zeros(0, np.uint64)
    cut_w = [0, *np.searchsorted(words[0], bounds), len(words[0])]
    cut_p = [0, *np.searchsorted(pairs[0], bounds), len(pairs[0])]
    for r in range(ranges):
        w, p = slice(cut_w[r], cut_w[r + 1]), slice(cut_p[r], cut_p[r + 1])
        if w.stop > w.start or p.stop > p.start:
            yield pa.RecordBatch.from_pydict({
                "lead": [r], "words": [words[0][w].tobytes()], "word_counts": [words[1][w].astype(np.uint32).tobytes()],
                "pairs": [pairs[0][p].tobytes()], "pair_counts": [pairs[1][p].astype(np.uint32).tobytes()]},
                schema=PACKETS_ARROW)


def count(texts: DataFrame, ranges: int) -> DataFrame:
    """Packets of word and pair counts per task and range of leading bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def merged():
            return [_counted(np.concatenate([h[k][0] for h in held]), np.concatenate([h[k][1] for h in held]))
                    for k in (0, 1)]

        for batch in batches:
            for part in steps(batch, limit=STEP_BYTES):
                tokens, first = _tokens(part.column("text"))
                held.append((_counted(tokens), _counted(_pairs(tokens, first))))
                size += len(held[-1][0][0]) + len(held[-1][1][0])
                if size > TASK_ENTRIES:
                    yield from _packets(*merged(), ranges)
                    held, size = [], 0
        if held:
            yield from _packets(*merged(), ranges)
        held.clear()
        give_back()

    return texts.select("text").mapInArrow(run, PACKETS)


def _levels(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log2(np.maximum(counts, 1))).astype(np.int64)


def _probe_places(entries: np.ndarray, level: int, bits: np.ndarray | np.uint64) -> Iterator[np.ndarray]:
    h = mix(entries + np.uint64(level * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF))
    low, high = h & np.uint64(0xFFFFFFFF), h >> np.uint64(32)
    for k in range(PROBES):
        yield ((low + np.uint64(k) * high + np.uint64(k * k)) & np.uint64(0xFFFFFFFF)) * bits >> np.uint64(32)


def filter_bits(counts: np.ndarray, bits_per_entry: int = BITS_PER_ENTRY) -> int:
    return max(64, int(_levels(counts).sum()) * bits_per_entry)


def build_filter(entries: np.ndarray, counts: np.ndarray, bits_per_entry: int = BITS_PER_ENTRY) -> np.ndarray:
    """Bits, packed in bytes, of a log-frequency Bloom filter; at most 2**32 bits."""
    levels, bits = _levels(counts), filter_bits(counts, bits_per_entry)
    flags = np.zeros((bits + 7) // 8 * 8, dtype=bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        for place in _probe_places(entries[levels >= level], level, np.uint64(bits)):
            flags[place] = True
    return np.packbits(flags, bitorder="little")


def look_up(packed: np.ndarray, bits: np.ndarray | int, entries: np.ndarray, begin: np.ndarray | int = 0) -> np.ndarray:
    """Level of each entry, 0 where it is not in its filter, which begins at byte ``begin`` and has ``bits`` bits."""
    bits = np.broadcast_to(np.asarray(bits, dtype=np.uint64), entries.shape)
    begin = np.broadcast_to(np.asarray(begin, dtype=np.uint64), entries.shape)
    found = np.zeros(len(entries), dtype=np.int64)
    alive, level = np.arange(len(entries)), 0
    while len(alive):
        level += 1
        mine, first = np.arange(len(alive)), begin[alive]
        for place in _probe_places(entries[alive], level, bits[alive]):
            at = place[mine]
            mine = mine[(packed[first[mine] + (at >> np.uint64(3))] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1]
            if not len(mine):
                break
        alive = alive[mine]
        found[alive] = level
    return found


def expected_count(level: np.ndarray) -> np.ndarray:
    """Middle of the counts of a level: 1, 2.5, 5.5, ..."""
    return np.where(level > 0, (3.0 * 2.0 ** (level - 1) - 1) / 2, 0.0)


FILTERS = ("lead int, part int, parts int, words binary, word_counts binary, bits long, filter binary, "
           "n_tokens long, n_words long, size long")
FILTERS_ARROW = pa.schema([("lead", pa.int32()), ("part", pa.int32()), ("parts", pa.int32()), ("words", pa.binary()),
                           ("word_counts", pa.binary()), ("bits", pa.int64()), ("filter", pa.binary()),
                           ("n_tokens", pa.int64()), ("n_words", pa.int64()), ("size", pa.int64())])


def _joined(column: pa.ChunkedArray, kind) -> np.ndarray:
    return np.concatenate([np.frombuffer(x.as_buffer(), dtype=kind) for x in column] or [np.zeros(0, kind)])


def _reduce(bits_per_entry: int, filter_bytes: int):
    def run(packets: pa.Table) -> pa.Table:
        words, counts = _counted(_joined(packets["words"], np.uint64),
                                 _joined(packets["word_counts"], np.uint32).astype(np.int64))
        pairs, pair_counts = _counted(_joined(packets["pairs"], np.uint64),
                                      _joined(packets["pair_counts"], np.uint32).astype(np.int64))
        parts = filter_bits(pair_counts, bits_per_entry) // 8 // filter_bytes + 1
        of = (pairs % np.uint64(parts)).astype(np.int64)
        rows = []
        for part in range(parts):
            mine = of == part
            packed = build_filter(pairs[mine], pair_counts[mine], bits_per_entry)
            rows.append({"lead": packets["lead"][0].as_py(), "part": part, "parts": parts, "words": words.tobytes(),
                         "word_counts": counts.astype(np.int64).tobytes(),
                         "bits": filter_bits(pair_counts[mine], bits_per_entry), "filter": packed.tobytes(),
                         "n_tokens": int(counts.sum()) if part == 0 else 0, "n_words": len(words) if part == 0 else 0,
                         "size": 16 * len(words) + len(packed)})
        del words, counts, pairs, pair_counts
        give_back()
        return pa.Table.from_pylist(rows, schema=FILTERS_ARROW)

    return run


def train(texts: DataFrame, bits_per_entry: int = BITS_PER_ENTRY, filter_bytes: int = FILTER_BYTES,
          reducer_entries: int = REDUCER_ENTRIES) -> tuple[DataFrame, int, int, int]:
    """The filters (one row each, in the shared folder), the number of tokens, of distinct tokens and of ranges."""
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = 1
    while ranges < 1 << LEAD_BITS and ranges * reducer_entries < total // 5:
        ranges *= 2
    filters = settle(count(texts, ranges).groupBy("lead").applyInArrow(_reduce(bits_per_entry, filter_bytes), FILTERS),
                     "lm-filters")
    sums = filters.agg(F.sum("n_tokens").alias("n"), F.sum("n_words").alias("v")).first()
    return filters, sums["n"] or 0, sums["v"] or 0, ranges


def _blocks(filters: DataFrame, block_bytes: int) -> list[list]:
    """Filters (lead, part, parts, words, bytes, bits) gathered in blocks of measured size, in order."""
    out, size = [[]], 0
    for r in filters.select("lead", "part", "parts", (F.octet_length("words") / 8).cast("long").alias("n"),
                            F.octet_length("filter").alias("bytes"), "bits", "size").orderBy("lead", "part").collect():
        if out[-1] and size + r["size"] > block_bytes:
            out.append([])
            size = 0
        out[-1].append(r)
        size += r["size"]
    return out


@dataclass
class Block:
    """Filters side by side: words of ascending ranges are one sorted array, bits one array of bytes."""

    words: np.ndarray
    counts: np.ndarray
    packed: np.ndarray
    begin: np.ndarray  # first byte of each filter
    bits: np.ndarray
    number: np.ndarray  # of the filter of (lead, part), at first_of[lead] + part; -1 if it is in another block
    first_of: np.ndarray
    parts: np.ndarray  # of each lead, 0 if the block has none of it
    heads: np.ndarray  # leads whose part 0 is here
    orphans: np.ndarray  # leads that no filter has; the first block answers for them


def _block(filters: DataFrame, chosen: list, ranges: int, orphans: np.ndarray) -> Block:
    """Reads the chosen filters one file after another into their places."""
    leads = {r["lead"]: r for r in chosen}
    word_at, n_words = {}, 0
    for lead in sorted(leads):
        word_at[lead] = n_words
        n_words += leads[lead]["n"]
    sizes = np.array([r["bytes"] for r in chosen], dtype=np.int64)
    begin = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    made = Block(np.zeros(n_words, np.uint64), np.zeros(n_words, np.int64), np.zeros(begin[-1], np.uint8),
                 begin[:-1].astype(np.uint64), np.array([r["bits"] for r in chosen], dtype=np.uint64),
                 np.zeros(0), np.zeros(ranges, np.int64), np.zeros(ranges, np.int64), np.zeros(ranges, bool), orphans)
    for lead, r in leads.items():
        made.parts[lead] = r["parts"]
    made.first_of[1:] = np.cumsum(made.parts)[:-1]
    made.number = np.full(int(made.parts.sum()), -1)
    place = {}
    for i, r in enumerate(chosen):
        place[r["lead"], r["part"]] = i
        made.number[made.first_of[r["lead"]] + r["part"]] = i
        made.heads[r["lead"]] |= r["part"] == 0
    if chosen:
        low, high = (F.struct(F.lit(r["lead"]), F.lit(r["part"])) for r in (chosen[0], chosen[-1]))
        mine = filters.where((F.struct("lead", "part") >= low) & (F.struct("lead", "part") <= high))
        for r in mine.select("lead", "part", "words", "word_counts", "filter").toLocalIterator():
            i, at = place[r["lead"], r["part"]], word_at[r["lead"]]
            words = np.frombuffer(r["words"], np.uint64)
            made.words[at:at + len(words)] = words
            made.counts[at:at + len(words)] = np.frombuffer(r["word_counts"], np.int64)
            made.packed[begin[i]:begin[i + 1]] = np.frombuffer(r["filter"], np.uint8)
    return made


SCORED = "doc_id long, text_hash long, n_tokens long, n_known long, base_score double, score double"
SCORED_ARROW = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_tokens", pa.int64()),
                          ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def _pass(docs: DataFrame, shared, ranges: int, n: int, v: int) -> DataFrame:
    """Sums over the tokens whose leading bits the block's filters own, or are orphans, owned by none.

    A word is once predicted and once what the next word is predicted from (the end token
    stands for both ends of a text), so both its terms are added where it is owned.
    """

    def terms(tokens: np.ndarray, pairs: np.ndarray, held: Block) -> tuple[np.ndarray, ...]:
        known, base, full = np.zeros(len(tokens), np.int64), np.zeros(len(tokens)), np.zeros(len(tokens))
        lead = (tokens >> np.uint64(64 - (ranges.bit_length() - 1))).astype(np.int64) if ranges > 1 \
            else np.zeros(len(tokens), np.int64)
        none = held.orphans[lead]
        base[none] = full[none] = np.log10(PLUS / (n + PLUS * (v + 1)))
        at = np.flatnonzero(held.parts[lead] > 0)
        if not len(at) or not len(held.words):
            return known, base, full
        mine, lead = tokens[at], lead[at]
        place = np.minimum(np.searchsorted(held.words, mine), len(held.words) - 1)
        c = np.where(held.words[place] == mine, held.counts[place], 0).astype(np.float64)
        p = (c + PLUS) / (n + PLUS * (v + 1))
        head = held.heads[lead]
        known[at] = head & (c > 0)
        base[at] = np.where(head, np.log10(p), 0.0)
        more = np.where(head, np.log10(STRENGTH * p) - np.log10(c + STRENGTH), 0.0)
        part = (pairs[at] % held.parts[lead].astype(np.uint64)).astype(np.int64)
        number = held.number[held.first_of[lead] + part]
        some = np.flatnonzero(number >= 0)
        number = number[some]
        seen = expected_count(look_up(held.packed, held.bits[number], pairs[at][some], held.begin[number]))
        more[some] += np.log10(1 + seen / (STRENGTH * p[some]))
        full[at] = more
        return known, base, full

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch, limit=STEP_BYTES):
                tokens, first = _tokens(step.column("text"))
                sums = terms(tokens, _pairs(tokens, first), shared.value)
                yield pa.RecordBatch.from_arrays([
                    step.column("doc_id"), step.column("text_hash"), pa.array(np.diff(first), pa.int64()),
                    *(pa.array(np.add.reduceat(x, first[:-1])) for x in sums)], schema=SCORED_ARROW)
            give_back()

    return docs.mapInArrow(run, SCORED)


def score(docs: DataFrame, filters: DataFrame, n: int, v: int, ranges: int,
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score: a row per row of ``docs``.

    Sums of passes meet per (doc_id, text); equal rows have equal sums, so they are
    added once and repeated as often as they occur.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    blocks = _blocks(filters, block_bytes)
    orphans = np.ones(ranges, dtype=bool)
    orphans[[r["lead"] for block in blocks for r in block]] = False
    found = None
    for k, block in enumerate(blocks):
        shared = docs.sparkSession.sparkContext.broadcast(
            _block(filters, block, ranges, orphans if k == 0 else np.zeros(ranges, dtype=bool)))
        # Written before the next block is made: one block is alive at a time, here and in the tasks.
        one = settle(_pass(rows, shared, ranges, n, v).withColumn("pass", F.lit(k)), "lm-pass")
        shared.destroy()
        found = one if found is None else found.unionByName(one)
    each = found.groupBy("doc_id", "text_hash", "pass").agg(
        F.count(F.lit(1)).alias("times"), *(F.max(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")))
    total = each.groupBy("doc_id", "text_hash").agg(
        F.max("times").cast("int").alias("times"), F.max("n_tokens").alias("n_tokens"),
        *(F.sum(c).alias(c) for c in ("n_known", "base_score", "score")))
    return total.select("doc_id", "n_tokens", "n_known", "base_score", "score",
                        F.explode(F.array_repeat(F.lit(0), F.col("times"))).alias("copy")).drop("copy")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_remainder(F.col("doc_id"), 10) == 0
    filters, n, v, ranges = train(docs.where(~held_out))
    return score(docs, filters, n, v, ranges).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
        "base_score", "score")
