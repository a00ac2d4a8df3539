"""Document fingerprints from spot signatures, with DataFrame functions only.

A signature is a common word (the anchor) with the content words that follow it, common
words left out: three of them, or what stands before the third next anchor; line starts are anchors too, so text without common words has
signatures. A fingerprint is the sorted set of hashed signatures. Two fingerprints are
compared by Jaccard similarity; where only similarities of a threshold or more matter,
fingerprints are partitioned by set length, compared only with partitions whose
lengths can reach the threshold, and pruned by a common signature in their prefixes.

Defined cases: null text is empty; texts without content words have an empty
fingerprint; two empty fingerprints are alike (1.0), one is unlike everything else (0.0);
rows with null doc_id come last; rows with equal doc_id follow each other by text; a
single row is its own next document; input columns other than doc_id and text are left
out of the comparison with the next document; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandlab.llm.common import table

CHAIN = 3
LINE = "§"
# Common words of four languages that serve as anchors.
COMMON = {
    "en": "the of and to in a is that it for on was be with as this by are an from",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur",
    "es": "de la que el en y a los se del las un por con no una su para es al",
}
ANCHORS = sorted({w for words in COMMON.values() for w in words.split()})
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANCHOR = f" ({'|'.join([LINE, *ANCHORS])})(?= |$)"
HASH_CHARS = 12
# Rows are dealt to ranges of doc_id of about this many bytes; ranges are bounded in number.
RANGE_BYTES = 16 << 20
MOST_RANGES = 10_000


def signatures(text: Column) -> Column:
    """Array of the text's spot signatures, as words: anchor and content words."""
    words = F.regexp_replace(F.replace(F.translate(text, UPPER, LOWER), F.lit("\n"), F.lit(f" {LINE} ")), GAPS, " ")
    marked = F.regexp_replace(F.concat(F.lit(f"{LINE} "), F.trim(words)), ANCHOR, "#$1")
    pieces = F.split(F.trim(marked), "#", -1)

    def rest(piece: Column) -> Column:
        return F.when(F.instr(piece, " ") > 0, F.substr(piece, F.instr(piece, " "))).otherwise("")

    def chains(all_pieces: Column) -> Column:
        return F.transform(all_pieces, lambda p, i: F.substring_index(F.concat(
            p, F.coalesce(rest(F.get(all_pieces, i + 1)), F.lit("")),
            F.coalesce(rest(F.get(all_pieces, i + 2)), F.lit(""))), " ", CHAIN + 1))

    # Bound to a name once, so that the pieces are made once.
    bound = F.element_at(F.transform(F.array(pieces), chains), 1)
    return F.filter(bound, lambda s: F.instr(s, " ") > 0)


def fingerprint(text: Column) -> Column:
    """Sorted array of distinct signature hashes; equal texts have equal fingerprints."""
    return F.array_sort(F.array_distinct(F.transform(
        signatures(F.coalesce(text, F.lit(""))), lambda s: F.substring(F.md5(s.cast("binary")), 1, HASH_CHARS))))


def likeness(a: Column, b: Column, at_least: float = 0.0) -> Column:
    """Jaccard similarity of two fingerprints; 0 where their lengths alone rule ``at_least`` out."""
    few, many = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    both = F.size(F.array_intersect(a, b))
    return (F.when(many == 0, 1.0).when((few == 0) | (few < at_least * many), 0.0)
            .otherwise(both.cast("double") / (F.size(a) + F.size(b) - both)))


def similar_pairs(prints: DataFrame, at_least: float = 0.8) -> DataFrame:
    """(a, b, likeness) of ``prints`` (id, fingerprint; distinct fingerprints) that reach ``at_least``.

    Partition p holds set lengths in [r**p, r**(p+1)) with r = 1 / at_least, so partners
    lie in the same or the next partition. Hash order is the global order of
    signatures; two sets that reach the threshold share one in their prefixes.
    """
    sized = prints.withColumn("n", F.size("fingerprint")).where("n > 0").withColumn(
        "part", F.floor(F.log("n") / math.log(1 / at_least) + 1e-9))
    keep = F.col("n") - F.ceil(F.col("n") * at_least - 1e-9) + 1
    head = sized.select("id", "fingerprint", "n", "part",
                        F.explode(F.slice("fingerprint", F.lit(1), keep.cast("int"))).alias("sig"))
    right = head.select(F.col("id").alias("b"), F.col("fingerprint").alias("fb"), F.col("n").alias("nb"), "sig",
                        F.explode(F.array(F.col("part"), F.col("part") - 1)).alias("part"),
                        F.col("part").alias("own"))
    found = head.join(right, ["sig", "part"]).where(
        (F.col("n") < F.col("nb")) | ((F.col("n") == F.col("nb")) & (F.col("id") < F.col("b"))))
    found = found.where(F.col("n") >= at_least * F.col("nb") - 1e-9)
    return (found.select(F.col("id").alias("a"), "b", likeness(F.col("fingerprint"), F.col("fb"), at_least)
                         .alias("likeness")).where(F.col("likeness") >= at_least - 1e-9).distinct())


def _ranges(docs: DataFrame) -> tuple[list[int], list[int | None], list[int]]:
    """Lower bounds of ranges of doc_id; per range its largest doc_id and the range that precedes it
    in descending order. Position 0 stands for null. At most ``MOST_RANGES`` values reach the driver."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = min(MOST_RANGES, max(1, int(total // RANGE_BYTES)))
    share = [i / n for i in range(1, n)]
    bounds = docs.agg(F.percentile_approx("doc_id", share, 20 * MOST_RANGES)).first()[0] if share else []
    bounds = sorted(set(bounds or []))
    tops = {r["range"]: r["top"] for r in docs.groupBy(_range(bounds).alias("range")).agg(
        F.max("doc_id").alias("top")).collect()}
    order = sorted(tops, reverse=True)
    before = [0] * (len(bounds) + 2)
    for i, one in enumerate(order):
        before[one] = order[i - 1]
    return bounds, [tops.get(i) for i in range(len(bounds) + 2)], before


def _range(bounds: list[int]) -> Column:
    """Number of a doc_id's range by binary search: 0 for null, else 1 + bounds at or below it."""
    if not bounds:
        return F.when(F.col("doc_id").isNull(), 0).otherwise(1)
    held = F.lit([int(b) for b in bounds]).cast("array<bigint>")
    jumps = F.lit([1 << k for k in reversed(range(len(bounds).bit_length()))]).cast("array<int>")
    below = F.aggregate(jumps, F.lit(0), lambda a, s: F.when(
        F.coalesce(F.get(held, a + s - 1) <= F.col("doc_id"), F.lit(False)), a + s).otherwise(a))
    return F.when(F.col("doc_id").isNull(), 0).otherwise(below + 1)


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, fingerprint, next_text, next_fingerprint, next in descending doc_id and cyclic.

    Texts move once, to ranges of doc_id; the first row of each range is also
    sent to the range before it, so no window spans more than one range.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    bounds, tops, before = _ranges(rows)
    placed = rows.withColumn("range", _range(bounds))
    top = F.get(F.lit(tops).cast("array<bigint>"), F.col("range"))
    target = F.get(F.lit(before).cast("array<int>"), F.col("range"))
    here = F.struct(F.col("range"), F.lit(False).alias("guest"))
    there = F.struct(target.alias("range"), F.lit(True).alias("guest"))
    dealt = placed.select("doc_id", "text", F.explode(F.when(F.col("doc_id").eqNullSafe(top), F.array(here, there))
                                                      .otherwise(F.array(here))).alias("at")).select(
        "doc_id", "text", "at.range", "at.guest")
    dealt = dealt.repartition("range").withColumn("fingerprint", fingerprint(F.col("text")))
    order = Window.partitionBy("range").orderBy("guest", F.desc_nulls_last("doc_id"), "text")
    return dealt.select("doc_id", "text", "fingerprint", "guest", F.lead("text").over(order).alias("next_text"),
                        F.lead("fingerprint").over(order).alias("next_fingerprint")).where("NOT guest").drop("guest")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    pairs = with_next(table(spark, sf_dir, "documents")).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")),
                      F.substring("next_text", F.lit(1), half))
    made = pairs.withColumn("edited", edited).withColumn("edited_fingerprint", fingerprint(F.col("edited")))
    return made.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        F.array_join("fingerprint", ",").alias("fingerprint"),
        F.array_join("edited_fingerprint", ",").alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))


def _print_sql(text: str) -> str:
    words = (f"trim(regexp_replace(replace(translate({text}, '{UPPER}', '{LOWER}'), chr(10), ' {LINE} '), "
             rf"'{GAPS}', ' ', 'g'), ' ')")
    marked = (f"regexp_replace(replace('{LINE} ' || {words}, ' ', '  ') || ' ', "
              rf"' ({'|'.join([LINE, *ANCHORS])}) ', '#\1 ', 'g')")
    pieces = f"string_split(trim(regexp_replace({marked}, ' +', ' ', 'g'), ' '), '#')"
    trimmed = f"list_transform({pieces}, lambda p: rtrim(p, ' '))"
    rests = ("CASE WHEN i + {k} <= len(ps) AND instr(ps[i + {k}], ' ') > 0 "
             "THEN substr(ps[i + {k}], instr(ps[i + {k}], ' ')) ELSE '' END")
    chain = f"string_split(ps[i] || {rests.format(k=1)} || {rests.format(k=2)}, ' ')[1:{CHAIN + 1}]"
    return (f"(SELECT coalesce(list_sort(list_distinct(list(substr(md5(s), 1, {HASH_CHARS})))), []) FROM "
            f"(SELECT array_to_string({chain}, ' ') AS s FROM "
            f"(SELECT ps, unnest(range(1, len(ps) + 1)) AS i FROM (SELECT {trimmed} AS ps))) WHERE instr(s, ' ') > 0)")


SQL = f"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, CAST(length(coalesce(text, '')) AS BIGINT) AS n FROM documents
), o AS (
  SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id DESC NULLS LAST, text),
    first_value(text) OVER (ORDER BY doc_id DESC NULLS LAST, text)) AS after FROM t
), e AS (
  SELECT *, substr(text, 1, n - n // 2) || substr(after, 1, n // 2) AS edited FROM o
), p AS (
  SELECT doc_id, n, sha256(edited) AS edited_sha256, {_print_sql('text')} AS a, {_print_sql('edited')} AS b,
    {_print_sql('after')} AS c FROM e
)
SELECT doc_id, n AS n_chars, edited_sha256, array_to_string(a, ',') AS fingerprint,
  array_to_string(b, ',') AS edited_fingerprint,
  CASE WHEN len(a) = 0 AND len(b) = 0 THEN 1.0::DOUBLE WHEN len(a) = 0 OR len(b) = 0 THEN 0.0::DOUBLE ELSE
    len(list_intersect(a, b))::DOUBLE / (len(a) + len(b) - len(list_intersect(a, b))) END AS near_edited,
  CASE WHEN len(a) = 0 AND len(c) = 0 THEN 1.0::DOUBLE WHEN len(a) = 0 OR len(c) = 0 THEN 0.0::DOUBLE ELSE
    len(list_intersect(a, c))::DOUBLE / (len(a) + len(c) - len(list_intersect(a, c))) END AS near_next
FROM p
"""
