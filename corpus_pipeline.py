"""The corpus pipeline: its stages, applied one after another to ``documents``.

1. Quality: documents that the ranking rejects go.
2. Near copies: of each group of documents that share 0.8 of their five-word runs one stays.
3. Benchmark decontamination: contaminated documents go.
4. Secrets: every span found in a text is replaced by a mark.
5. SentencePiece: texts become ids, which are decoded again as a check.

Every stage is a function of (spark, docs, sf_dir). All but the last return the columns of
``documents``; the last has ids in place of the text. Rows with null or empty text, null or repeated
ids and very long texts pass through every stage by the rules of its operator; an empty table stays empty.
Columns of the input come back as they were, whatever they are called, but for the text and n_chars that masking
changes; the last stage's n_tokens, ids, parity and round_trip replace input columns of these names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from demandlab.llm import decontam, jaccard, pieces, quality, secrets
from demandlab.llm.common import crc_remainder, settle, table, token

# No SQL expresses a trained ranking, a similarity join or a tokenizer: tests compare with brute force.
ORACLE_SQL = None
READ = ("doc_id", "text")


class Carried:
    """The two columns that operators read, with the others packed away under a name of its own."""

    def __init__(self, docs: DataFrame):
        self.columns, self.name = docs.columns, f"others_{token()}"
        others = [F.col(_quoted(c)) for c in docs.columns if c not in READ]
        self.packed = docs.select(*READ, *([F.struct(*others).alias(self.name)] if others else []))

    def restored(self, found: DataFrame, **changed: Column) -> DataFrame:
        """The rows of ``found`` with all columns that came in, in their order."""
        return found.select(*[changed[c].alias(c) if c in changed else self[c].alias(c) for c in self.columns])

    def __getitem__(self, column: str) -> Column:
        return F.col(column) if column in READ else F.col(self.name)[column]


def _quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from two thirds of the labels, as the scoring query does, and judges every document."""
    learned = crc_remainder(F.col("doc_id"), 3) != 1
    mine = Carried(docs)
    ranking = quality.learn(mine.packed.where(learned), table(spark, sf_dir, "labels").where(learned))
    return mine.restored(quality.score(mine.packed, ranking).where("predicted = 1"))


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one_per_group(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mine = Carried(docs)
    found = decontam.find_contamination(mine.packed, table(spark, sf_dir, "benchmark"))
    return mine.restored(found.where("NOT contaminated"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where a text changes, a numeric n_chars follows it."""
    mine = Carried(docs)
    clean = secrets.redact(secrets.find_secrets(mine.packed))
    changed = {}
    if "n_chars" in docs.columns and isinstance(docs.schema["n_chars"].dataType, NumericType):
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(F.size("secrets") > 0, F.length("text").cast(kind)).otherwise(mine["n_chars"])
    return mine.restored(clean, **changed)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids in place of the text; round_trip tells whether they decode to it."""
    mine = Carried(docs)
    found = pieces.encode(mine.packed, pieces.read_model())
    made = {"n_tokens": F.col("n_tokens"), "ids": F.col("ids"), "parity": F.col("parity"),
            "round_trip": F.col("decoded").eqNullSafe(F.col("text"))}
    kept = [mine[c].alias(c) for c in docs.columns if c != "text" and c not in made]
    return found.select(*kept, *[value.alias(name) for name, value in made.items()])


STAGES = [
    ("quality", keep_good),
    ("near_copies", keep_one_copy),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("sentencepiece", encode_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages; each result is written to the shared folder before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
