"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text is the average of the embeddings of its hashed character runs of 2, 3 and 4
bytes (words with a blank at either end, A-Z lowered); a linear layer and a
softmax follow. Embeddings and layer are trained together by stochastic gradient
descent in numpy, on the driver, from a bounded sample of labelled rows. Part of the
sample is kept out of training; it calibrates a temperature, so that scores are
probabilities, and the smallest score that is not rejected.

Labels are counted over all rows, then the sample takes each language's first rows in the order of a hash:
``SAMPLE_ROWS`` in all, shared evenly, but ``LEAST_ROWS`` of a language if there are many of them, so a
rare language is learned like a frequent one. Tasks turn a sampled text, the whole of it, into counts
of its subword buckets, and only these, at most ``BUCKETS`` a text, come to the driver. Predictions read
whole texts. The model that goes to the tasks has a fixed size (buckets x languages).

Defined cases: null text, and text without a letter, is ``und`` with score 0 and
counts as rejected; null labels are not learned; without any label everything is
``und``; repeated rows count as often as they occur; other input columns are kept
unless they carry a result's name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from demandlab.llm.common import crc_remainder, steps, table, text_bytes

BUCKETS = 1 << 15
SIZES = (2, 3, 4)
WIDTH = 16
SAMPLE_ROWS = 2000
LEAST_ROWS = 40
BROADCAST_LANGUAGES = 10_000
EPOCHS = 6
RATE = 0.5
KEPT_SHARE = 0.99  # of held-back texts that the rejection keeps
UNKNOWN = "und"
STEP = 2 << 20
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32
LOWERED[[*range(0, 65), *range(91, 97), *range(123, 128)]] = 32  # all but letters and bytes beyond ASCII
RESULT = [StructField("lang_pred", StringType()), StructField("score", DoubleType()),
          StructField("rejected", BooleanType())]


@dataclass
class Model:
    langs: list[str]
    votes: np.ndarray  # buckets x languages: embedding times layer
    bias: np.ndarray
    temperature: float
    least_score: float


def subwords(data: np.ndarray) -> np.ndarray:
    """Bucket of every run of SIZES bytes in cleaned bytes; runs of blanks count as one blank."""
    if not len(data):
        return np.zeros(0, dtype=np.int64)
    keep = np.ones(len(data), dtype=bool)
    keep[1:] = (data[1:] != 32) | (data[:-1] != 32)
    padded = np.concatenate([[32], data[keep], [32]]).astype(np.uint32)
    out = []
    for size in SIZES:
        n = len(padded) - size + 1
        if n < 1:
            continue
        h = np.full(n, size, dtype=np.uint32)
        for k in range(size):
            h = (h ^ padded[k:k + n]) * np.uint32(0x01000193)
        h ^= h >> np.uint32(15)
        out.append((h * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - 15))
    return np.concatenate(out).astype(np.int64) if out else np.zeros(0, dtype=np.int64)


Bag = tuple[np.ndarray, np.ndarray]


def bag(clean: np.ndarray) -> Bag:
    """Buckets of a cleaned text and their shares of all its subwords; a very long text is read in pieces."""
    total = np.zeros(BUCKETS, dtype=np.int64)
    for at in range(0, len(clean), STEP):
        total += np.bincount(subwords(clean[at:at + STEP]), minlength=BUCKETS)
    seen = np.flatnonzero(total)
    return seen, (total[seen] / max(total.sum(), 1)).astype(np.float32)


def train(rows: list[tuple[Bag, str, int]], seed: int = 7) -> Model | None:
    """Trains on (bag, language, hash); one fifth, by hash, calibrates."""
    rows = [r for r in rows if len(r[0][0])]
    langs = sorted({lang for _, lang, _ in rows})
    if not langs:
        return None
    number = {lang: i for i, lang in enumerate(langs)}
    y = np.array([number[lang] for _, lang, _ in rows])
    back = np.array([h % 5 == 0 for _, _, h in rows])
    if back.all() or len(rows) < 20:
        back[:] = False
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 1 / WIDTH, (BUCKETS, WIDTH)).astype(np.float32)
    layer, bias = np.zeros((WIDTH, len(langs)), np.float32), np.zeros(len(langs), np.float32)
    order = np.flatnonzero(~back)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        rng.shuffle(order)
        for i in order:
            seen, part = rows[i][0]
            mean = part @ embed[seen]
            logits = mean @ layer + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[y[i]] -= 1
            pull = layer @ p
            layer -= rate * np.outer(mean, p)
            bias -= rate * 0.1 * p
            embed[seen] -= (rate * part)[:, None] * pull * 10
    votes = embed @ layer
    check = np.flatnonzero(back) if back.any() else np.arange(len(rows))
    logits = np.stack([rows[i][0][1] @ votes[rows[i][0][0]] + bias for i in check])

    def chances(t: float) -> np.ndarray:
        e = np.exp((logits - logits.max(axis=1, keepdims=True)) / t)
        return e / e.sum(axis=1, keepdims=True)

    loss = {t: -np.log(chances(t)[np.arange(len(check)), y[check]] + 1e-12).mean() for t in np.geomspace(0.05, 4, 40)}
    temperature = min(loss, key=loss.get)
    best = chances(temperature).max(axis=1)
    return Model(langs, votes.astype(np.float32), bias, float(temperature), float(np.quantile(best, 1 - KEPT_SHARE)))


def learn(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, least_rows: int = LEAST_ROWS) -> Model | None:
    """Trains on the labelled rows of ``docs`` (text, lang), a bounded number per language."""
    names = [c for c in ("doc_id", "lang") if c in docs.columns]
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL").select(*names, "text")
    known = known.withColumn("h", F.xxhash64(*names, "text"))
    languages = known.select(F.count_distinct("lang")).first()[0]
    room = max(least_rows, sample_rows // max(languages, 1))
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    # All but a little more than the wanted rows fall out by their hash before any are sorted.
    near = F.col("h").cast("double") <= (2.5 * room / F.col("n") - 1) * F.lit(2.0 ** 63)
    # A row per language, and their number is known: texts fall out where they are read, and are not dealt by language.
    small = F.broadcast(counts) if languages <= BROADCAST_LANGUAGES else counts
    first = known.join(small, "lang").where(near | (F.col("n") <= room))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h", *[c for c in names if c != "lang"]))
    chosen = first.withColumn("place", place).where(F.col("place") <= room).select("lang", "h", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            for i in range(batch.num_rows):
                seen, part = bag(LOWERED[raw[offsets[i]:offsets[i + 1]]])
                yield pa.RecordBatch.from_pydict({
                    "lang": batch.column("lang").slice(i, 1), "h": batch.column("h").slice(i, 1),
                    "buckets": [seen.astype(np.uint16).tobytes()], "shares": [part.tobytes()]})

    rows = chosen.mapInArrow(run, "lang string, h long, buckets binary, shares binary").collect()
    return train([((np.frombuffer(r.buckets, np.uint16).astype(np.int64), np.frombuffer(r.shares, np.float32)),
                   r.lang, r.h % 1000) for r in sorted(rows, key=lambda r: (r.lang, r.h))])


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with lang_pred, score (calibrated probability) and rejected."""
    names = {f.name for f in RESULT}
    mine = docs.select([c for c in docs.columns if c not in names])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = mine.schema.fields + RESULT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in steps(batch, limit=STEP):
                raw, offsets = text_bytes(part.column("text"))
                clean = LOWERED[raw]
                lang, score, rejected = [], [], []
                for i in range(part.num_rows):
                    low, high = int(offsets[i]), int(offsets[i + 1])
                    best, p = UNKNOWN, 0.0
                    if model is not None and _has_letter(clean[low:high], raw[low:high]):
                        seen, share = bag(clean[low:high])
                        logits = (share @ model.votes[seen] + model.bias) / model.temperature
                        e = np.exp(logits - logits.max())
                        k = int(e.argmax())
                        best, p = model.langs[k], float(e[k] / e.sum())
                    lang.append(best)
                    score.append(p)
                    rejected.append(best == UNKNOWN or p < model.least_score)
                made = {"lang_pred": pa.array(lang, pa.string()), "score": pa.array(score, pa.float64()),
                        "rejected": pa.array(rejected, pa.bool_())}
                yield pa.RecordBatch.from_pydict(
                    {f.name: made[f.name] if f.name in made else part.column(f.name) for f in fields})

    return mine.mapInArrow(run, StructType(fields))


def _has_letter(clean: np.ndarray, raw: np.ndarray) -> bool:
    """A-Z or a-z, or any letter beyond ASCII."""
    if ((clean >= 97) & (clean <= 122)).any():
        return True
    return bool((raw >= 128).any()) and any(c.isalpha() for c in raw.tobytes().decode())


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: doc_id, held_out, lang_pred, score, rejected."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = crc_remainder(F.col("doc_id"), 3) == 1
    model = learn(docs.where(~held_out))
    found = predict(docs.select("doc_id", "text", held_out.alias("held_out")), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")
