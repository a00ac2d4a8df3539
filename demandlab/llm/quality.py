"""Quality scores by Bradley-Terry ranking.

Each text has a vector of measures (shares of character kinds, repetition of words and
pairs of words, word lengths, size). Every labelled row of one kind meets every row of
the other; the Bradley-Terry model says that the better one wins with the logistic
function of the difference of linear scores, and its weights minimise the logistic loss
over all those pairs. The threshold is the quantile of the scores at the share of worse
rows; a fitted scale turns the distance to the threshold into a score between 0 and 1,
with 0.5 at the threshold.

All labelled rows are learned. Tasks measure the whole texts where they read them, before
labels are joined, so that a few numbers a text are shuffled and no text is; after that each
step of the fit is a sum over the stored measures, made by tasks, of a size that does not
depend on the rows. The pairs are not made one by one: the loss has only the difference of
two scores in it, so rows are counted by score in steps of ``BIN`` (each step stands at the
mean of its scores), and pairs of steps are weighted by the product of their counts.

Defined cases: null text is empty and is scored like one; labels that are null or have
no text are not learned; with only one label value, or none, every score is 1.0, 0.0 or
0.5 accordingly; repeated rows count as often as they occur; input columns with a
result's name are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from demandlab.llm.common import BLANKS, crc_remainder, handed_back, mix, settle, steps, table, text_bytes, word_hashes
from demandlab.operators.ranking import exact_quantiles, value_counts

BIN, BINS = 0.05, 400  # steps of the score on which pairs are weighed: -10 to 10, what is beyond in the outer ones
STEEPNESS = np.geomspace(0.05, 5, 41)
ROUNDS = 25
RIDGE = 1e-3
KINDS = {  # bytes whose share is a measure
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "blank": (9, 32), "line": (10, 13),
    "stop": b".,;:?", "shout": b"!", "bar": b"|", "mark": b"#$%&*+=<>@^_~\\/", "bracket": b"()[]{}\"'`", "dash": b"-",
    "wide": range(128, 256)}
KIND_OF = np.full(256, len(KINDS), dtype=np.int64)
for _i, _bytes in enumerate(KINDS.values()):
    KIND_OF[list(_bytes)] = _i
N_KINDS = len(KINDS) + 1


def base_measures(column: pa.Array) -> np.ndarray:
    """A row of measures per text, without their roots."""
    raw, offsets = text_bytes(column)
    rows = len(column)
    sizes = np.diff(offsets)
    owner = np.repeat(np.arange(rows), sizes)
    kinds = np.bincount(owner * N_KINDS + KIND_OF[raw], minlength=rows * N_KINDS).reshape(rows, N_KINDS)
    share = kinds / np.maximum(sizes, 1)[:, None]
    words, first = word_hashes(column, BLANKS)
    count = np.diff(first)
    n = np.maximum(count, 1)
    of = np.repeat(np.arange(rows), count)

    def distinct(values: np.ndarray, rows_of: np.ndarray) -> np.ndarray:
        order = np.lexsort((values, rows_of))
        v, r = values[order], rows_of[order]
        fresh = np.ones(len(v), dtype=bool)
        fresh[1:] = (v[1:] != v[:-1]) | (r[1:] != r[:-1])
        return np.bincount(r[fresh], minlength=rows)

    inner = np.flatnonzero(of[1:] == of[:-1]) if len(of) else np.zeros(0, np.int64)
    pairs = mix(words[inner] * np.uint64(3) + words[inner + 1]) if len(inner) else np.zeros(0, np.uint64)
    pair_of = of[inner] if len(inner) else np.zeros(0, np.int64)
    same = np.bincount(pair_of[words[inner] == words[inner + 1]], minlength=rows) if len(inner) else np.zeros(rows)
    n_pairs = np.maximum(count - 1, 1)
    letters = np.maximum(kinds[:, 0] + kinds[:, 1] + kinds[:, 11] / 2, 1)
    more = np.stack([
        kinds[:, 0] / letters, distinct(words, of) / n, distinct(pairs, pair_of) / n_pairs, same / n_pairs,
        (sizes - kinds[:, 3] - kinds[:, 4]) / n / 10, np.log1p(count) / 10, kinds[:, 4] / n, kinds[:, 5] / n,
        (count == 0).astype(float), (kinds[:, 6] + kinds[:, 7] + kinds[:, 8]) / n], axis=1)
    return np.concatenate([share, more], axis=1)


def with_roots(base: np.ndarray) -> np.ndarray:
    return np.concatenate([base, np.sqrt(base)], axis=1)


def measures(column: pa.Array) -> np.ndarray:
    """A row of measures per text."""
    return with_roots(base_measures(column))


@dataclass
class Ranking:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    steepness: float
    fixed: float | None = None  # score of every text where there is nothing to rank

    def score(self, found: np.ndarray) -> np.ndarray:
        if self.fixed is not None:
            return np.full(len(found), self.fixed)
        z = self.steepness * ((found - self.mean) / self.scale @ self.weights - self.threshold)
        return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


# What a step of the fit adds up: a vector made of the measures and labels of some rows.
Part = Callable[[np.ndarray, np.ndarray], np.ndarray]
Total = Callable[[Part], np.ndarray]


def moments(found: np.ndarray, label: np.ndarray) -> np.ndarray:
    return np.concatenate([[len(label), (label == 0).sum()], found.sum(axis=0), (found * found).sum(axis=0)])


def _bins(scores: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(scores / BIN) + BINS // 2, 0, BINS - 1).astype(np.int64)


def _placed(x: np.ndarray, label: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores, and the place of each row among the steps of the worse rows, then those of the better ones."""
    scores = x @ weights
    return scores, _bins(scores) + BINS * (label == 1)


def fit_weights(total: Total, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Newton steps on the mean logistic loss over all pairs of a better and a worse row."""
    width = len(mean)
    weights = np.zeros(width)
    for _ in range(ROUNDS):

        def spread(found: np.ndarray, label: np.ndarray, weights=weights) -> np.ndarray:
            scores, place = _placed((found - mean) / scale, label, weights)
            return np.concatenate([np.bincount(place, minlength=2 * BINS), np.bincount(place, scores, 2 * BINS)])

        count, summed = total(spread).reshape(2, 2, BINS)
        at = summed / np.maximum(count, 1)
        lose = 1 / (1 + np.exp(np.clip(at[1][:, None] - at[0][None, :], -30, 30)))
        share = count[1][:, None] * count[0][None, :] / (count[1].sum() * count[0].sum())
        # Per row of a step: how much all its pairs pull, and how much they bend.
        pull, bend = share * lose, share * lose * (1 - lose)
        row_bend = np.concatenate([bend.sum(axis=0), bend.sum(axis=1)]) / np.maximum(count.reshape(-1), 1)

        def bent(found: np.ndarray, label: np.ndarray, weights=weights, row_bend=row_bend) -> np.ndarray:
            x = (found - mean) / scale
            _, place = _placed(x, label, weights)
            by_step = np.zeros((2 * BINS, width))
            np.add.at(by_step, place, x)
            return np.concatenate([by_step.reshape(-1), (x.T @ (x * row_bend[place][:, None])).reshape(-1)])

        sums = total(bent)
        curve = sums[2 * BINS * width:].reshape(width, width)
        worse, better = sums[:2 * BINS * width].reshape(2, BINS, width) / np.maximum(count, 1)[:, :, None]
        slope = better.T @ pull.sum(axis=1) - worse.T @ pull.sum(axis=0) - RIDGE * weights
        both = better.T @ bend @ worse
        step = np.linalg.solve(curve - both - both.T + RIDGE * np.eye(width), slope)
        weights = weights + step
        if np.abs(step).max() < 1e-3:  # the next step would be about its square
            break
    return weights


def fit_steepness(total: Total, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, threshold: float) -> float:
    def losses(found: np.ndarray, label: np.ndarray) -> np.ndarray:
        away = ((found - mean) / scale) @ weights - threshold
        signed = np.where(label == 1, -away, away)
        return np.array([np.log1p(np.exp(np.clip(k * signed, -30, 30))).sum() for k in STEEPNESS])

    return float(STEEPNESS[np.argmin(total(losses))])


def fit(total: Total, checked: Total, quantile: Callable[[np.ndarray, np.ndarray, np.ndarray, float], float]) -> Ranking:
    """Weights from the rows behind ``total``, threshold and scale from those behind ``checked``."""
    none = np.zeros(0)
    seen = total(moments)
    if not len(seen) or seen[1] in (0, seen[0]):
        return Ranking(none, none, none, 0.0, 0.0, float(seen[1] == 0) if len(seen) and seen[0] else 0.5)
    mean, squares = (seen[2:] / seen[0]).reshape(2, -1)
    scale = np.sqrt(np.maximum(squares - mean * mean, 0)) + 1e-6
    weights = fit_weights(total, mean, scale)
    known = seen if checked is total else checked(moments)
    threshold = quantile(mean, scale, weights, float(known[1] / known[0]))
    return Ranking(mean, scale, weights, threshold, fit_steepness(checked, mean, scale, weights, threshold))


def rank(found: np.ndarray, label: np.ndarray, back: np.ndarray) -> Ranking:
    """Fits the ranking on arrays; rows held back set threshold and scale only."""
    use = ~back
    if back.sum() < 20 or len(set(label[use])) < 2 or len(set(label[back])) < 2:
        use = back = np.ones(len(label), dtype=bool)
    return fit(lambda part: part(found[use], label[use]), lambda part: part(found[back], label[back]),
               lambda mean, scale, weights, share: float(np.quantile((found[back] - mean) / scale @ weights, share)))


def _measured(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return (with_roots(batch.column("measures").flatten().to_numpy().reshape(batch.num_rows, -1)),
            batch.column("quality").to_numpy())


def _total(rows: DataFrame, part: Part) -> np.ndarray:
    """The sum of ``part`` over all rows; tasks add up their own, places are added up by Spark. Empty without rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        added = None
        for batch in batches:
            if batch.num_rows:
                made = part(*_measured(batch))
                added = made if added is None else added + made
        if added is not None:
            kept = np.flatnonzero(added)
            kept = np.union1d(kept, [len(added) - 1])  # the last place tells the size
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.int64()), pa.array(added[kept], pa.float64())],
                                             names=["place", "value"])

    # As many rows as the vector has places, whatever the input.
    sums = rows.mapInArrow(run, "place long, value double").groupBy("place").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(max((r["place"] for r in sums), default=-1) + 1)
    for r in sums:
        out[r["place"]] = r["value"]
    return out


def learn(docs: DataFrame, labels: DataFrame) -> Ranking:
    """Fits a ranking on all rows of ``labels`` (doc_id, quality); texts come from ``docs``."""
    known = labels.where("quality IN (0, 1)").select("doc_id", F.col("quality").cast("int").alias("quality"))
    texts = docs.select("doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    fields = StructType([texts.schema["doc_id"], StructField("measures", ArrayType(DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, limit=2 << 20):
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(list(base_measures(part.column("text"))))],
                    names=["doc_id", "measures"])

    measured = texts.mapInArrow(handed_back(run), fields)
    rows = settle(measured.join(known, "doc_id").select("quality", "measures"), "labelled-measures")

    def total(part: Part) -> np.ndarray:
        return _total(rows, part)

    def quantile(mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, share: float) -> float:
        def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    made = (_measured(batch)[0] - mean) / scale @ weights
                    yield pa.RecordBatch.from_arrays([pa.array(made, pa.float64())], names=["value"])

        scored = rows.mapInArrow(scores, "value double").select(F.lit("all").alias("sample"), "value")
        found = exact_quantiles(value_counts(scored, ["sample"], "value"), ["sample"], "value", [share])
        return float(found.first()["quantiles"][0])

    return fit(total, total, quantile)


def score(docs: DataFrame, ranking: Ranking) -> DataFrame:
    """``docs`` with score and predicted."""
    mine = docs.select([c for c in docs.columns if c not in ("score", "predicted")])
    shared = docs.sparkSession.sparkContext.broadcast(ranking)
    fields = mine.schema.fields + [StructField("score", DoubleType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, limit=2 << 20):
                made = pa.array(shared.value.score(measures(part.column("text"))), pa.float64())
                yield pa.RecordBatch.from_arrays([*part.columns, made], names=[f.name for f in fields])

    return mine.mapInArrow(handed_back(run), StructType(fields)).withColumn("predicted", F.expr("CAST(score >= 0.5 AS INT)"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: doc_id, held_out, score, predicted."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_remainder(F.col("doc_id"), 3) == 1
    ranking = learn(docs.where(~held_out), table(spark, sf_dir, "labels").where(~held_out))
    return score(docs.withColumn("held_out", held_out), ranking).select("doc_id", "held_out", "score", "predicted")
