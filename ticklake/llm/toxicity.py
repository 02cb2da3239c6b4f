"""Toxicity by maximum-scoring segments of token log-odds, calibrated by extreme values.

1. Tokens (hashed into ``BUCKETS``) are counted in toxic and other documents of a labelled
   sample. Their log-odds with an informative Dirichlet prior (the counts of both classes
   together) are drawn toward zero by some standard deviations (``SURE``), and every token costs
   ``DRIFT``, so that clean text has a negative mean score.
2. A linear scan finds all maximal scoring segments of a text: the runs of tokens whose
   score no extension and no part can better.
3. Under clean text the best score of n tokens follows an extreme-value law with
   parameters K and lambda. lambda solves E[exp(lambda * score)] = 1 over the tokens of
   clean documents, K is its maximum-likelihood estimate from their best segments. Segments
   whose normalised score ``lambda * S - ln(K n)`` is positive are significant, and a
   document's evidence is the sum over them.
4. A logistic curve over the evidence, the best segment and the length gives the
   probability. K and the curve are fitted on the other half of the sample than the token
   counts behind them, with the classes weighted by how frequent they are among all labels;
   the loss also chooses among the values of ``SURE``. This is done with the halves in both
   roles, and a document's probability is the mean of the two (``Crossed``).

Bounds: at most about ``FIT_DOCS`` labelled documents of each class are read to learn; their
labels, a few hundred kB, are broadcast. The model is one number per bucket.

Defined results: null and empty texts have no evidence and get the curve's lowest end; with
one class alone, or no labels, the score is that class's rate (0 without labels). Several
labels of an id count as toxic if one is. Repeated rows are scored alike; an empty table
gives no rows. Only the text enters a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import plain_words, staged

BUCKETS = 1 << 18
FIT_DOCS = 10_000
PRIOR = 0.05  # pseudo-counts of each token, as a share of its count in both classes
SURE = (1.0, 1.5, 2.0, 3.0)  # tried; the best on the calibrating half is taken
DRIFT = 0.15
WORDS_KEPT = 300_000
SPREAD = 1 << 40


class Buckets(dict):
    """Bucket of each word, remembered for the frequent ones."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word) & (BUCKETS - 1)
        return value

    def of(self, text: str | None) -> np.ndarray:
        words = plain_words(text)
        return np.fromiter(map(self.__getitem__, words), dtype=np.int32, count=len(words))


def log_odds(toxic: np.ndarray, other: np.ndarray, sure: float) -> np.ndarray:
    """Score of each bucket: shrunken log-odds less the drift."""
    together = (toxic + other).astype(float)
    prior = PRIOR * (together + 1e-3)
    one, zero = toxic + prior, other + prior
    odds = lambda a: np.log(a) - np.log(a.sum() - a)
    delta = odds(one) - odds(zero)
    deviation = np.sqrt(1 / one + 1 / zero)
    return np.sign(delta) * np.maximum(np.abs(delta) - sure * deviation, 0) - DRIFT


def segments(scores: np.ndarray) -> list[tuple[float, int, int]]:
    """All maximal scoring segments (score, first, last) by a linear scan.

    Candidates keep the cumulative sum left of them and up to their end. A new one merges
    with earlier candidates as long as the nearest with a smaller sum on its left has also
    a smaller sum at its end. Whole runs of positive scores enter as one candidate.
    """
    above = np.flatnonzero(scores > 0)
    if not len(above):
        return []
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    breaks = np.flatnonzero(np.diff(above) > 1)
    firsts = above[np.concatenate([[0], breaks + 1])].tolist()
    lasts = above[np.concatenate([breaks, [len(above) - 1]])].tolist()
    found: list[tuple[float, float, int, int]] = []  # sum before, sum at end, first, last
    smaller: list[int] = []  # of each candidate: the nearest with a smaller sum before it
    for first, last in zip(firsts, lasts):
        left, right = float(sums[first]), float(sums[last + 1])
        while True:
            at = len(found) - 1
            while at >= 0 and found[at][0] >= left:
                at = smaller[at]
            if at < 0 or found[at][1] >= right:
                break
            left, first = found[at][0], found[at][2]
            del found[at:], smaller[at:]
        found.append((left, right, first, last))
        smaller.append(at)
    return [(right - left, first, last) for left, right, first, last in found]


@dataclass
class Model:
    """Scores of buckets, extreme-value parameters, and the curve (or a fixed rate)."""

    scores: np.ndarray
    rate: float
    decay: float = 1.0  # lambda
    scale: float = 1.0  # K
    curve: np.ndarray | None = None

    def evidence(self, codes: np.ndarray) -> tuple[float, float, float]:
        """Sum of significant normalised scores, the best score in units of 1 / lambda, and
        the logarithm of the length."""
        if not len(codes):
            return 0.0, 0.0, 0.0
        chance = np.log(self.scale * len(codes))
        found = [self.decay * s for s, _, _ in segments(self.scores[codes])]
        return sum(max(0.0, s - chance) for s in found), max(found, default=0.0), float(np.log1p(len(codes)))

    def passages(self, codes: np.ndarray) -> list[tuple[int, int, float]]:
        """Significant passages: first and last word, normalised score."""
        chance = np.log(self.scale * max(1, len(codes)))
        found = ((a, b, self.decay * s - chance) for s, a, b in segments(self.scores[codes]))
        return [p for p in found if p[2] > 0]

    def probability(self, features: np.ndarray) -> np.ndarray:
        if self.curve is None:
            return np.full(len(features), self.rate)
        return 1 / (1 + np.exp(-np.clip(_design(features) @ self.curve, -35, 35)))


class Crossed:
    """Models of both halves, each calibrated on the half that it has not learned from."""

    def __init__(self, models: list[Model]):
        self.models = models

    def evidence(self, codes: np.ndarray) -> tuple[float, ...]:
        return tuple(value for model in self.models for value in model.evidence(codes))

    def probability(self, features: np.ndarray) -> np.ndarray:
        """The mean of the models' probabilities."""
        parts = features.reshape(len(features), len(self.models), 3)
        return sum(model.probability(parts[:, at]) for at, model in enumerate(self.models)) / len(self.models)

    def passages(self, codes: np.ndarray) -> list[tuple[int, int, float]]:
        """Passages that are significant under a model; of overlapping ones the best."""
        found: list[tuple[int, int, float]] = []
        for passage in sorted((p for m in self.models for p in m.passages(codes)), key=lambda p: -p[2]):
            if all(passage[1] < first or passage[0] > last for first, last, _ in found):
                found.append(passage)
        return sorted(found)


def _design(features: np.ndarray) -> np.ndarray:
    total, best, length = features.reshape(-1, 3).T
    return np.column_stack([np.ones(len(total)), np.log1p(total), best, np.sqrt(best), length])


def decay_of(scores: np.ndarray, weights: np.ndarray) -> float:
    """The positive root of E[exp(x * score)] = 1."""
    held = weights > 0
    scores, weights = scores[held], weights[held] / weights.sum()
    if not (scores > 0).any() or (scores @ weights) >= 0:
        return 1.0
    low, high = 1e-6, 1e-3
    excess = lambda x: (weights * np.exp(np.minimum(x * scores, 700))).sum() - 1
    while excess(high) < 0 and high < 50:
        low, high = high, high * 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return low


def logistic(design: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted ridge logistic regression by Newton steps."""
    curve = np.zeros(design.shape[1])
    ridge = np.eye(len(curve)) * 1e-2
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(design @ curve, -35, 35)))
        slope = design.T @ (weights * (labels - p)) - ridge @ curve
        bend = (design * (weights * p * (1 - p))[:, None]).T @ design + ridge
        step = np.linalg.solve(bend, slope)
        curve += step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return curve


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", fit_docs: int = FIT_DOCS,
) -> Model | Crossed:
    """Learn from a bounded sample of each class: the labelled ids of smallest hash."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic")).filter(
        "id IS NOT NULL AND toxic IS NOT NULL"
    ).groupBy("id").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    zero, one = sizes.get(0, 0), sum(n for k, n in sizes.items() if k)
    rate = one / max(1, one + zero)
    if not one or not zero:
        return Model(np.zeros(BUCKETS), rate)
    place = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit(2)), F.lit(SPREAD))
    limit = F.when(F.col("toxic") != 0, fit_docs * SPREAD // one).otherwise(fit_docs * SPREAD // zero)
    picked = known.filter(place <= limit).select(
        F.col("id").alias("picked_id"), (F.col("toxic") != 0).alias("toxic"), (place % 2).cast("int").alias("half")
    )
    # bounded: about fit_docs rows of each class, three numbers in each
    sample = staged(
        docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
        .join(F.broadcast(picked), F.col("id") == F.col("picked_id")).select("text", "toxic", "half"),
        "labelled",
    )
    counts = np.zeros((2, 2, BUCKETS))  # half, class, bucket
    for row in _counted(sample).collect():
        counts[row["half"], :, row["bucket"]] = row["other"], row["toxic"]
    # bounded by the sample; each half is calibrated on the other one
    found = [_calibrated(sample, counts[half], 1 - half, rate) for half in (0, 1)]
    known = [model for model in found if model is not None]
    return Crossed(known) if known else Model(np.zeros(BUCKETS), rate)


def _calibrated(sample: DataFrame, counts: np.ndarray, other_half: int, rate: float) -> Model | None:
    """Scores from the counts of one half, with K, the curve and the shrinkage from the
    other half; None if that has one class alone."""
    models = []
    for sure in SURE:
        scores = log_odds(counts[1], counts[0], sure)
        models.append(Model(scores, rate, decay_of(scores, counts[0])))
    calibrating = sample.filter(F.col("half") == other_half)
    best = _each(calibrating, models, _best_segment)
    for place, model in enumerate(models):
        tokens, score = best[:, 1 + 2 * place], best[:, 2 + 2 * place]
        clean = (best[:, 0] == 0) & (tokens > 0)
        if clean.any():
            expected = (tokens[clean] * np.exp(-model.decay * score[clean])).sum()
            model.scale = float(np.clip(clean.sum() / expected, 1e-6, 1.0))
    rows = _each(calibrating, models, Model.evidence)
    toxic = rows[:, 0] > 0
    if toxic.all() or not toxic.any():
        return None
    weights = np.where(toxic, rate / toxic.mean(), (1 - rate) / (1 - toxic.mean()))
    losses = []
    for place, model in enumerate(models):
        features = rows[:, 1 + 3 * place : 4 + 3 * place]
        model.curve = logistic(_design(features), toxic.astype(float), weights)
        p = np.clip(model.probability(features), 1e-9, 1 - 1e-9)
        losses.append(-(weights * np.log(np.where(toxic, p, 1 - p))).sum())
    return models[int(np.argmin(losses))]


def _best_segment(model: Model, codes: np.ndarray) -> tuple[int, float]:
    return len(codes), max((s for s, _, _ in segments(model.scores[codes])), default=0.0)


def _counted(sample: DataFrame) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, counts = Buckets(), np.zeros((2, 2, BUCKETS), dtype=np.int64)
        for batch in batches:
            columns = (batch.column(n).to_pylist() for n in ("text", "toxic", "half"))
            for text, toxic, half in zip(*columns):
                codes, times = np.unique(buckets.of(text), return_counts=True)
                counts[half, int(toxic), codes] += times
        for half in (0, 1):
            held = np.flatnonzero(counts[half].any(axis=0))
            yield pa.RecordBatch.from_arrays(
                [pa.array([half] * len(held), pa.int32()), pa.array(held), pa.array(counts[half, 0, held]), pa.array(counts[half, 1, held])],
                names=["half", "bucket", "other", "toxic"],
            )

    return sample.mapInArrow(count, "half int, bucket long, other long, toxic long").groupBy("half", "bucket").agg(
        F.sum("other").alias("other"), F.sum("toxic").alias("toxic")
    )


def _each(sample: DataFrame, models: list[Model], values) -> np.ndarray:
    """Numbers of every sampled document (bounded by the sample): its label, and ``values``
    under each model."""
    shared = sample.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets()
        for batch in batches:
            rows = []
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                codes = buckets.of(text)
                rows.append([float(toxic), *(float(v) for m in shared.value for v in values(m, codes))])
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64()))], names=["n"])

    got = [r["n"] for r in sample.mapInArrow(run, "n array<double>").collect()]
    return np.array(got, dtype=float) if got else np.zeros((0, 1 + 3 * len(models)))


def share(docs: DataFrame, model: Model | Crossed) -> Broadcast:
    return docs.sparkSession.sparkContext.broadcast(model)


def score(model: Broadcast, text: Column) -> Column:
    """Probability that a text is toxic."""

    @F.pandas_udf("double")
    def score_of(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        buckets, learned = Buckets(), model.value
        for texts in series:
            if not len(texts):
                yield pd.Series([], dtype=float)
                continue
            features = np.array([learned.evidence(buckets.of(t)) for t in texts], dtype=float).reshape(len(texts), -1)
            yield pd.Series(learned.probability(features))

    return score_of(text.cast("string"))


def passages(model: Broadcast, text: Column) -> Column:
    """Significant passages of a text: first and last word, normalised score."""

    @F.pandas_udf("array<struct<first:long,last:long,score:double>>")
    def passages_of(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        buckets, learned = Buckets(), model.value
        for texts in series:
            yield pd.Series([
                [{"first": a, "last": b, "score": s} for a, b, s in learned.passages(buckets.of(t))] for t in texts
            ], dtype=object)

    return passages_of(text.cast("string"))
