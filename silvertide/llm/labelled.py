"""Labelled rows to learn from: a held-out fold by id, a bounded sample, and calibrated probabilities."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's text modulo the number of folds; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


@dataclass(frozen=True)
class Sample:
    """Texts to learn from, and how many labelled documents each class has."""

    rows: DataFrame  # doc_id, text, label; one row per id, at most so many of each class
    negatives: int
    positives: int

    @property
    def rate(self) -> float:
        """Share of label 1, drawn a little towards zero so that no labels give a low one."""
        return (self.positives + 0.1) / (self.positives + self.negatives + 1.0)


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, folds: int, held_out: int, negatives: int, positives: int) -> Sample:
    """At most so many labelled documents of each class, outside the held-out fold, the first by a hash of their id.

    Ids with several labels take the largest; null ids and labels are left out. Of rows with one id the least text counts.
    The ids of the sample are the only rows sent to all tasks; there are never more than negatives + positives.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col(column).isin(0, 1) & (fold(F.col("doc_id"), folds) != held_out))
        .groupBy("doc_id").agg(F.max(column).cast("int").alias("label"))
    )
    sizes = {r.label: r.n for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = None
    for label, most in ((0, negatives), (1, positives)):
        own = known.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        chosen = own if chosen is None else chosen.union(own)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    return Sample(texts.groupBy("doc_id", "label").agg(F.min("text").alias("text")), sizes.get(0, 0), sizes.get(1, 0))


@dataclass(frozen=True)
class Platt:
    """Probability of label 1 from a raw score: logistic in its log-odds."""

    slope: float
    offset: float

    def __call__(self, raw: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * log_odds(raw) + self.offset)))


def log_odds(p: np.ndarray, least: float = 1e-4) -> np.ndarray:
    p = np.clip(p, least, 1 - least)
    return np.log(p / (1 - p))


def fit_platt(raw: np.ndarray, label: np.ndarray, rate: float, rounds: int = 50) -> Platt:
    """Newton steps on the weighted likelihood; classes weigh as in all labelled rows, not as in the sample.

    Without both classes the score is the rate alone.
    """
    n1, n0 = int(label.sum()), int((1 - label).sum())
    if not n1 or not n0:
        return Platt(0.0, float(np.log(rate / (1 - rate))))
    weight = np.where(label == 1, rate / n1, (1 - rate) / n0) * (n0 + n1)
    x = np.stack([log_odds(raw), np.ones(len(raw))], axis=1)
    ridge, start = np.array([1e-2, 1e-4]), np.array([1.0, 0.0])
    beta = start.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (label - p)) - ridge * (beta - start)
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return Platt(float(max(beta[0], 0.0)), float(beta[1]))
