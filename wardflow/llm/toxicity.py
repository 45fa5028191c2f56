"""Toxicity scores by a factorization machine over hashed terms.

Score = sigmoid(w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j) over the hashed words and word
beginnings that a text holds: the pairwise part sees combinations, such as an insult with the
mention of a group, that no additive weights do.  Learnt on a bounded sample: at most
``PER_CLASS`` labelled rows of each class, by the hash of their key, of the ``FEATURES`` terms that
tell the classes best apart.

Null and empty texts have no terms and get the score of the constant.  Without both classes among
the labels the score is the share of toxic ones (0.5 without any).  Repeated rows have the same
score; an empty table gives an empty result.  Whole texts are scored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.batches import per_text
from wardflow.llm.terms import Sample, adam, features, held_out, sample

PER_CLASS = 8000
FEATURES = 4096
SUPPORT = 4  # sample rows that must hold a term
FACTORS = 8
STEPS, RATE = 300, 0.05
DECAY, FACTOR_DECAY = 1e-5, 1e-4


class FactorizationMachine:
    def __init__(self, chosen: np.ndarray, size: int, start: float):
        self.chosen = chosen
        self.constant = np.array([start])
        self.weights = np.zeros(size)
        self.factors = np.random.default_rng(7).normal(0, 0.05, (size, FACTORS))

    def margins(self, row: np.ndarray, feature: np.ndarray, value: np.ndarray, n: int):
        """Log odds of each row, and its factor sums."""
        sums = np.zeros((n, FACTORS))
        squares = np.zeros(n)
        for f in range(FACTORS):
            x = self.factors[feature, f] * value
            sums[:, f] = np.bincount(row, x, n)
            squares += np.bincount(row, x * x, n)
        linear = np.bincount(row, self.weights[feature] * value, n)
        return self.constant[0] + linear + 0.5 * ((sums**2).sum(axis=1) - squares), sums

    def scores(self, texts: pa.Array) -> np.ndarray:
        margin, _ = self.margins(*features(texts, self.chosen))
        return 1 / (1 + np.exp(-np.clip(margin, -40, 40)))


def fit(rows: Sample) -> FactorizationMachine:
    """Logistic loss by full-batch Adam; the same sample gives the same machine."""
    share = float((rows.label * rows.weight).sum() / max(1e-9, rows.weight.sum())) if rows.n else 0.5
    start = float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
    if len(np.unique(rows.label)) < 2:
        return FactorizationMachine(np.full(1 << 18, -1, np.int32), 0, start)
    chosen = rows.choose(FEATURES, SUPPORT)
    row, feature, value = rows.reduced(chosen)
    size = int(chosen.max()) + 1
    model = FactorizationMachine(chosen, size, start)

    def gradient() -> list[np.ndarray]:
        margin, sums = model.margins(row, feature, value, rows.n)
        error = (1 / (1 + np.exp(-np.clip(margin, -40, 40))) - rows.label) * rows.weight / rows.n
        each = error[row] * value
        by_factor = np.empty_like(model.factors)
        for f in range(FACTORS):
            v = model.factors[feature, f]
            by_factor[:, f] = np.bincount(feature, each * (sums[row, f] - v * value), size)
        return [
            np.array([error.sum()]),
            np.bincount(feature, each, size) + DECAY * model.weights,
            by_factor + FACTOR_DECAY * model.factors,
        ]

    adam([model.constant, model.weights, model.factors], gradient, STEPS, RATE)
    return model


def toxicity(text: Column, model: Broadcast) -> Column:
    return per_text(lambda texts: pa.array(model.value.scores(texts)), "double")(text)


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> FactorizationMachine:
    return fit(sample(docs, labels, F.col("toxic"), PER_CLASS, False, key, text))


def score(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``held_out``, ``score`` and ``predicted`` of each row."""
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, key, text))
    return docs.select(
        F.col(key), held_out(F.col(key)).alias("held_out"), toxicity(F.col(text), model).alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
