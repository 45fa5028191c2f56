"""Quality grades by ordinal cumulative-link regression on graded ratings.

P(grade >= j) = sigmoid(w.x - t_j): one weight for each hashed term, shared by all grades, and
ordered thresholds t_1 < t_2.  The expected grade is the sum of the tail probabilities; a text is
kept if P(grade >= ``KEEP_GRADE``) is at least a half.

Grades come from the labels: 0 for low quality, 1 for sound but toxic text, 2 for sound text.
Terms are words and word beginnings by presence, and the shapes of token endings by their share,
which tell shouting, tables and symbol noise from prose.  Learnt on at most ``PER_CLASS`` labelled
rows of each grade, by the hash of their key; held-out rows are never learnt from.

Null and empty texts have no terms and get the grade of the thresholds alone.  Repeated rows have
the same grade; an empty table gives an empty result.  Without labels of two grades the thresholds
alone, from the shares of the grades, decide.  Whole texts are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.batches import per_text
from wardflow.llm.terms import HASH_BITS, Sample, adam, features, held_out, sample

GRADES = 3
KEEP_GRADE = 1
PER_CLASS = 5000
FEATURES = 4096
SUPPORT = 5
STEPS, RATE, DECAY = 200, 0.05, 1e-4

# Shares of token shapes are small numbers beside presences.
SHARE_SCALE = 5.0


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class OrdinalRegression:
    def __init__(self, chosen: np.ndarray, size: int, shares: np.ndarray):
        self.chosen = chosen
        self.weights = np.zeros(size)
        tails = np.clip(np.cumsum(shares[::-1])[::-1][1:], 1e-4, 1 - 1e-4)
        at = np.maximum.accumulate(-np.log(tails / (1 - tails)))
        # the first threshold, and logs of the steps to the next: the order holds by itself
        self.thresholds = np.r_[at[:1], np.log(np.maximum(np.diff(at), 1e-2))]

    def cuts(self) -> np.ndarray:
        return np.cumsum(np.r_[self.thresholds[:1], np.exp(self.thresholds[1:])])

    def tails(self, row, feature, value, n: int) -> np.ndarray:
        """P(grade >= j) for j = 1, 2, ... of each row."""
        x = np.where(value < 1, value * SHARE_SCALE, value)
        margin = np.bincount(row, self.weights[feature] * x, n)
        return _sigmoid(margin[:, None] - self.cuts())


def fit(rows: Sample) -> OrdinalRegression:
    shares = np.bincount(rows.label, rows.weight, GRADES) / max(1e-9, rows.weight.sum())
    if not rows.n:
        shares = np.full(GRADES, 1 / GRADES)
    if len(np.unique(rows.label)) < 2:
        return OrdinalRegression(np.full(1 << HASH_BITS, -1, np.int32), 0, shares)
    chosen = rows.choose(FEATURES, SUPPORT)
    row, feature, value = rows.reduced(chosen)
    size = int(chosen.max()) + 1
    model = OrdinalRegression(chosen, size, shares)
    grade, each = rows.label, np.arange(rows.n)
    x = np.where(value < 1, value * SHARE_SCALE, value)

    def gradient() -> list[np.ndarray]:
        tails = np.c_[np.ones(rows.n), model.tails(row, feature, value, rows.n), np.zeros(rows.n)]
        upper, lower = tails[each, grade], tails[each, grade + 1]
        likely = np.maximum(upper - lower, 1e-9)
        up, low = upper * (1 - upper) / likely, lower * (1 - lower) / likely
        weight = rows.weight / rows.n
        error = -(up - low) * weight
        by_cut = np.zeros(GRADES - 1)
        for j in range(1, GRADES):
            by_cut[j - 1] = ((up * (grade == j) - low * (grade == j - 1)) * weight).sum()
        by_threshold = np.cumsum(by_cut[::-1])[::-1].copy()
        by_threshold[1:] *= np.exp(model.thresholds[1:])
        return [
            np.bincount(feature, error[row] * x, size) + DECAY * model.weights,
            by_threshold,
        ]

    adam([model.weights, model.thresholds], gradient, STEPS, RATE)
    return model


def grade_of(quality: Column, toxic: Column) -> Column:
    """0, 1 or 2; null without a quality label."""
    return F.when(quality == 0, 0).when((quality == 1) & (toxic == 1), 1).when(quality == 1, 2)


def graded(text: Column, model: Broadcast) -> Column:
    def run(texts: pa.Array) -> pa.Array:
        own = model.value
        tails = own.tails(*features(texts, own.chosen, True))
        return pa.StructArray.from_arrays(
            [pa.array(tails.sum(axis=1)), pa.array(tails[:, KEEP_GRADE - 1].copy())],
            ["expected_grade", "tail_probability"],
        )

    return per_text(run, "expected_grade double, tail_probability double")(text)


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> OrdinalRegression:
    grade = grade_of(F.col("quality"), F.col("toxic"))
    return fit(sample(docs, labels, grade, PER_CLASS, True, key, text))


def grade(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``held_out``, ``expected_grade``, ``tail_probability`` and ``kept`` of each row."""
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, key, text))
    return docs.select(
        F.col(key), held_out(F.col(key)).alias("held_out"), graded(F.col(text), model).alias("found")
    ).select(key, "held_out", "found.*", (F.col("found.tail_probability") >= 0.5).alias("kept"))
