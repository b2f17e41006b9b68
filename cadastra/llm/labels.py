"""Bounded samples of labelled documents, and what is fitted to them on the driver."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.llm.columns import named


def held_out(doc_id: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder; false for a null id."""
    remainder = F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds
    return F.coalesce(remainder == fold, F.lit(False))


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    target: str,
    folds: int,
    fold: int,
    per_class: int,
    max_chars: int,
    doc_id: str = "doc_id",
    text: str = "text",
    more: Sequence[str] = (),
) -> tuple[DataFrame, dict[int, float]]:
    """(doc_id, text, _label, m0, m1, ... for the numbers `more`) outside the held-out fold, and how many documents
    each stands for, by label.

    At most `per_class` ids of each label, those with the smallest hashes, none with more than `max_chars` characters,
    and one row of an id, the least. Of several labels of one id the largest counts; null labels and ids do not.
    """
    rows = labels.select(named(doc_id).alias("labelled"), named(target).cast("int").alias("_label"))
    rows = rows.where(F.col("_label").isin(0, 1) & F.col("labelled").isNotNull() & ~held_out("labelled", folds, fold))
    rows = rows.groupBy("labelled").agg(F.max("_label").alias("_label"))
    counts = {row["_label"]: row["count"] for row in rows.groupBy("_label").count().collect()}
    order = (F.xxhash64("labelled"), "labelled")
    chosen = rows.where("_label = 0").orderBy(*order).limit(per_class).union(
        rows.where("_label = 1").orderBy(*order).limit(per_class)
    )
    numbers = [named(c).cast("double").alias(f"m{i}") for i, c in enumerate(more)]
    own = docs.select(named(doc_id).alias("doc_id"), named(text).alias("text"), *numbers).where(F.length("text") <= max_chars)
    sample = own.join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled"))
    first = F.min(F.struct("text", *(f"m{i}" for i in range(len(more))))).alias("first")
    sample = sample.groupBy("doc_id", "_label").agg(first).select("doc_id", "_label", "first.*")
    return sample, {c: n / min(n, per_class) for c, n in counts.items()}


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


class Calibration:
    """Logistic regression of a few statistics, fitted by Newton steps with weighted rows."""

    def __init__(self, features: np.ndarray, label: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> None:
        self.mean, self.scale = features.mean(axis=0), features.std(axis=0) + 1e-9
        x = self._scaled(features)
        weight = weight / weight.sum()
        self.beta = np.zeros(x.shape[1])
        shrink = ridge * np.eye(x.shape[1])
        shrink[-1, -1] = 1e-6
        for _ in range(30):
            p = sigmoid(x @ self.beta)
            gradient = x.T @ (weight * (p - label)) + shrink @ self.beta
            curvature = (x.T * (weight * p * (1 - p))) @ x + shrink
            self.beta -= np.linalg.solve(curvature, gradient)

    def _scaled(self, features: np.ndarray) -> np.ndarray:
        return np.c_[(features - self.mean) / self.scale, np.ones(len(features))]

    def __call__(self, features: np.ndarray) -> np.ndarray:
        return sigmoid(self._scaled(features) @ self.beta)
