"""Quality by a factorisation machine.

A document is a sparse vector: hashed words, bins of structure statistics of its text, and a bin of
each metadata number it carries. The machine adds a weight of each feature and, for each pair
of features, the product of their values and of their factor vectors. The sum over pairs is had in linear
time: half of the square of the summed factors less the sum of their squares, in each dimension.

Training is by stochastic gradients on a bounded sample of labelled documents (`PER_CLASS`,
`MAX_CHARS`), on the driver; scoring reads whole texts, on the executors.

Cases: a null text is read as empty, and an empty one has a bin of its own. A null number has a bin of its own.
Without labels of both classes every score is the label that there is, or 1. Rows
are neither dropped nor merged; other columns stay, but a column `score` is replaced.
"""

from __future__ import annotations

import math
import operator
import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.llm.columns import named
from cadastra.llm.labels import labelled_sample, sigmoid

PER_CLASS = 3_000
MAX_CHARS = 50_000
#: Positions of hashed words; structure and metadata have positions of their own above them.
WORD_POSITIONS = 1 << 14
FACTORS = 8
EPOCHS, BATCH, RATE, RIDGE = 12, 32, 0.1, 1e-4
_BINS = 12
_TOKEN = re.compile(r"\w+|[^\w\s]+")
_STATISTICS = 13
#: Metadata columns, at most.
_METADATA = 4
POSITIONS = WORD_POSITIONS + (_STATISTICS + _METADATA) * (_BINS + 1)


def _share(part: float, whole: float) -> int:
    """A share as a bin: finer near 0."""
    return min(_BINS - 1, int(math.sqrt(part / whole) * _BINS)) if whole else 0


def _magnitude(number: float) -> int:
    return min(_BINS - 1, max(0, int(math.log2(1 + max(0.0, number)) / 1.6)))


def structure(text: str, tokens: list[str], counts: Counter) -> list[int]:
    """Bins of statistics of how a text is made."""
    lines = text.split("\n")
    words = [t for t in tokens if t[0].isalnum() or t[0] == "_"]
    letters = sum(map(len, words))
    symbols = sum(len(t) for t in tokens) - letters
    runs = sum(1 for t in tokens if len(t) >= 2 and not (t[0].isalnum() or t[0] == "_"))
    capitals = sum(1 for w in words if len(w) > 1 and w.isupper())
    upper = sum(1 for w in words if w[0].isupper())
    digits = sum(1 for w in words if w[0].isdigit())
    repeats = sum(map(operator.eq, words, words[1:]))
    n = len(tokens)
    return [
        _magnitude(n),
        _magnitude(len(text)),
        _share(symbols, letters + symbols),
        _share(runs, n),
        _share(capitals, len(words)),
        _share(upper, len(words)),
        _share(digits, len(words)),
        _share(len(counts), n),
        _share(max(counts.values(), default=0), n),
        _share(len(lines) - len(set(lines)), len(lines)),
        _share(n - len(words), n),
        _share(repeats, len(words)),
        min(_BINS - 1, int(letters / len(words))) if words else 0,
    ]


def features(text: str | None, metadata: Sequence[float | None] = ()) -> tuple[np.ndarray, np.ndarray]:
    """(positions, values) of a document's vector; no position twice."""
    text = text or ""
    tokens = _TOKEN.findall(text)
    counts = Counter(tokens)
    hashed: dict[int, float] = {}
    for token, count in counts.items():
        at = zlib.crc32(token.lower().encode("utf-8", "replace")) % WORD_POSITIONS
        hashed[at] = hashed.get(at, 0.0) + 1.0 + math.log(count)
    norm = math.sqrt(sum(v * v for v in hashed.values())) or 1.0
    positions, values = list(hashed), [v / norm for v in hashed.values()]
    bins = structure(text, tokens, counts) if tokens else [_BINS] * _STATISTICS
    bins += [_BINS if m is None or m != m else _magnitude(float(m)) for m in metadata]
    for group, at in enumerate(bins):
        positions.append(WORD_POSITIONS + group * (_BINS + 1) + at)
        values.append(0.3)
    return np.array(positions, np.int64), np.array(values)


class FactorisationMachine:
    """Weights and factors; `constant` is the score where nothing could be learned."""

    def __init__(self, constant: float | None = None) -> None:
        draw = np.random.default_rng(0)
        self.constant = constant
        self.bias = 0.0
        self.weight = np.zeros(POSITIONS)
        self.factors = draw.normal(0.0, 0.05, (POSITIONS, FACTORS))

    def margin(self, positions: np.ndarray, values: np.ndarray) -> float:
        rows = self.factors[positions] * values[:, None]
        summed = rows.sum(axis=0)
        pairs = 0.5 * float((summed * summed - (rows * rows).sum(axis=0)).sum())
        return self.bias + float(self.weight[positions] @ values) + pairs

    def score(self, text: str | None, metadata: Sequence[float | None] = ()) -> float:
        if self.constant is not None:
            return self.constant
        return float(sigmoid(np.array(self.margin(*features(text, metadata)))))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray, weight: np.ndarray) -> None:
        """Adaptive gradient steps on the weighted logistic loss, in batches."""
        draw = np.random.default_rng(1)
        weight = weight / weight.mean()
        rate = float(np.clip((weight * label).sum() / weight.sum(), 1e-3, 1 - 1e-3))
        self.bias = math.log(rate / (1 - rate))
        seen = [1e-2, np.full(POSITIONS, 1e-2), np.full((POSITIONS, FACTORS), 1e-2)]
        for _ in range(EPOCHS):
            order = draw.permutation(len(rows))
            for start in range(0, len(order), BATCH):
                batch = order[start : start + BATCH]
                size = len(batch)
                positions = np.concatenate([rows[i][0] for i in batch])
                values = np.concatenate([rows[i][1] for i in batch])
                own = np.repeat(np.arange(size), [len(rows[i][0]) for i in batch])
                ends = np.concatenate([[0], np.cumsum([len(rows[i][0]) for i in batch])])[:-1]
                scaled = self.factors[positions] * values[:, None]
                summed = np.add.reduceat(scaled, ends, axis=0)
                pairs = 0.5 * (summed**2 - np.add.reduceat(scaled**2, ends, axis=0)).sum(axis=1)
                linear = np.add.reduceat(self.weight[positions] * values, ends)
                error = weight[batch] * (sigmoid(self.bias + linear + pairs) - label[batch]) / size
                touched, at = np.unique(positions, return_inverse=True)
                step = error[own] * values
                by_weight = np.bincount(at, step, len(touched)) + RIDGE * self.weight[touched]
                by_factor = np.zeros((len(touched), FACTORS))
                np.add.at(by_factor, at, step[:, None] * (summed[own] - scaled))
                by_factor += RIDGE * self.factors[touched]
                seen[0] += float(error.sum()) ** 2
                seen[1][touched] += by_weight**2
                seen[2][touched] += by_factor**2
                self.bias -= RATE * float(error.sum()) / math.sqrt(seen[0])
                self.weight[touched] -= RATE * by_weight / np.sqrt(seen[1][touched])
                self.factors[touched] -= RATE * by_factor / np.sqrt(seen[2][touched])


def fit(
    docs: DataFrame, labels: DataFrame, folds: int, fold: int, target: str = "quality", text: str = "text", metadata: Sequence[str] = ()
) -> FactorisationMachine:
    """Fit to the labelled documents outside the held-out fold."""
    sample, weights = labelled_sample(docs, labels, target, folds, fold, PER_CLASS, MAX_CHARS, text=text, more=metadata)
    rows = sample.toPandas().sort_values(["text", "_label"])
    label = rows["_label"].to_numpy()
    if len(set(label)) < 2:
        return FactorisationMachine(float(label[0]) if len(label) else 1.0)
    numbers = rows[[f"m{i}" for i in range(len(metadata))]].to_numpy(float)
    machine = FactorisationMachine()
    vectors = [features(t, tuple(m)) for t, m in zip(rows["text"], numbers, strict=True)]
    machine.fit(vectors, label.astype(float), np.array([weights[y] for y in label], float))
    return machine


def score(text: Column, machine: FactorisationMachine, metadata: Sequence[Column] = ()) -> Column:
    """Probability of label 1, between 0 and 1."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for batch in batches:
            numbers = zip(*(batch[c] for c in batch.columns[1:]), strict=True) if batch.shape[1] > 1 else ((),) * len(batch)
            yield pd.Series([machine.score(t, m) for t, m in zip(batch[batch.columns[0]], numbers, strict=True)], dtype=float)

    return scored(F.struct(text.alias("text"), *(m.cast("double").alias(f"m{i}") for i, m in enumerate(metadata))))


def score_documents(docs: DataFrame, machine: FactorisationMachine, text: str = "text", metadata: Sequence[str] = ()) -> DataFrame:
    """`docs` with `score`."""
    return docs.withColumn("score", score(named(text), machine, [named(c) for c in metadata]))
