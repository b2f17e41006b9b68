"""Language by sparse multinomial logistic regression on TF-IDF character n-grams.

A text is lower-cased, everything but letters (and marks within words) becomes a space, and runs of spaces become
one. Its n-grams of 1 to `LONGEST` characters, word ends included, are hashed to positions; a position's value is its
count times its inverse document frequency, and the vector has length one. How many documents hold a
position is counted over all documents that may be learned from, by the executors; the positions bound what is collected.

Weights are trained by follow-the-regularised-leader, one rate a coordinate, with an elastic-net penalty:
the L1 part leaves most weights at exactly zero, the L2 part shrinks the others. A part of the sample is kept from
training, and the temperature that divides the margins is fitted to it, so that a score of 0.9 is right nine times in ten.

Fitting uses a bounded sample of labelled documents (`PER_CLASS` and `MAX_CHARS`, and the `CLASSES` most frequent
languages); statistics and predictions cover whole texts of all documents.

Cases: a text that is null, empty or without a letter is `und` with score 0. Without any labelled document every text
is `und`; with one language every text with a letter is that one, with score 1. Texts of any length are read
whole. Rows are neither dropped nor merged; other columns stay, but `lang_pred` and `score` are replaced.
Equal scores go to the language that is first in order.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cadastra.llm.columns import Aside, named
from cadastra.llm.labels import held_out

UNKNOWN = "und"
#: Characters of an n-gram, at most, and positions they are hashed to.
LONGEST = 4
POSITIONS = 1 << 16
#: Labelled documents of a language, their characters, languages, and all labelled documents, at most.
PER_CLASS, MAX_CHARS, CLASSES, SAMPLE = 1_000, 20_000, 200, 20_000
#: Of the sample, one document in so many is kept for the temperature.
CALIBRATION = 5
#: Follow-the-regularised-leader: rate, smoothing, and the two penalties; passes over the sample and documents in a step.
ALPHA, BETA, L1, L2, EPOCHS, BATCH = 1.0, 0.1, 0.02, 0.1, 4, 32
#: Characters that are hashed at a time.
_AT_ONCE = 1 << 20
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


@cache
def _lettered() -> np.ndarray:
    """For each code point 1 if it is a letter, 2 if it is a mark, 0 else."""
    kinds = {"L": 1, "M": 2}
    return np.array([kinds.get(unicodedata.category(chr(c))[0], 0) for c in range(sys.maxunicode + 1)], np.uint8)


def letters(text: str | None) -> np.ndarray:
    """Code points of a text's words, with one space before, between and after them; empty if there is no letter."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), "<u4")
    kind = _lettered()[codes]
    if not (kind == 1).any():
        return np.zeros(0, np.uint64)
    codes = np.concatenate([[32], np.where(kind > 0, codes, 32), [32]]).astype(np.uint64)
    return codes[np.append(True, (codes[1:] != 32) | (codes[:-1] != 32))]


def counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The positions that a text holds, and how often."""
    codes, total = letters(text), None
    shift = np.uint64(64 - int(POSITIONS).bit_length() + 1)
    for start in range(0, len(codes), _AT_ONCE):
        part = codes[start : start + _AT_ONCE + LONGEST - 1]
        own = min(_AT_ONCE, len(codes) - start)
        state, found = np.zeros(len(part), np.uint64), []
        for size in range(1, min(LONGEST, len(part)) + 1):
            state = (state[: len(part) - size + 1] ^ (part[size - 1 :] + np.uint64(size))) * _FACTOR
            found.append(state[:own] >> shift)
        some = np.bincount(np.concatenate(found).astype(np.int64), minlength=POSITIONS)
        total = some if total is None else total + some
    at = np.flatnonzero(total) if total is not None else np.zeros(0, np.int64)
    return at, total[at] if len(at) else at


class LanguageModel:
    """Inverse document frequencies, weights of the positions that have any, and the temperature."""

    def __init__(self, languages: list[str], idf: np.ndarray, weights: np.ndarray, bias: np.ndarray, temperature: float = 1.0) -> None:
        self.languages, self.idf, self.bias, self.temperature = languages, idf, bias, temperature
        used = np.flatnonzero(np.any(weights, axis=1))
        self.row = np.zeros(POSITIONS, np.int32)  # 0: a position without weights
        self.row[used] = np.arange(1, len(used) + 1)
        self.weights = np.concatenate([np.zeros((1, weights.shape[1])), weights[used]])

    def margins(self, at: np.ndarray, count: np.ndarray) -> np.ndarray:
        value = vector(at, count, self.idf)
        return value @ self.weights[self.row[at]] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        at, count = counts(text)
        if not self.languages or not len(at):
            return UNKNOWN, 0.0
        margin = self.margins(at, count) / self.temperature
        share = np.exp(margin - margin.max())
        best = int(margin.argmax())
        return self.languages[best], float(share[best] / share.sum())


def vector(at: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Values of a text's positions, of length one."""
    value = count * idf[at]
    return value / (float(np.sqrt((value * value).sum())) or 1.0)


class Leader:
    """Follow-the-regularised-leader over the weights of one class each column."""

    def __init__(self, rows: int, classes: int) -> None:
        self.sums, self.squares = np.zeros((rows, classes)), np.zeros((rows, classes))

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.sums[at], self.squares[at]
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def step(self, at: np.ndarray, gradient: np.ndarray, weights: np.ndarray) -> None:
        n = self.squares[at]
        grown = n + gradient**2
        self.sums[at] += gradient - (np.sqrt(grown) - np.sqrt(n)) / ALPHA * weights
        self.squares[at] = grown


def train(rows: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """(weights, bias) of vectors as (positions, values) and the number of their class; all classes weigh the same."""
    leader, draw = Leader(POSITIONS + 1, classes), np.random.default_rng(0)  # the last row is the bias
    weight = len(label) / classes / np.bincount(label, minlength=classes)
    for _ in range(EPOCHS):
        order = draw.permutation(len(rows))
        for start in range(0, len(order), BATCH):
            batch = order[start : start + BATCH]
            size = np.array([len(rows[i][0]) for i in batch])
            at = np.concatenate([rows[i][0] for i in batch])
            value = np.concatenate([rows[i][1] for i in batch])
            own, touched = np.repeat(np.arange(len(batch)), size), np.unique(at)
            column = np.searchsorted(touched, at)
            weights, bias = leader.weights(touched), leader.weights(slice(POSITIONS, None))
            margin = np.repeat(bias, len(batch), axis=0)
            np.add.at(margin, own, value[:, None] * weights[column])
            share = np.exp(margin - margin.max(axis=1, keepdims=True))
            error = share / share.sum(axis=1, keepdims=True)
            error[np.arange(len(batch)), label[batch]] -= 1.0
            error *= weight[label[batch]][:, None]
            gradient = np.zeros_like(weights)
            for c in range(classes):
                gradient[:, c] = np.bincount(column, value * error[own, c], len(touched))
            leader.step(touched, gradient, weights)
            leader.step(np.array([POSITIONS]), error.sum(axis=0, keepdims=True), bias)
    weights = leader.weights()
    return weights[:POSITIONS], weights[POSITIONS]


def fitted_temperature(margins: np.ndarray, label: np.ndarray) -> float:
    """The temperature with the least log loss, between 1/16 and 16."""

    def loss(power: float) -> float:
        scaled = margins / 2.0**power
        scaled = scaled - scaled.max(axis=1, keepdims=True)
        return float((np.log(np.exp(scaled).sum(axis=1)) - scaled[np.arange(len(label)), label]).mean())

    low, high, part = -4.0, 4.0, (np.sqrt(5) - 1) / 2
    while high - low > 1e-3:
        a, b = high - part * (high - low), low + part * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return 2.0 ** ((low + high) / 2)


def document_frequencies(docs: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """How many documents hold each position, and how many have a letter."""

    def held(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, documents = np.zeros(POSITIONS, np.int64), 0
        for batch in batches:
            for value in batch["text"]:
                own, _ = counts(value)
                total[own] += 1
                documents += len(own) > 0
        at = np.flatnonzero(total)
        yield pd.DataFrame({"at": np.append(at, -1), "n": np.append(total[at], documents)})

    counted = docs.select(named(text).alias("text")).mapInPandas(held, "at long, n long")
    total = np.zeros(POSITIONS + 1, np.int64)
    for at, n in counted.groupBy("at").agg(F.sum("n")).collect():  # a row for each position, at most
        total[at] = n
    return total[:POSITIONS], int(total[POSITIONS])


def _sampled(docs: DataFrame, text: str, lang: str) -> list[tuple[str, str]]:
    """(language, text) of a bounded sample, drawn by hashes of the texts; a repeated text counts once."""
    rows = docs.select(named(lang).alias("lang"), named(text).alias("text"))
    rows = rows.where(F.col("lang").isNotNull() & (F.length("text") > 0) & (F.length("text") <= MAX_CHARS))
    rows = rows.withColumn("draw", F.xxhash64("text"))
    texts = F.approx_count_distinct("draw").alias("texts")
    known = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), texts).orderBy(F.desc("n"), "lang").limit(CLASSES).collect()
    if not known:
        return []
    most = min(PER_CLASS, -(-SAMPLE // len(known)))
    # About four times as many different texts as are wanted, then the exact number of them.
    share = F.create_map(*(F.lit(x) for row in known for x in (row["lang"], min(1.0, 4.0 * most / row["texts"]))))
    drawn = rows.where(F.pmod("draw", F.lit(1 << 30)) < F.element_at(share, F.col("lang")) * (1 << 30))
    first = Window.partitionBy("lang").orderBy("draw")
    chosen = drawn.groupBy("lang", "draw").agg(F.min("text").alias("text")).withColumn("at", F.row_number().over(first))
    return sorted(tuple(r) for r in chosen.where(F.col("at") <= most).select("lang", "text").collect())


def fit(docs: DataFrame, folds: int, fold: int, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> LanguageModel:
    """Fit to the documents outside the held-out fold."""
    own = docs.where(~held_out(doc_id, folds, fold))
    sample = _sampled(own, text, lang)
    languages = sorted({language for language, _ in sample})
    if len(languages) < 2:
        return LanguageModel(languages, np.ones(POSITIONS), np.zeros((POSITIONS, len(languages))), np.zeros(len(languages)))
    held, documents = document_frequencies(own, text)
    return fit_texts([t for _, t in sample], np.array([languages.index(x) for x, _ in sample]), languages, held, documents)


def fit_texts(texts: list[str], label: np.ndarray, languages: list[str], held: np.ndarray, documents: int) -> LanguageModel:
    """A model of labelled texts, given how many of `documents` hold each position."""
    idf = np.log((1 + documents) / (1 + held)) + 1
    totals = [counts(t) for t in texts]
    vectors = [(at, vector(at, count, idf)) for at, count in totals]
    kept = np.arange(len(texts)) % CALIBRATION == 0
    learned = [i for i in range(len(texts)) if not kept[i]]
    if len(set(label[learned])) < len(languages):  # too few to keep any
        learned, kept = list(range(len(texts))), np.ones(len(texts), bool)
    weights, bias = train([vectors[i] for i in learned], label[learned], len(languages))
    model = LanguageModel(languages, idf, weights, bias)
    margins = np.array([model.margins(*totals[i]) for i in np.flatnonzero(kept)])
    model.temperature = fitted_temperature(margins, label[kept])
    return model


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """`docs` with `lang_pred` and `score`, the calibrated probability of that language."""

    @F.pandas_udf("lang_pred string, score double")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([model.predict(value) for value in batch], columns=["lang_pred", "score"])

    aside = Aside(docs)
    rows = aside.frame.withColumn("found", predicted(aside[text]))
    return aside.back(rows.select("*", "found.*"), ("lang_pred", "score"))
