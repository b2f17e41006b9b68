"""Toxicity by compression distance: which of two zstandard dictionaries suits the windows of a text better.

An ordinary dictionary is trained on ordinary text, a toxic one on toxic text, and each is used alone. A window is
compressed with both; the bytes that the toxic dictionary saves are its gain. How many windows of a text have which gain
is turned into a probability that is calibrated on labelled documents which the dictionaries were not trained on.

Most of a toxic document is prose like any other. So the toxic dictionary is trained again on those windows of toxic
documents that its first version, trained on other toxic documents, compresses clearly better than the ordinary
one does; what the ordinary dictionary knows drops out, what toxic documents share stays. Compressed lengths alone decide
what that is. Near copies are one document there, else all words of a much repeated document would stay.

A window is one word, since a toxic word among prose saves less than prose varies by. Zstandard stores very short inputs as they are,
so windows are padded with spaces, whose length is the same for both. A window that comes again is not compressed again.

Fitting uses a bounded sample of labelled documents (`PER_CLASS`, `MAX_CHARS`); scoring reads whole texts.

Cases: a null or empty text has no window and gets the score of one window without gain. Texts of
any length are scored in all windows. Without labels of both classes every score is 0. Rows are
neither dropped nor merged; other columns stay, but a column `score` is replaced.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.llm.columns import named
from cadastra.llm.labels import Calibration, labelled_sample

#: Labelled documents of each class that are fitted to, at most, and their length.
PER_CLASS = 3_000
MAX_CHARS = 50_000
#: Words in a window, and the bytes it is padded to.
WINDOW, PADDED = 1, 64
#: Bytes of the dictionaries, at most; bytes they are trained on, and windows in one sample of it.
ORDINARY_BYTES, TOXIC_BYTES = 262_144, 16_384
TRAINING_BYTES, SAMPLE_WINDOWS = 4 << 20, 8
#: How often the toxic dictionary chooses its windows, and the gain that they must have.
ROUNDS, CHOSEN_GAIN = 2, 4
#: Parts of the labelled documents; each is scored by dictionaries trained on the others for the calibration.
FOLDS = 4
#: Gains that are told apart.
LEAST, MOST = -8, 14
#: Windows whose gain is remembered by a task, and their bytes, at most.
REMEMBERED, REMEMBERED_BYTES = 1 << 17, 64
#: Near copies share at least this part of their rows of so many words. They are looked for among texts that agree in
#: one of some bands of least hashes.
COPY_WORDS, COPY_SHARE, BANDS, BAND_HASHES = 3, 0.5, 24, 4
#: Least bytes for zstandard to train a dictionary from.
_LEAST_TRAINING = 4_096
#: Gains from 1 on whose windows are counted one by one for the calibration.
_COUNTED = 10


def windows(text: str | None) -> list[str]:
    """All words of a text, in lower case, in windows."""
    words = (text or "").lower().split()
    return words if WINDOW == 1 else [" ".join(words[i : i + WINDOW]) for i in range(0, len(words), WINDOW)]


def window_bytes(window: str) -> bytes:
    """What is compressed."""
    return f" {window} ".encode("utf-8", "replace").ljust(PADDED)


def _rows_of_words(text: str) -> frozenset[str]:
    words = text.lower().split()
    return frozenset(" ".join(words[i : i + COPY_WORDS]) for i in range(max(min(1, len(words)), len(words) - COPY_WORDS + 1)))


def copy_groups(texts: list[str]) -> list[list[str]]:
    """The texts, near copies together: whatever is in one of them is in most, so they are one witness."""
    held = [_rows_of_words(text) for text in texts]
    draw = np.random.default_rng(0)
    factor, shift = draw.integers(1, 1 << 63, (2, BANDS * BAND_HASHES, 1), dtype=np.uint64)
    factor |= np.uint64(1)
    root, first = list(range(len(texts))), {}

    def top(at: int) -> int:
        while root[at] != at:
            root[at] = at = root[root[at]]
        return at

    for at, rows in enumerate(held):
        if not rows:
            continue
        codes = np.fromiter((zlib.crc32(r.encode("utf-8", "replace")) for r in rows), np.uint64, len(rows))
        parts = np.split(codes, range(512, len(codes), 512))
        least = np.min([((part * factor + shift) >> np.uint64(20)).min(axis=1) for part in parts], axis=0)
        for band, key in enumerate(least.reshape(BANDS, BAND_HASHES)):
            other = first.setdefault((band, key.tobytes()), at)
            if top(other) != top(at) and len(rows & held[other]) >= COPY_SHARE * len(rows | held[other]):
                root[top(at)] = top(other)
    groups: dict[int, list[str]] = {}
    for at, text in enumerate(texts):
        groups.setdefault(top(at), []).append(text)
    return list(groups.values())


def _trained(chosen: list[str], size: int) -> bytes:
    """A dictionary of the windows' text."""
    chosen = list(chosen)
    random.Random(0).shuffle(chosen)
    samples, total = [], 0
    for start in range(0, len(chosen), SAMPLE_WINDOWS):
        samples.append("".join(f" {w} " for w in chosen[start : start + SAMPLE_WINDOWS]).encode("utf-8", "replace"))
        total += len(samples[-1])
        if total >= TRAINING_BYTES:
            break
    if total >= _LEAST_TRAINING and len(samples) >= 16:
        try:
            return zstandard.train_dictionary(min(size, max(512, total // 2)), samples, d=8, k=48).as_bytes()
        except zstandard.ZstdError:  # too little that repeats
            pass
    return b"".join(samples)[-size:] or b" " * 8


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    """Compresses with one dictionary alone; nothing but the content's length is in a frame's head."""
    parameters = zstandard.ZstdCompressionParameters(
        window_log=20, hash_log=17, chain_log=18, search_log=3, min_match=4, target_length=16, strategy=zstandard.STRATEGY_LAZY2,
        write_content_size=False, write_checksum=False, write_dict_id=False,
    )
    held = zstandard.ZstdCompressionDict(content)
    held.precompute_compress(compression_params=parameters)
    return zstandard.ZstdCompressor(dict_data=held, compression_params=parameters)


class Gains(dict):
    """The bytes that the toxic dictionary saves on a window, as far as remembered."""

    def __init__(self, toxic: bytes, ordinary: bytes) -> None:
        super().__init__()
        self.toxic, self.ordinary = compressor(toxic).compress, compressor(ordinary).compress

    def __missing__(self, window: str) -> int:
        content = window_bytes(window)
        gain = len(self.ordinary(content)) - len(self.toxic(content))
        if len(content) <= REMEMBERED_BYTES:
            if len(self) >= REMEMBERED:
                self.clear()
            self[window] = gain
        return gain


class Dictionaries:
    """The two dictionaries; compressors are made where they are used."""

    def __init__(self, toxic: bytes, ordinary: bytes) -> None:
        self.toxic, self.ordinary = toxic, ordinary

    def __getstate__(self) -> dict:
        return {"toxic": self.toxic, "ordinary": self.ordinary}

    def gains(self, found: list[str]) -> np.ndarray:
        """Of each window."""
        if "_gains" not in self.__dict__:
            self._gains = Gains(self.toxic, self.ordinary)
        return np.fromiter(map(self._gains.__getitem__, found), np.int64, len(found))

    def counts(self, texts: list[str | None]) -> np.ndarray:
        """A row for each text: how many of its windows have which gain, from `LEAST` or less to `MOST` or more."""
        rows = np.zeros((len(texts), MOST - LEAST + 1), np.int64)
        for at, text in enumerate(texts):
            gains = self.gains(windows(text)) if text and not text.isspace() else np.zeros(1, np.int64)
            rows[at] = np.bincount(np.clip(gains, LEAST, MOST) - LEAST, minlength=rows.shape[1])
        return rows


def statistics(counts: np.ndarray, evidence: np.ndarray) -> np.ndarray:
    """What the calibration looks at; `evidence` is what a window of each gain speaks for."""
    counts = counts.astype(float)
    n = counts.sum(axis=1, keepdims=True)
    reached = counts[:, ::-1].cumsum(axis=1)[:, ::-1][:, 1 - LEAST : 1 - LEAST + _COUNTED]
    total = (counts @ evidence)[:, None]
    return np.hstack([total, total / np.sqrt(n), np.log(n), np.sqrt(n), np.log1p(reached), reached / np.sqrt(n)])


class ToxicityModel:
    """Dictionaries, the evidence of each gain and the calibration; None for all if a class has no labels."""

    def __init__(self, dictionaries: Dictionaries | None, evidence: np.ndarray | None = None, calibration: Calibration | None = None) -> None:
        self.dictionaries, self.evidence, self.calibration = dictionaries, evidence, calibration

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.dictionaries is None or not texts:
            return np.zeros(len(texts))
        return self.calibration(statistics(self.dictionaries.counts(texts), self.evidence))


def _held(groups: list[list[str]]) -> list[list[str]]:
    """The windows of the first document of each group of near copies."""
    return [windows(group[0]) for group in groups]


def train(toxic: list[list[str]], ordinary: list[list[str]]) -> Dictionaries:
    """Dictionaries of the windows of groups of toxic and of ordinary documents."""
    plain = _trained([w for held in ordinary for w in held], ORDINARY_BYTES)
    kept = toxic
    for _ in range(ROUNDS):
        halves = [Dictionaries(_trained([w for held in kept[half::2] for w in held], TOXIC_BYTES), plain) for half in (0, 1)]
        chosen = []
        for at, held in enumerate(toxic):
            gains = halves[1 - at % 2].gains(held)
            chosen.append([w for w, gain in zip(held, gains.tolist(), strict=True) if gain >= CHOSEN_GAIN])
        if not any(chosen):
            break
        kept = chosen
    return Dictionaries(_trained([w for held in kept for w in held], TOXIC_BYTES), plain)


def fit_texts(texts: list[str], label: np.ndarray, weight: np.ndarray) -> ToxicityModel:
    """A model of labelled texts (1: toxic)."""
    at = [[i for i, y in enumerate(label) if y == c] for c in (0, 1)]
    if not all(at):
        return ToxicityModel(None)
    groups, fold = [], np.zeros(len(texts), int)
    for own in at:
        found = copy_groups([texts[i] for i in own])
        part = {text: k % FOLDS for k, group in enumerate(found) for text in group}
        fold[own] = [part[texts[i]] for i in own]
        groups.append(_held(found))
    counts = np.zeros((len(texts), MOST - LEAST + 1), np.int64)
    for k in range(FOLDS):
        ordinary, toxic = ([held for i, held in enumerate(own) if i % FOLDS != k] for own in groups)
        if rows := np.flatnonzero(fold == k).tolist():
            counts[rows] = train(toxic, ordinary).counts([texts[i] for i in rows])
    seen = [counts[label == c].sum(axis=0) + 1.0 for c in (0, 1)]
    evidence = np.log(seen[1] / seen[1].sum()) - np.log(seen[0] / seen[0].sum())
    return ToxicityModel(train(groups[1], groups[0]), evidence, Calibration(statistics(counts, evidence), label, weight))


def fit(docs: DataFrame, labels: DataFrame, folds: int, fold: int, target: str = "toxic", text: str = "text") -> ToxicityModel:
    """Fit to the labelled documents outside the held-out fold."""
    sample, weights = labelled_sample(docs, labels, target, folds, fold, PER_CLASS, MAX_CHARS, text=text)
    rows = sample.select("text", "_label").toPandas().sort_values(["text", "_label"])
    label = rows["_label"].to_numpy()
    return fit_texts(list(rows["text"]), label, np.array([weights[y] for y in label], float))


def score(text: Column, model: ToxicityModel) -> Column:
    """Probability that the text is toxic, between 0 and 1."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(model.scores(list(batch)))

    return scored(text)


def score_documents(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """`docs` with `score`."""
    return docs.withColumn("score", score(named(text), model))
