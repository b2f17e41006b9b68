"""Alignment of two tokenizers over the same texts, merged in lockstep.

Both tokenizations of a text are rows of byte offsets over the same bytes. One state vector holds a pointer
into A's and one into B's tokens for every document of a batch; each step links the tokens that the pointers
stand at, records a cut where both end at the same byte, and advances the pointer (or both) whose token ends
first. Documents that are through leave the vector. A long document enters as several lanes that begin where
tokens of both end together, so no step waits for one document. A batch is a bounded number of tokens, so a
worker holds the links of a few hundred documents at most, and of the rest only which pairs each document has.

How many documents hold a pair of ids linked is counted over all documents. Documents are kept in blocks of a
bounded number of links. A block names each of its pairs once, with the number of its documents that hold the
pair; these rows are summed by pair, and the sums go back to the blocks. So what is shuffled are the distinct
pairs of blocks, and no task holds the corpus' pairs. Which pairs a document holds travels compressed, since
the rows of whole blocks would else fill the memory of those who sort and shuffle them.

Tokenizer A is byte-level BPE from a `tokenizers` file; where its merges stand in the order of their ids, which
is checked, tiktoken merges by them. Tokenizer B is a sentencepiece model. The files' paths are parameters.

Cases: a text that is null or empty, or whose tokens of A or B do not join to the same bytes (a space and the
text), has no tokens: zeros, empty arrays, and '' for the digest. Repeated rows are documents of their own. Texts of any
length are encoded whole. Null ids stay. An empty table gives an empty result. `align` keeps all other columns
but those with the name of an output, which are replaced; `summarize` returns the id and its own columns only.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cadastra.llm.bpe import encode_text
from cadastra.llm.columns import Aside, named
from cadastra.scratch import new_folder

#: Tokens of both sides in one block, unless one document has more.
BLOCK_TOKENS = 1 << 21
#: Documents of a block, about, however few tokens they have.
BLOCK_DOCS = 10_000
#: Tokens of both sides that are aligned at once, unless one document has more.
PIECE_TOKENS = 1 << 18
#: Tokens of A in one lane, about.
LANE_TOKENS = 256
#: A pair of ids as one number: the id of A above the bits of that of B.
_SHIFT = 32

_OUTPUTS = ("a_ids", "b_ids", "a_ends", "b_ends", "a_cuts", "b_cuts", "a_linked", "b_linked")
_BLOCK = (
    "block long, docs array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "groups array<string>, pair array<long>, held array<int>, distinct array<int>, step binary, times binary"
)
_BLOCK_ARROW = pa.schema(
    [
        ("block", pa.int64()), *((name, pa.list_(pa.int64())) for name in ("docs", "n_a", "n_b", "n_groups", "n_links")),
        ("groups", pa.list_(pa.string())), ("pair", pa.list_(pa.int64())), ("held", pa.list_(pa.int32())),
        ("distinct", pa.list_(pa.int32())), ("step", pa.binary()), ("times", pa.binary()),
    ]
)
SUMMARY = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


def _byte_characters() -> dict[str, int]:
    """The byte for each character of a byte-level vocabulary: printable ones are themselves, others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in set(plain)]
    return {chr(c): byte for c, byte in [*((b, b) for b in plain), *((256 + i, b) for i, b in enumerate(others))]}


class ByteLevelTokenizer:
    """Tokenizer A: ids of a space and the text, and the bytes of each id."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        vocabulary, merges = content["model"]["vocab"], content["model"]["merges"]
        special = {token["content"] for token in content.get("added_tokens", ())}
        byte = _byte_characters()
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            if token not in special:
                self.bytes[number] = bytes(byte[c] for c in token)
        merged = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in merges]
        ordered = merged == list(range(len(vocabulary) - len(merged), len(vocabulary))) and not special & vocabulary.keys()
        self.slow = self.fast = None
        if ordered:
            ranks = {token: number for number, token in enumerate(self.bytes)}
            self.fast = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        else:
            self.slow = Tokenizer.from_file(path)
            self.slow.encode_special_tokens = True

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if self.fast is not None:
            return [encode_text(" " + text, self.fast) for text in texts]
        return [np.array(self.slow.encode(" " + text, add_special_tokens=False).ids, np.int32) for text in texts]


class PieceTokenizer:
    """Tokenizer B: it puts the space before the text itself."""

    def __init__(self, path: str) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [
            bytes([int(p[3:5], 16)]) if re.fullmatch(r"<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in pieces
        ]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int32) for ids in self.model.encode(texts, num_threads=1)] if texts else []


@dataclass
class Aligned:
    """The documents of a batch, their tokens in a row: `a_first` and `b_first` are where each document's begin."""

    a_ids: np.ndarray
    b_ids: np.ndarray
    a_end: np.ndarray
    b_end: np.ndarray
    a_first: np.ndarray
    b_first: np.ndarray
    a_cut: np.ndarray
    b_cut: np.ndarray
    a_link: np.ndarray
    b_link: np.ndarray


def lockstep(
    a_end: np.ndarray, b_end: np.ndarray, a_first: np.ndarray, b_first: np.ndarray, lane_tokens: int = LANE_TOKENS
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(a_link, b_link, a_cut, b_cut): linked positions, in no order, and positions after each cut, in order.

    `a_end` and `b_end` are the ends in bytes, from 0 for each document; the last ones of a document are equal.
    """
    at_a, at_b, stop = [], [], []
    for i in np.flatnonzero(np.diff(a_first)):
        low, high, other = a_first[i], a_first[i + 1], b_first[i]
        starts = np.array([low])
        if high - low > 2 * lane_tokens:
            _, own, both = np.intersect1d(a_end[low:high], b_end[other : b_first[i + 1]], assume_unique=True, return_indices=True)
            marks = np.unique(np.searchsorted(own, np.arange(lane_tokens, high - low, lane_tokens)).clip(max=len(own) - 1))
            marks = marks[own[marks] < high - low - 1]
            starts = np.append(low, low + own[marks] + 1)
            at_b.append(np.append(other, other + both[marks] + 1))
        else:
            at_b.append(np.array([other]))
        at_a.append(starts)
        stop.append(np.append(starts[1:], high))
    if not at_a:
        return (np.zeros(0, np.int64),) * 4
    at_a, at_b, stop = (np.concatenate(x).astype(np.int64) for x in (at_a, at_b, stop))
    a_link, b_link = np.empty((2, len(a_end) + len(b_end)), np.int64)
    a_cut, b_cut, done = [], [], 0
    while len(at_a):
        size = len(at_a)
        a_link[done : done + size], b_link[done : done + size] = at_a, at_b
        done += size
        own, other = a_end[at_a], b_end[at_b]
        at_a = at_a + (own <= other)
        at_b = at_b + (other <= own)
        cut = own == other
        a_cut.append(at_a[cut])
        b_cut.append(at_b[cut])
        alive = at_a < stop
        if not alive.all():
            at_a, at_b, stop = at_a[alive], at_b[alive], stop[alive]
    return a_link[:done], b_link[:done], np.sort(np.concatenate(a_cut)), np.sort(np.concatenate(b_cut))


def align_texts(texts: Iterable[str | None], a: ByteLevelTokenizer, b: PieceTokenizer) -> Iterator[tuple[range, Aligned]]:
    """Pieces of neighbouring texts: which they are, and their alignment."""
    sides = [np.array(side.bytes, dtype=object) for side in (a, b)]
    sizes = [np.array([len(token) for token in side.bytes]) for side in (a, b)]
    none, most = (np.zeros(0, np.int32),) * 2, min(PIECE_TOKENS, BLOCK_TOKENS)
    start, tokens, held = 0, 0, []
    for text in texts:
        pair = (a.encode([text])[0], b.encode([text])[0]) if text else none
        held.append(pair if not text or _whole(text, pair, sides) else none)
        tokens += len(held[-1][0]) + len(held[-1][1])
        if tokens >= most:
            yield range(start, start + len(held)), _aligned(held, sizes)
            start, tokens, held = start + len(held), 0, []
    if held:
        yield range(start, start + len(held)), _aligned(held, sizes)


def _whole(text: str, pair: tuple[np.ndarray, np.ndarray], sides: list[np.ndarray]) -> bool:
    """Whether the tokens of both sides join to a space and the text."""
    wanted = (" " + text).encode("utf-8", "replace")
    return all(b"".join(side[ids].tolist()) == wanted for side, ids in zip(sides, pair, strict=True))


def _aligned(held: list[tuple[np.ndarray, np.ndarray]], sizes: list[np.ndarray]) -> Aligned:
    parts = []
    for k, size in enumerate(sizes):
        ids = np.concatenate([pair[k] for pair in held]).astype(np.int64)
        first = np.concatenate([[0], np.cumsum([len(pair[k]) for pair in held])])
        total = np.concatenate([[0], np.cumsum(size[ids])])
        parts.append((ids, total[1:] - np.repeat(total[first[:-1]], np.diff(first)), first))
    (a_ids, a_end, a_first), (b_ids, b_end, b_first) = parts
    a_link, b_link, a_cut, b_cut = lockstep(a_end, b_end, a_first, b_first)
    return Aligned(a_ids, b_ids, a_end, b_end, a_first, b_first, a_cut, b_cut, a_link, b_link)


def group_texts(x: Aligned, a_words: np.ndarray, b_words: np.ndarray) -> list[bytes]:
    """`a1,a2|b1;a3|b2` of each document; `a_words` are decimal ids before ',' and then before '|', `b_words` before ',' and ';'."""
    a_before, b_before = np.append(0, x.a_cut[:-1]), np.append(0, x.b_cut[:-1])
    place_a = np.arange(len(x.a_ids)) + np.repeat(b_before, x.a_cut - a_before) if len(x.a_cut) else np.zeros(0, int)
    place_b = np.arange(len(x.b_ids)) + np.repeat(x.a_cut, x.b_cut - b_before) if len(x.a_cut) else np.zeros(0, int)
    last_a, last_b = np.zeros(len(x.a_ids), bool), np.zeros(len(x.b_ids), bool)
    last_a[x.a_cut - 1] = last_b[x.b_cut - 1] = True
    words = np.empty(len(x.a_ids) + len(x.b_ids), dtype=object)
    words[place_a] = a_words[x.a_ids + last_a * (len(a_words) // 2)]
    words[place_b] = b_words[x.b_ids + last_b * (len(b_words) // 2)]
    words = words.tolist()
    first = x.a_first + x.b_first
    return [b"".join(words[low:high])[:-1] for low, high in zip(first, first[1:], strict=False)]


def _tokenizers(a_path: str, pattern: str, b_path: str) -> tuple[ByteLevelTokenizer, PieceTokenizer]:
    return ByteLevelTokenizer(a_path, pattern), PieceTokenizer(b_path)


def _parts(x: Aligned, order: np.ndarray) -> list[dict]:
    a_of_cut, a_of_link = np.searchsorted(x.a_cut, x.a_first, "right"), np.searchsorted(x.a_link[order], x.a_first)
    a_link, b_link = x.a_link[order], x.b_link[order]
    rows = []
    for i in range(len(x.a_first) - 1):
        a, b = slice(*x.a_first[i : i + 2]), slice(*x.b_first[i : i + 2])
        cut, link = slice(*a_of_cut[i : i + 2]), slice(*a_of_link[i : i + 2])
        values = (
            x.a_ids[a], x.b_ids[b], x.a_end[a], x.b_end[b],
            x.a_cut[cut] - a.start, x.b_cut[cut] - b.start, a_link[link] - a.start, b_link[link] - b.start,
        )
        rows.append({name: value.tolist() for name, value in zip(_OUTPUTS, values, strict=True)})
    return rows


def align(docs: DataFrame, a_path: str, pattern: str, b_path: str, text: str = "text") -> DataFrame:
    """`docs` with the ids and ends in bytes of both sides' tokens, the numbers of tokens before the end of each
    group, and the positions of linked tokens, in order."""

    @F.pandas_udf(", ".join(f"{name} array<long>" for name in _OUTPUTS))
    def aligned(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        a, b = _tokenizers(a_path, pattern, b_path)
        for batch in batches:
            for _, x in align_texts(list(batch), a, b):
                yield pd.DataFrame(_parts(x, np.argsort(x.a_link + x.b_link)), columns=list(_OUTPUTS))

    aside = Aside(docs)
    rows = aside.frame.withColumn("found", aligned(aside[text]))
    return aside.back(rows.select("*", "found.*"), _OUTPUTS)


def _packed(values: np.ndarray) -> bytes:
    """Numbers of 32 bits, compressed: their lowest bytes first, then the next ones."""
    return zstandard.compress(values.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpacked(content: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(content), np.uint8).reshape(4, -1).T.copy().view("<i4").ravel()


def _counted(x: Aligned, words: tuple[np.ndarray, np.ndarray]) -> dict[str, np.ndarray]:
    """Counts of each document of a piece, and its distinct pairs with the number of links of each, document by document."""
    size = len(x.a_first) - 1
    a_of = np.repeat(np.arange(size), np.diff(x.a_first))
    found, pair = pd.factorize((x.a_ids[x.a_link] << _SHIFT) | x.b_ids[x.b_link])
    owner = a_of[x.a_link]
    key, times = np.unique(owner * max(1, len(pair)) + found, return_counts=True)
    texts = group_texts(x, *words)
    return {
        "n_a": np.diff(x.a_first), "n_b": np.diff(x.b_first),
        "n_groups": np.bincount(a_of[x.a_cut - 1], minlength=size), "n_links": np.bincount(owner, minlength=size),
        "groups": np.array([hashlib.sha256(t).hexdigest() if t else "" for t in texts], dtype=object),
        "distinct": np.bincount(key // max(1, len(pair)), minlength=size),
        "pairs": pair[key % max(1, len(pair))], "times": times,
    }


def _block(number: int, doc_ids: list, pieces: list[dict[str, np.ndarray]]) -> dict:
    """The row of a block: counts of its documents, its pairs from frequent to rare, and which of them each document holds."""
    whole = {name: np.concatenate([piece[name] for piece in pieces]) for name in pieces[0]}
    distinct, times = whole["distinct"], whole["times"]
    found, pair = pd.factorize(whole.pop("pairs"))
    order = np.argsort(-np.bincount(found, times, minlength=len(pair)), kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    at = rank[found]
    inside = np.argsort(np.repeat(np.arange(len(doc_ids)), distinct) * max(1, len(pair)) + at)
    at, times = at[inside], times[inside]
    step = np.diff(at, prepend=0)
    heads = (np.cumsum(distinct) - distinct)[distinct > 0]
    step[heads] = at[heads]
    return whole | {
        "block": number, "docs": doc_ids, "pair": pair[order], "held": np.bincount(at, minlength=len(pair)).astype(np.int32),
        "distinct": distinct.astype(np.int32), "step": _packed(step), "times": _packed(times),
    }


def _blocks(docs: DataFrame, a_path: str, pattern: str, b_path: str, text: str, doc_id: str) -> DataFrame:
    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _tokenizers(a_path, pattern, b_path)
        words = tuple(
            np.array([b"%d%s" % (i, end) for end in ends for i in range(len(side.bytes))], dtype=object)
            for side, ends in ((a, (b",", b"|")), (b, (b",", b";")))
        )
        number, ids, pieces, tokens = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            batch_ids = batch.column(0).to_pylist()
            for rows, x in align_texts((value.as_py() for value in batch.column(1)), a, b):
                ids += batch_ids[rows.start : rows.stop]
                pieces.append(_counted(x, words))
                tokens += len(x.a_ids) + len(x.b_ids)
                if tokens >= BLOCK_TOKENS or len(ids) >= BLOCK_DOCS:
                    yield pa.RecordBatch.from_pylist([_block(number, ids, pieces)], _BLOCK_ARROW)
                    number, ids, pieces, tokens = number + 1, [], [], 0
            del batch  # before the next one is read
        if ids:
            yield pa.RecordBatch.from_pylist([_block(number, ids, pieces)], _BLOCK_ARROW)

    rows = docs.select(named(doc_id).cast("long").alias("doc_id"), named(text).alias("text"))
    return rows.mapInArrow(block, _BLOCK)


def summarize(docs: DataFrame, a_path: str, pattern: str, b_path: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The columns of `SUMMARY`, a row for each row of `docs`.

    `n_best` are links whose pair is held by as many documents as any pair of its id of A; `count_sum` is the sum over
    all links of the documents that hold the pair.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "aligned")
    _blocks(docs, a_path, pattern, b_path, text, doc_id).write.option("compression", "zstd").parquet(folder)
    blocks = spark.read.schema(_BLOCK).parquet(folder)
    pairs = blocks.select("block", F.posexplode(F.arrays_zip("pair", "held")).alias("at", "own"))
    pairs = pairs.select("block", "at", F.col("own.pair").alias("pair"), F.col("own.held").alias("held"))
    path = new_folder(spark, "pairs")
    pairs.groupBy("pair").agg(F.sum("held").alias("n")).write.parquet(path)
    counts = spark.read.schema("pair long, n long").parquet(path)
    of_a = F.shiftright("pair", _SHIFT).alias("a")
    best = counts.groupBy(of_a).agg(F.max("n").alias("most"))  # a row for each id of A's vocabulary, at most
    counts = counts.join(F.broadcast(best), of_a == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    known = pairs.select("block", "at", "pair").join(counts, "pair").select("block", "at", "n", "best")

    def total(block: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        out = []
        count, best = np.zeros(len(known), np.int64), np.zeros(len(known), np.int64)
        count[known["at"]], best[known["at"]] = known["n"], known["best"]
        for row in block.itertuples(index=False):
            distinct, step, times = np.asarray(row.distinct, np.int64), _unpacked(row.step), _unpacked(row.times)
            heads = np.cumsum(distinct) - distinct
            run = np.cumsum(step, dtype=np.int64)
            before = np.where(heads > 0, run[heads - 1], 0) if len(run) else np.zeros(len(heads), np.int64)
            at = run - np.repeat(before, distinct)
            sums = []
            for value in (best, count):
                sofar = np.append(0, np.cumsum(value[at] * times))
                sums.append(sofar[heads + distinct] - sofar[heads])
            out.append(pd.DataFrame({
                "doc_id": pd.array(row.docs, dtype="object"), "n_a": row.n_a, "n_b": row.n_b, "n_groups": row.n_groups, "n_links": row.n_links,
                "n_best": sums[0], "count_sum": sums[1], "groups_sha256": row.groups,
            }))
        return pd.concat(out).astype({"doc_id": "Int64"}) if out else pd.DataFrame(columns=[c.split()[0] for c in SUMMARY.split(", ")])

    held = spark.read.schema(_BLOCK).parquet(folder).drop("pair", "held")
    return held.groupBy("block").cogroup(known.groupBy("block")).applyInPandas(total, SUMMARY)
