"""Byte-level BPE: whole texts to token ids with tiktoken, and ids back to raw bytes.

The rank file is local to every executor; its path is a parameter. The pattern that
splits a text into pieces is a parameter too, and every match is merged separately.

Long texts are cut before they reach tiktoken. A cut between a character that is not
white space and one that is never lies inside a match of the pattern: no alternative
goes on from the former to the latter, and none looks back. So the pieces, and with
them the ids, are those of the whole text. A run of white space too long for the
pattern's look-ahead is taken out by the same rule: all of it but the last character,
or all of it at the end of a text, is one match, and is merged as one piece.

Cases: a null text is read as empty; an empty text has no ids and decodes to no bytes.
Rows are neither dropped nor merged, whatever repeats; all other columns stay, but a
column that has the name of an output is replaced.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.llm.columns import Aside

#: Characters after which a text is cut at the next safe place.
CUT_AFTER = 65_536
#: White space in a row that is not left to the pattern.
LONG_RUN = 2_048

#: Ids that a task holds before it hands them on.
IDS_AT_ONCE = 1 << 20

_BOUNDARY = regex.compile(r"(?<=\P{White_Space})(?=\p{White_Space})")
_RUN = regex.compile(rf"\p{{White_Space}}{{{LONG_RUN},}}")


def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    """The tokenizer of a rank file."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _chunks(text: str) -> Iterator[str]:
    start = 0
    while len(text) - start > CUT_AFTER:
        cut = _BOUNDARY.search(text, start + CUT_AFTER)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode_text(text: str, tokenizer: tiktoken.Encoding) -> np.ndarray:
    """Ids of a whole text, without special tokens."""
    if len(text) <= LONG_RUN:
        return np.array(tokenizer.encode_ordinary(text), np.int32)
    parts, start = [], 0

    def ordinary(piece: str) -> None:
        parts.extend(np.array(tokenizer.encode_ordinary(chunk), np.int32) for chunk in _chunks(piece))

    for run in _RUN.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        ordinary(text[start : run.start()])
        parts.append(np.array(tokenizer._encode_single_piece(text[run.start() : end]), np.int32))
        start = end
    ordinary(text[start:])
    return np.concatenate(parts)


def decode_ids(ids: np.ndarray, tokenizer: tiktoken.Encoding) -> bytes:
    """Raw bytes: ids that end inside a character are not repaired."""
    return tokenizer.decode_bytes(ids.tolist())


def encode_and_decode(text: Column, path: str, pattern: str) -> Column:
    """A struct of the text's `ids` and the `decoded` bytes of these ids."""

    @F.pandas_udf("ids array<int>, decoded binary")
    def both(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tokenizer = encoding(path, pattern)
        for batch in texts:
            ids, decoded, held = [], [], 0
            for at, value in enumerate(batch, 1):
                ids.append(encode_text(value or "", tokenizer))
                decoded.append(decode_ids(ids[-1], tokenizer))
                held += len(ids[-1])
                if held >= IDS_AT_ONCE or at == len(batch):
                    yield pd.DataFrame({"ids": ids, "decoded": decoded})
                    ids, decoded, held = [], [], 0

    return both(text)


def tokenize(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """`docs` with `token_ids` (array of int) and `decoded` (binary)."""
    aside = Aside(docs)
    rows = aside.frame.withColumn("both", encode_and_decode(aside[text], path, pattern))
    return aside.back(rows.select("*", F.col("both.ids").alias("token_ids"), F.col("both.decoded").alias("decoded")), ("token_ids", "decoded"))


def token_digests() -> list[Column]:
    """Of tokenized rows: count and digests that identify ids and bytes."""
    return [
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    ]
