from __future__ import annotations

import hashlib

import public_tokenizers
import pytest

from cadastra.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def tokenizer():
    return bpe.encoding(PATH, public_tokenizers.PATTERN)


TEXTS = [
    "", " ", "Hello world", "it's  we've\n\n x ", "Grüße — 你好 🙂🙃", "a\x00b\x1c\x1d c 　d  e", "<|endoftext|>", "1234567890 12a34",
    "word " * 40_000, "x" * 100_000, "tab\t\tnew\r\nline " * 9_000, "é́" * 5_000, "no-space." * 20_000,
]


@pytest.mark.parametrize("text", TEXTS, ids=range(len(TEXTS)))
def test_ids_are_those_of_the_whole_text(tokenizer, text):
    ids = bpe.encode_text(text, tokenizer)
    assert ids.tolist() == tokenizer.encode_ordinary(text)
    assert bpe.decode_ids(ids, tokenizer) == text.encode()


@pytest.mark.parametrize("text", [" " * 3_000, "a" + " " * 3_000 + "b", "\n" * 2_500 + " x", "a" + " \t" * 2_000, "　" * 2_100 + "q" + " " * 2_048 + "."])
def test_long_white_space_is_one_match(tokenizer, text):
    assert bpe.encode_text(text, tokenizer).tolist() == tokenizer.encode_ordinary(text)


def test_white_space_beyond_the_pattern_engine(tokenizer):
    text = "a" + " " * 1_500_000 + "b " + "\n" * 1_500_000
    assert bpe.decode_ids(bpe.encode_text(text, tokenizer), tokenizer) == text.encode()


def test_small_cuts_change_nothing(tokenizer, monkeypatch):
    monkeypatch.setattr(bpe, "CUT_AFTER", 5)
    monkeypatch.setattr(bpe, "LONG_RUN", 3)
    for text in TEXTS[:8] + ["  a   b\t\tc \n d's x've " * 50]:
        assert bpe.encode_text(text, tokenizer).tolist() == tokenizer.encode_ordinary(text)


def test_tables(spark, tokenizer):
    rows = [(1, "Hello world", 5), (None, None, None), (2, "", 1), (1, "Hello world", 5), (3, "long " * 100_000, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, token_ids int")
    got = bpe.tokenize(docs, PATH, public_tokenizers.PATTERN)
    assert got.columns == ["doc_id", "text", "token_ids", "decoded"]
    got = got.select("doc_id", "text", *bpe.token_digests()).collect()
    assert len(got) == 5
    for r in got:
        ids = tokenizer.encode_ordinary(r["text"] or "")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
    assert bpe.tokenize(docs.limit(0), PATH, public_tokenizers.PATTERN).collect() == []
