"""Every operator with columns that have the names it uses inside: none crashes, none changes their values."""

from __future__ import annotations

import ast
import inspect
import keyword

import corpus_pipeline
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from cadastra.llm import (
    bpe,
    columns,
    components,
    decontaminate,
    embedding_dups,
    hard_negatives,
    html_extract,
    labels,
    language_id,
    licenses,
    quality_fm,
    queries,
    sharding,
    simhash_dups,
    tokenizer_alignment,
    toxicity_zstd,
    warc,
)

SF = "/root/testdata/sf0.001"
TOKENIZERS = P.path(queries.BYTE_FILE), P.PATTERN, P.path(queries.PIECE_FILE)
NEGATIVES = lambda rows: hard_negatives.mine(rows, F.col("vec_id") % 50 == 0)


def names_in(*modules):
    """Whatever these modules say in quotes that may be the name of a column, and names that they may make."""
    found = {"a.b", "x y", "in_0", "in_1"}
    for module in modules:
        for node in ast.walk(ast.parse(inspect.getsource(module))):
            if isinstance(node, ast.Constant) and isinstance(node.value, str):
                found |= {part.strip(",") for part in node.value.split() if part.strip(",").isidentifier()} if len(node.value) < 300 else set()
    return sorted(n for n in found if not keyword.iskeyword(n) and len(n) < 30)


def labelled(fit, score):
    def run(rows):
        return score(rows, fit(rows, queries.table(rows.sparkSession, SF, "labels"), 5, 0))

    return run


#: (table, modules, function, names of the outputs, whether all rows and columns come back)
CASES = {
    "quality": ("documents", (quality_fm, labels), labelled(quality_fm.fit, quality_fm.score_documents), ["score"], True),
    "toxicity": ("documents", (toxicity_zstd, labels), labelled(toxicity_zstd.fit, toxicity_zstd.score_documents), ["score"], True),
    "decontaminate": ("documents", (decontaminate,), lambda r: decontaminate.find_copies(r, queries.table(r.sparkSession, SF, "benchmark")), [], False),
    "sharding": ("documents", (sharding,), lambda r: sharding.assign(r, 5), ["size", "text_crc32", "shard", "slot"], True),
    "html": ("pages", (html_extract,), lambda r: html_extract.extract(r, html_extract.learn_weights(r)), ["text", "n_chars"], True),
    "bpe": ("documents", (bpe,), lambda r: bpe.tokenize(r, P.path(queries.RANK_FILE), P.PATTERN), ["token_ids", "decoded"], True),
    "embeddings": ("embeddings", (embedding_dups, components), lambda r: embedding_dups.near_duplicates(r, 0.93), ["n_links", "component_id", "kept"], True),
    "simhash": ("documents", (simhash_dups, components), lambda r: simhash_dups.near_duplicates(r, 3, 2), ["fingerprint", "component_id"], True),
    "licenses": ("documents", (licenses,), licenses.scan, [], False),
    "negatives": ("embeddings", (hard_negatives,), NEGATIVES, [], False),
    "language": ("documents", (language_id, labels), lambda r: language_id.identify(r, language_id.fit(r, 5, 0)), ["lang_pred", "score"], True),
    "alignment": ("documents", (tokenizer_alignment,), lambda r: tokenizer_alignment.align(r, *TOKENIZERS), list(tokenizer_alignment._OUTPUTS), True),
    "alignment_sums": ("documents", (tokenizer_alignment,), lambda r: tokenizer_alignment.summarize(r, *TOKENIZERS), [], False),
}


@pytest.mark.parametrize("case", CASES)
def test_operators(spark, case):
    table, modules, run, outputs, kept = CASES[case]
    rows = queries.table(spark, SF, table)
    own = {c.lower() for c in rows.columns}
    extra = []
    for name in [*names_in(*modules, columns), *outputs]:
        if name.lower() not in own:
            own.add(name.lower())
            extra.append(name)
    wide = rows.select("*", *(F.lit(f"kept {i}").alias(name) for i, name in enumerate(extra)))
    got, want = run(wide), run(rows)
    assert sorted(map(repr, got.select(*(columns.named(c) for c in want.columns)).collect())) == sorted(map(repr, want.collect()))
    if kept:
        left = [name for name in extra if name not in outputs]
        assert set(left) <= set(got.columns) and got.columns[-len(outputs):] == outputs or set(outputs) <= set(got.columns)
        values = got.select(*(columns.named(n) for n in left)).distinct().collect()
        assert [tuple(r) for r in values] == [tuple(f"kept {extra.index(n)}" for n in left)]


@pytest.mark.parametrize("stage", range(4))
def test_stages(spark, stage):
    rows = queries.table(spark, SF, "documents")
    own = {c.lower() for c in rows.columns}
    extra = [n for n in names_in(columns, components, decontaminate, labels, quality_fm, queries, simhash_dups, toxicity_zstd, corpus_pipeline) if n.lower() not in own]
    extra = list({n.lower(): n for n in extra}.values())
    run = corpus_pipeline.STAGES[stage][1]
    got = run(spark, rows.select("*", *(F.lit(f"kept {i}").alias(n) for i, n in enumerate(extra))), SF)
    assert got.columns == [*rows.columns, *extra]
    assert {tuple(r) for r in got.select(*map(columns.named, extra)).collect()} == {tuple(f"kept {i}" for i in range(len(extra)))}
    ids = lambda found: sorted(r["doc_id"] for r in found.select("doc_id").collect())
    assert ids(got) == ids(run(spark, rows, SF))


def test_archives(spark, tmp_path):
    rows = queries.table(spark, SF, "pages")
    extra = [n for n in names_in(warc) if n.lower() not in {c.lower() for c in rows.columns}]
    wide = rows.select("*", *(F.lit("x").alias(n) for n in {n.lower(): n for n in extra}.values()))
    found = []
    for name, frame in (("wide", wide), ("plain", rows)):
        warc.write_archives(frame, str(tmp_path / name))
        found.append(sorted(map(repr, warc.read_archives(spark, str(tmp_path / name)).collect())))
    assert found[0] == found[1]
