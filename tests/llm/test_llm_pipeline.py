from __future__ import annotations

import __spark_entry__
import corpus_pipeline
import public_tokenizers
import pytest

from cadastra.llm import bpe, decontaminate, queries, simhash_dups

SF = "/root/testdata/sf0.01"


def test_stages_take_effect_and_keep_the_columns(spark):
    docs = queries.table(spark, SF, "documents")
    columns = docs.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "quality", "near_duplicates", "decontamination", "tokens"]
    toxic = {r["doc_id"] for r in queries.op3_toxicity_zstd(spark, SF).where("predicted = 1").collect()}
    ids = {r["doc_id"] for r in docs.collect()}
    steps = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns
        steps.append((before, docs, {r["doc_id"] for r in docs.collect()}))
    assert steps[0][2] == ids - toxic and toxic
    assert steps[1][2] < steps[0][2]
    near = simhash_dups.near_duplicates(steps[2][0], queries.SHINGLE_WORDS, queries.MAX_BITS).collect()
    assert steps[2][2] == {r["component_id"] for r in near} < steps[1][2]
    found = decontaminate.find_copies(steps[3][0], queries.table(spark, SF, "benchmark")).collect()
    assert steps[3][2] == steps[2][2] - {r["doc_id"] for r in found} and found
    final = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    tokenizer = bpe.encoding(public_tokenizers.path(queries.RANK_FILE), public_tokenizers.PATTERN)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert len(final) == len(texts)
    for r in final:
        assert r["token_ids"] == tokenizer.encode_ordinary(texts[r["doc_id"]])


@pytest.mark.parametrize("stage", range(5))
def test_stages_of_odd_documents(spark, stage):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, "word " * 60_000, "en", "s", 5), (2, "word " * 60_000, "en", "s", 5), (3, None, None, "s", -4)]
    docs = spark.createDataFrame(rows, schema)
    run = corpus_pipeline.STAGES[stage][1]
    got = run(spark, docs, SF)
    assert got.count() <= len(rows) and (stage == 4 or got.columns == docs.columns)
    assert run(spark, docs.limit(0), SF).collect() == []


def test_registered_queries():
    names = list(__spark_entry__.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))
