from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from cadastra.llm import quality_fm, toxicity_zstd
from cadastra.llm.labels import held_out, labelled_sample

SF = "/root/testdata/sf0.01"


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(len(score))
    ones = label.sum()
    return (rank[label == 1].sum() - ones * (ones - 1) / 2) / ones / (len(label) - ones)


def toxic_corpus(n, rng):
    words = [a + b for a in ("th", "er", "an", "in", "on", "re") for b in ("the", "ing", "ed", "ou", "ly", "at")]
    texts, label = [], []
    for i in range(n):
        body = rng.choices(words, k=rng.randint(40, 300))
        if i % 4 == 0:
            body = [rng.choice(["vilefool", "dimwitted", "scoundrel"]) if rng.random() < 0.15 else w for w in body]
        texts.append(" ".join(body))
        label.append(int(i % 4 == 0))
    return texts, np.array(label)


def test_toxicity_on_unseen_texts():
    texts, label = toxic_corpus(600, random.Random(0))
    model = toxicity_zstd.fit_texts(texts, label, np.ones(len(label)))
    texts, label = toxic_corpus(300, random.Random(1))
    score = model.scores(texts)
    assert auc(score, label) > 0.97 and (score[label == 1] >= 0.3).mean() > 0.9 and (score[label == 0] < 0.3).mean() > 0.95


def test_more_labels_keep_rare_words_and_near_copies_are_no_evidence():
    """The same share of toxic documents holds the word, whatever their number."""
    rng = random.Random(4)
    words = [a + b for a in ("th", "er", "an", "in", "on", "re") for b in ("the", "ing", "ed", "ou", "ly", "at")]
    plain = lambda: " ".join(rng.choices(words, k=25))
    ordinary = [[w for w in plain().split()] for _ in range(2_000)]
    for n in (300, 1_000, 2_000):
        toxic = [plain() + (" qqvilexword" if i % 25 == 0 else "") for i in range(n)]
        assert b"vilexword" in toxicity_zstd.train([t.split() for t in toxic], ordinary).toxic
    copied = plain() + " zzcopyzword"
    toxic += [copied + f" {w}" for w in words[:30]]
    groups = toxicity_zstd.copy_groups(toxic)
    assert len(groups) < len(toxic) - 20
    assert b"zcopyzw" not in toxicity_zstd.train(toxicity_zstd._held(groups), ordinary).toxic


@pytest.fixture(scope="module")
def toxicity_model():
    texts, label = toxic_corpus(400, random.Random(2))
    return toxicity_zstd.fit_texts(texts, label, np.ones(len(label)))


ODD_TEXTS = [None, "", " ", "a", "vilefool " * 3, "x" * 5_000, "ñ ß 漢字", "the scoundrel\nthing\tdimwitted", "word " * 50_000]


def test_scores_equal_plain_compression_window_by_window(toxicity_model):
    import zstandard

    held = toxicity_model.dictionaries

    def length(content, window):
        own = zstandard.ZstdCompressionDict(content)
        parameters = zstandard.ZstdCompressionParameters(
            window_log=20, hash_log=17, chain_log=18, search_log=3, min_match=4, target_length=16, strategy=zstandard.STRATEGY_LAZY2,
            write_content_size=False, write_checksum=False, write_dict_id=False,
        )
        own.precompute_compress(compression_params=parameters)
        frame = zstandard.ZstdCompressor(dict_data=own, compression_params=parameters).compress(window)
        assert zstandard.ZstdDecompressor(dict_data=own).decompress(frame, max_output_size=1 << 20) == window
        return len(frame)

    for text in ODD_TEXTS:
        known, gains = {}, []
        for word in (text or "").lower().split():
            if word not in known:
                window = f" {word} ".encode().ljust(64)
                known[word] = length(held.ordinary, window) - length(held.toxic, window)
            gains.append(known[word])
        row = [0] * (toxicity_zstd.MOST - toxicity_zstd.LEAST + 1)
        for gain in gains or [0]:
            row[min(max(gain, toxicity_zstd.LEAST), toxicity_zstd.MOST) - toxicity_zstd.LEAST] += 1
        want = toxicity_model.calibration(toxicity_zstd.statistics(np.array([row]), toxicity_model.evidence))
        assert toxicity_model.scores([text])[0] == want[0]


def test_a_score_is_a_function_of_the_two_lengths(toxicity_model, monkeypatch):
    """With other compressors the score follows their lengths, whatever the words are; their order does not matter."""
    held = toxicity_zstd.Dictionaries(b"1", b"2")
    longer = {b"1": 0, b"2": 0}

    class Fake:
        def __init__(self, content):
            self.content = content

        def compress(self, window):
            return b"x" * (20 + longer[self.content] * (b"q" in window))

    monkeypatch.setattr(toxicity_zstd, "compressor", Fake)
    model = toxicity_zstd.ToxicityModel(held, toxicity_model.evidence, toxicity_model.calibration)
    low = model.scores(["vilefool scoundrel", "the thing"])
    assert low[0] == low[1]
    longer[b"2"] = 6
    held.__dict__.pop("_gains")
    high = model.scores(["quiet q the", "the q quiet", "aq bq c", "the thing there"])
    assert high[0] == high[1] == high[2] > high[3]


def test_forgotten_gains_are_found_again(toxicity_model, monkeypatch):
    texts, _ = toxic_corpus(40, random.Random(3))
    want = toxicity_model.scores(texts)
    monkeypatch.setattr(toxicity_zstd, "REMEMBERED", 3)
    held = toxicity_model.dictionaries
    fresh = toxicity_zstd.ToxicityModel(toxicity_zstd.Dictionaries(held.toxic, held.ordinary), toxicity_model.evidence, toxicity_model.calibration)
    assert (fresh.scores(texts) == want).all()


def test_the_toxic_dictionary_holds_a_broad_vocabulary():
    rng = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyz"
    bad = ["zq" + "".join(rng.choices(letters, k=8)) for _ in range(600)]
    words = ["".join(rng.choices(letters, k=5)) for _ in range(300)]
    texts = [" ".join(rng.choices(words, k=40) + (rng.choices(bad, k=60) if i % 2 else [])) for i in range(1_200)]
    model = toxicity_zstd.fit_texts(texts, np.arange(1_200) % 2, np.ones(1_200))
    assert sum(w.encode() in model.dictionaries.toxic for w in bad) > 350


def test_pairs_are_summed_in_linear_time():
    machine = quality_fm.FactorisationMachine()
    at, value = np.array([3, 99, 500, 20_000 % quality_fm.POSITIONS]), np.array([0.5, 2.0, -1.0, 0.3])
    machine.weight[at] = [1.0, -1.0, 0.5, 2.0]
    v = machine.factors[at]
    pairs = sum(value[i] * value[j] * (v[i] @ v[j]) for i in range(4) for j in range(i))
    assert machine.margin(at, value) == pytest.approx(machine.weight[at] @ value + pairs)


def test_gradients_learn_an_interaction():
    """Label 1 only if both or neither of two features are there: no linear model can."""
    rng = random.Random(2)
    rows, label = [], []
    for _ in range(1_500):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        at = [1 if a else 2, 3 if b else 4]
        rows.append((np.array(at), np.array([1.0, 1.0])))
        label.append(float(a == b))
    machine = quality_fm.FactorisationMachine()
    machine.fit(rows, np.array(label), np.ones(len(label)))
    right = [(machine.margin(*r) > 0) == (y > 0.5) for r, y in zip(rows, label, strict=True)]
    assert np.mean(right) > 0.95


def test_vectors_of_odd_texts():
    for text in (None, "", " ", "a", "ß" * 10, "%%% !!", "x " * 100_000, "\x00\ud800"):
        at, value = quality_fm.features(text, (None, float("nan"), -1.0, 1e300))
        assert len(set(at)) == len(at) and at.max() < quality_fm.POSITIONS and np.isfinite(value).all()


@pytest.mark.parametrize("kind", ["quality", "toxic"])
def test_tables(spark, kind):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    folds, fold = (5, 0) if kind == "quality" else (4, 2)
    odd = spark.createDataFrame([(None, None, None), (-1, "", 0), (-2, "word " * 100_000, None), (-2, "%%% &&&", -7)], "doc_id long, text string, n_chars long")
    odd = odd.selectExpr("*", "'x' as score", "1 as _label2")
    if kind == "quality":
        model = quality_fm.fit(docs, labels, folds, fold, metadata=["n_chars"])
        run = lambda rows: quality_fm.score_documents(rows, model, metadata=["n_chars"])
    else:
        model = toxicity_zstd.fit(docs, labels, folds, fold)
        run = lambda rows: toxicity_zstd.score_documents(rows, model)
    got = run(odd)
    assert got.columns == odd.columns and all(0 <= r["score"] <= 1 for r in got.collect()) and got.count() == 4
    assert run(odd.limit(0)).collect() == []
    unseen = docs.join(labels, "doc_id").where(held_out("doc_id", folds, fold)).select("text", "n_chars", kind)
    rows = run(unseen).toPandas()
    assert auc(rows["score"].to_numpy(), rows[kind].to_numpy()) > (0.95 if kind == "quality" else 0.7)


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(1, 0, 1), (None, 1, None), (2, None, None)], "doc_id long, quality int, toxic int")
    score = lambda rows: sorted(r["score"] for r in rows.collect())
    assert score(quality_fm.score_documents(docs, quality_fm.fit(docs, labels, 7, 5))) == [1.0, 1.0]
    assert score(quality_fm.score_documents(docs, quality_fm.fit(docs, one, 7, 5))) == [0.0, 0.0]
    assert score(toxicity_zstd.score_documents(docs, toxicity_zstd.fit(docs, labels, 7, 5))) == [0.0, 0.0]
    assert score(toxicity_zstd.score_documents(docs, toxicity_zstd.fit(docs, one, 7, 5))) == [0.0, 0.0]


def test_a_repeated_document_is_one_row_of_the_sample(spark):
    docs = spark.createDataFrame([(1, "a")] * 50 + [(1, "b"), (3, "c")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, toxic int")
    sample, weight = labelled_sample(docs, labels, "toxic", 4, 9, 20, 30)
    assert sorted(tuple(r) for r in sample.select("doc_id", "text", "_label").collect()) == [(1, "a", 1), (3, "c", 0)]
    assert weight == {0: 1.0, 1: 1.0}


def test_the_sample_is_bounded_and_leaves_the_fold_out(spark):
    docs = spark.createDataFrame([(i, "x" * (i % 50)) for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(400)] + [(3, 1), (None, 1), (5, None), (6, 9)], "doc_id long, toxic int")
    sample, weight = labelled_sample(docs, labels, "toxic", 4, 2, 20, 30)
    rows = sample.collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2 and len(r["text"]) <= 30 for r in rows)
    assert all(r["_label"] == int(r["doc_id"] % 10 == 0 or r["doc_id"] == 3) for r in rows)
    assert max(sum(r["_label"] == c for r in rows) for c in (0, 1)) <= 20
    eligible = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 != 2]
    ones = sum(1 for i in eligible if i % 10 == 0 or i == 3)
    assert weight == {0: (len(eligible) - ones) / 20, 1: ones / min(20, ones)}
