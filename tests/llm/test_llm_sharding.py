from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from cadastra.llm import sharding

SCHEMA = "doc_id long, text string, shard string"


def run(spark, rows, shards=4, **more):
    return [r.asDict() for r in sharding.assign(spark.createDataFrame(rows, SCHEMA), shards, 8, **more).collect()]


def gapless(rows):
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    return all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sums_are_balanced_and_slots_gapless(spark, monkeypatch):
    monkeypatch.setattr(sharding, "PART_ROWS", 20)
    draw = random.Random(0)
    rows = [(i, " ".join(draw.choices(["a", "bcd", "efghij", "ü"], k=draw.randint(0, 300))), "x") for i in range(2_000)]
    rows += [(5_000 + i, "the same text for a third of all rows", "x") for i in range(1_000)]
    got = run(spark, rows)
    assert len(got) == 3_000 and gapless(got)
    texts = {r[0]: r[1] for r in rows}
    for r in got:
        body = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(body) + 8, zlib.crc32(body))
    by = [(sum(r["size"] for r in got if r["shard"] == s), sum(1 for r in got if r["shard"] == s)) for s in range(4)]
    for column in zip(*by, strict=True):
        assert max(column) <= 1.02 * min(column)


def test_equal_texts_share_a_shard_while_they_are_few(spark):
    rows = [(i, f"text {i // 3} " * (1 + i // 3 % 7), "x") for i in range(1_200)]
    homes = {}
    for r in run(spark, rows):
        homes.setdefault(r["doc_id"] // 3, set()).add(r["shard"])
    assert all(len(s) == 1 for s in homes.values())


def test_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "a", "x"), (None, None, None), (3, "z" * 300_000, "x"), (4, "b", "x"), (4, "b", "x")]
    got = run(spark, rows, 3)
    assert len(got) == 7 and gapless(got)
    assert sorted(r["size"] for r in got) == [8, 8, 8, 9, 9, 9, 300_008]
    assert [r["text_crc32"] for r in got if r["text"] is None] == [0, 0]
    assert run(spark, [], 3) == []


def test_assignment_does_not_depend_on_partitioning(spark):
    rows = [(i, f"t{i % 50}", "x") for i in range(300)]
    one = sharding.assign(spark.createDataFrame(rows, SCHEMA).coalesce(1), 5)
    many = sharding.assign(spark.createDataFrame(rows, SCHEMA).repartition(13), 5)
    pick = ["doc_id", "shard", "slot"]
    assert sorted(map(tuple, one.select(pick).collect())) == sorted(map(tuple, many.select(pick).collect()))


@pytest.mark.parametrize("seed", range(3))
def test_pack_balances_all_dimensions(seed):
    items = np.random.default_rng(seed).lognormal(size=(3_000, 3))
    placed = sharding.pack(items, 24)
    for d in range(3):
        sums = np.bincount(placed, items[:, d], 24)
        assert sums.max() / sums.min() < 1.05


def test_written_shards_hold_all_rows(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"t{i}", "x") for i in range(40)], SCHEMA)
    sharding.write_shards(sharding.assign(rows, 3), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 40 and {p.name for p in (tmp_path / "out").glob("shard=*")} == {"shard=0", "shard=1", "shard=2"}


def greedy(items, shards):
    """Largest first, each to the shard whose residual capacity has the highest dot product, in plain numbers."""
    totals = [sum(x) or 1 for x in zip(*items, strict=True)]
    left = [[1.0] * 3 for _ in range(shards)]
    homes = {}
    scaled = [[x / t * shards for x, t in zip(item, totals, strict=True)] for item in items]
    for at in sorted(range(len(items)), key=lambda i: (-max(scaled[i]), i)):
        scores = [sum(r * x for r, x in zip(row, scaled[at], strict=True)) for row in left]
        best = max(range(shards), key=lambda s: (scores[s], -s))
        homes[at] = best
        left[best] = [r - x for r, x in zip(left[best], scaled[at], strict=True)]
    return [homes[i] for i in range(len(items))]


def test_groups_are_placed_as_a_plain_greedy_places_them(spark, monkeypatch):
    """With groups that are all placed by themselves, no bundles are left."""
    draw = random.Random(7)
    texts = [" ".join(draw.choices(["a", "bcd", "efghij"], k=draw.randint(5, 60))) for _ in range(40)]
    rows = [(n, texts[n % 40], "x") for n in range(40)] + [(100 + n, texts[n], "x") for n in range(10)]
    monkeypatch.setattr(sharding, "OWN_SHARE", 0.0)
    import hashlib

    groups = {}
    for _, text, _ in rows:
        row = groups.setdefault(hashlib.md5(text.encode()).hexdigest(), [text, 0, 0, 0])
        row[1] += len(text.encode()) + 8
        row[2] += len(text.split())
        row[3] += 1
    ordered = [row for _, row in sorted(groups.items())]
    totals = np.array([[row[k] for row in ordered] for k in (1, 2, 3)], float).sum(axis=1)
    assert all(sharding.pieces(np.array(row[1:], float), totals, 4) == 1 for row in ordered)
    want = {row[0]: home for row, home in zip(ordered, greedy([row[1:] for row in ordered], 4), strict=True)}
    assert {r["doc_id"]: r["shard"] for r in run(spark, rows)} == {i: want[text] for i, text, _ in rows}


def test_only_groups_that_cannot_stay_whole_are_cut():
    totals = np.array([1000.0, 1000.0, 1000.0])
    assert sharding.pieces(np.array([240.0, 240.0, 235.0]), totals, 4) == 1
    assert sharding.pieces(np.array([510.0, 500.0, 505.0]), totals, 4) == 3
    assert sharding.pieces(np.array([20.0, 20.0, 145.0]), totals, 4) == 4
    assert sharding.pieces(np.array([0.0, 0.0, 0.0]), np.zeros(3), 4) == 1
