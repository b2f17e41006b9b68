from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadastra.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every):
    def ok(r):
        return r[0] is not None and r[2] is not None and r[1] and all(x is not None and math.isfinite(x) for x in r[1])

    rows = [(r[0], [math.floor(256 * float(np.float32(x))) for x in r[1]], r[2]) for r in rows if ok(r)]
    out = []
    for at, (anchor, vector, label) in enumerate(rows):
        if anchor % every:
            continue
        scored = [
            (-sum(x * y for x, y in zip(vector, v, strict=True)), i, other)
            for n, (i, v, other) in enumerate(rows) if n != at and len(v) == len(vector)
        ]
        own = sorted(s[:2] for s in scored if s[2] == label)[:5]
        rest = sorted(s[:2] for s in scored if s[2] != label)
        for p, positive in own:
            fits = [(s, i) for s, i in rest if 50 * -p <= 100 * -s <= 95 * -p][:3]
            out += [(anchor, positive, rank, i, -p, -s) for rank, (s, i) in enumerate(fits, 1)]
    return sorted(out)


def run(spark, rows, every=5):
    found = hard_negatives.mine(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % every == 0)
    return sorted(map(tuple, found.collect()))


def cloud(n, d, labels, seed, centres=6, spread=0.6):
    draw = np.random.default_rng(seed)
    middle = draw.normal(size=(centres, d))
    return [
        (i, [float(np.float32(x)) for x in (middle[draw.integers(centres)] + draw.normal(size=d) * spread) * draw.uniform(0.02, 0.3)], int(draw.integers(labels)))
        for i in range(n)
    ]


@pytest.fixture
def small_blocks(monkeypatch):
    for name, value in (("PART_ANCHORS", 8), ("BLOCK_VALUES", 600), ("SAMPLE_VALUES", 200), ("CHUNK", 7)):
        monkeypatch.setattr(hard_negatives, name, value)


def test_equals_brute_force(spark):
    rows = cloud(300, 12, 4, 1)
    want = brute(rows, 5)
    assert len(want) > 300 and run(spark, rows) == want


def test_equals_brute_force_over_many_parts_and_blocks(spark, small_blocks):
    rows = cloud(250, 12, 4, 2, spread=0.2)
    want = brute(rows, 5)
    assert len(want) > 100 and run(spark, rows) == want


def test_few_values_so_that_scores_tie(spark, small_blocks):
    draw = np.random.default_rng(3)
    rows = [(int(i), [float(x) / 128 for x in draw.integers(-1, 3, 4)], int(draw.integers(3))) for i in draw.permutation(160)]
    assert run(spark, rows) == brute(rows, 5)


def test_odd_rows(spark):
    a = [0.5, 0.25, -0.125]
    rows = [(0, a, 1), (1, a, 1), (2, a, 1), (2, a, 1), (0, a, 1), (3, [0.4, 0.2, -0.1], 2), (3, [0.4, 0.2, -0.1], 2), (5, [0.0, 0.0, 0.0], 1),
            (6, [0.0, 0.0, 0.0], 2), (10, [-0.5, -0.25, 0.1], 1), (15, None, 1), (20, [], 1), (25, [float("nan"), 1.0, 1.0], 1), (30, [None, 1.0, 1.0], 1),
            (35, [float("inf"), 1.0, 1.0], 1), (40, a, None), (None, a, 2), (45, [1.0, 2.0], 7), (46, [1.0, 2.0], 7), (47, [0.5, 1.5], 8), (50, [9.0], 1)]
    want = brute(rows, 5)
    assert want and run(spark, rows) == want
    assert run(spark, []) == []
    assert run(spark, [(1, a, 1), (2, a, 2)]) == []


def test_columns_with_internal_names(spark):
    rows = cloud(40, 4, 2, 4)
    names = ("uid", "vector", "size", "anchor", "cluster", "windows", "block", "part", "rank")
    frame = spark.createDataFrame(rows, SCHEMA).select("*", *(F.lit("x").alias(n) for n in names))
    found = hard_negatives.mine(frame, F.col("vec_id") % 5 == 0)
    assert sorted(map(tuple, found.collect())) == brute(rows, 5)


def test_walk_stops_with_a_certificate():
    draw = np.random.default_rng(5)
    items = np.floor(draw.normal(size=(4_000, 8)) * 100)
    items[:50] += 900
    anchors = np.floor(draw.normal(size=(3, 8)) * 10 + 900)
    centre = hard_negatives.centroids(anchors, 1)
    widest = hard_negatives.angles(anchors, centre).max(axis=0)
    bound = hard_negatives.shared_bound(items, centre, widest)[:, 0]
    full = anchors @ items.T
    assert (np.linalg.norm(anchors, axis=1)[:, None] * bound >= full).all()
    seen = []

    class Counted(np.ndarray):
        def __matmul__(self, other):
            seen.append(other.shape)
            return np.asarray(self) @ np.asarray(other)

    owner, infinite = np.arange(3), np.full(3, np.inf)
    best = hard_negatives.walk(
        anchors.view(Counted), np.arange(3) - 9, np.zeros(3), owner, -infinite, infinite, -infinite, items, np.arange(4_000), np.arange(4_000),
        np.zeros(4_000), bound, True, 5,
    )
    assert len(seen) == 1
    want = [sorted((-s, i) for i, s in enumerate(row))[:5] for row in full]
    assert [[(-s, i) for w, s, i in zip(best.window, best.score, best.ident, strict=True) if w == at] for at in range(3)] == want
