from __future__ import annotations

import math

import numpy as np

from cadastra.llm import embedding_dups

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold):
    def ok(r):
        v = r[1]
        return r[0] is not None and r[2] is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    n, links = len(rows), [0] * len(rows)
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            a, b = rows[i], rows[j]
            if ok(a) and ok(b) and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], np.float32).astype(float), np.array(b[1], np.float32).astype(float)
                if x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= threshold:
                    links[i] += 1
                    links[j] += 1
                    p, q = find(i), find(j)
                    root[max(p, q)] = min(p, q)
    ids = {}
    for i in range(n):
        if rows[i][0] is not None:
            ids[find(i)] = min(ids.get(find(i), rows[i][0]), rows[i][0])
    return sorted((str(rows[i][0]), links[i], str(ids.get(find(i)))) for i in range(n))


def run(spark, rows, threshold=0.93, **more):
    got = embedding_dups.near_duplicates(spark.createDataFrame(rows, SCHEMA), threshold, **more)
    return sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"])) for r in got.collect())


def cloud(n, d, labels, seed):
    draw = np.random.default_rng(seed)
    rows, base = [], draw.normal(size=(n // 4, d))
    for i in range(n):
        v = base[draw.integers(len(base))] + draw.normal(size=d) * draw.choice([0.0, 0.1, 0.25, 0.35])
        rows.append((i, [float(np.float32(x)) for x in v * draw.uniform(0.1, 9)], int(draw.integers(labels))))
    return rows


def test_links_equal_brute_force_over_many_tiles(spark):
    rows = cloud(300, 40, 3, 1)
    assert sum(r[1] for r in brute(rows, 0.93)) > 200
    assert run(spark, rows, tile_rows=16) == brute(rows, 0.93)
    assert run(spark, rows) == brute(rows, 0.93)


def test_few_dimensions_and_low_thresholds(spark):
    rows = cloud(80, 3, 2, 2)
    assert run(spark, rows, 0.2, tile_rows=8) == brute(rows, 0.2)


def test_copies_and_odd_vectors(spark):
    a, b = [1.0, 0.0, 2.0], [0.0, 1.0, 0.0]
    rows = [(4, a, 1), (2, a, 1), (2, a, 1), (7, [2.0, 0.0, 4.0], 1), (8, a, 2), (9, a, None), (10, None, 1), (11, [0.0, 0.0, 0.0], 1),
            (12, [float("nan"), 1.0, 1.0], 1), (13, [float("inf"), 1.0, 1.0], 1), (14, [None, 1.0, 1.0], 1), (15, [], 1), (16, [1.0, 0.0], 1),
            (None, a, 1), (17, b, 1), (18, [3e-30, 0.0, 6e-30], 1), (19, [3e37, 0.0, 6e37], 1)]
    assert run(spark, rows) == brute(rows, 0.93)


def test_empty_table_clashing_columns_and_kept(spark):
    empty = spark.createDataFrame([], SCHEMA + ", kept string")
    got = embedding_dups.near_duplicates(empty, 0.93)
    assert got.collect() == [] and got.columns == ["vec_id", "embedding", "label", "n_links", "component_id", "kept"]
    rows = spark.createDataFrame([(2, [1.0, 1.0], 0, "x", 5), (1, [1.0, 1.0], 0, "y", 6)], SCHEMA + ", kept string, uid int")
    got = {r["vec_id"]: (r["kept"], r["uid"]) for r in embedding_dups.near_duplicates(rows, 0.93).collect()}
    assert got == {2: (False, 5), 1: (True, 6)}


def test_bound_gives_up_only_what_cannot_reach_the_threshold():
    draw = np.random.default_rng(4)
    x = draw.normal(size=(200, 64))
    x[100:] = x[:100] + draw.normal(size=(100, 64)) * 0.3
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    i, j = embedding_dups.linked_pairs(x, x, embedding_dups.principal_axes(unit), 0.93)
    want = np.argwhere(unit @ unit.T >= 0.93)
    assert sorted(zip(i, j, strict=True)) == sorted(map(tuple, want))


def test_links_over_many_blocks(spark):
    rows = cloud(400, 12, 2, 6)
    want = brute(rows, 0.93)
    assert run(spark, rows, tile_rows=8, block_values=12 * 20) == want
    assert run(spark, rows, tile_rows=64, block_values=12 * 3) == want


def test_equal_vectors_of_unlike_labels_and_zero_signs(spark):
    rows = [(1, [0.0, 1.0], 1), (2, [-0.0, 1.0], 1), (3, [0.0, 1.0], 2), (4, [0.0, 1.0], 3), (5, [1e-3, 1.0], 3)]
    assert run(spark, rows) == brute(rows, 0.93)


def test_rows_that_cannot_link_are_not_shuffled(spark):
    rows = spark.createDataFrame([(i, [1.0, 2.0], None) for i in range(100)] + [(200, [1.0, 2.0], 1)], SCHEMA)
    got = embedding_dups.near_duplicates(rows, 0.93)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lstrip().startswith(("Union", "Project")) and got.count() == 101


def test_blocks_links_equal_all_pairs():
    draw = np.random.default_rng(8)
    x = draw.normal(size=(150, 16))
    x[75:] = x[:75] + draw.normal(size=(75, 16)) * 0.2
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    axes, copies = embedding_dups.principal_axes(unit), draw.integers(1, 4, 150)
    links, first = embedding_dups.block_links(x[:100], x[100:], copies, axes, 0.93, 16)
    near = (unit @ unit.T >= 0.93)[:100, 100:]
    assert links.tolist() == (near @ copies[100:]).tolist() + (copies[:100] @ near).tolist()
    assert sorted(np.flatnonzero(links)) == sorted(set(np.nonzero(near)[0]) | set(100 + np.nonzero(near)[1]))
    assert all(first[i] <= i for i in range(150))


def test_cells_part_all_rows_and_far_ones_are_apart():
    draw = np.random.default_rng(9)
    rows = np.concatenate([draw.normal(size=(100, 4)) + 20 * k for k in range(4)])
    cells = embedding_dups.Cells(rows, 4)
    of = cells.of(rows)
    assert cells.count == 4 and sorted(np.bincount(of)) == [100, 100, 100, 100]
    assert all(len(set(of[100 * k : 100 * k + 100])) == 1 for k in range(4))
