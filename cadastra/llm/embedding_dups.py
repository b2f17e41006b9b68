"""Embedding near-duplicates: exact cosine links within labels, by PCA-ordered tiles.

Equal vectors are one row with a count. Vectors are rotated to the principal axes of a bounded sample, which
changes no product but puts most of each into the leading dimensions. Recursive splits of the sample, each on the leading
coordinate with the greatest spread, give cells; a cell of a label is a block, or several by id where it is large. Blocks of a label whose boxes
in the leading coordinates are farther apart than linked vectors may be are not compared. Two blocks are compared tile by
tile, in the order of the first axis, and tiles dimension block by dimension block:
the products so far plus the product of the norms of what is left bound the cosine, and a pair is given up
when the bound falls below the threshold. What remains is decided on the given vectors in double precision.

A comparison hands on, for each vector, the number of its links and one edge to its local group, never its pairs. All blocks of a label
that may hold links are compared, so where the leading coordinates have no structure the work of a label
grows with the square of its distinct vectors, and a vector is sent to as many tasks as its label has blocks.

Labels, vectors and blocks are compared as such, never by hashes of them; rows that cannot link are not shuffled.

Cases: a null or zero vector, one with a null, infinite or NaN component, and a row with a null label or id
link with nothing; their component is their own id. Vectors of different lengths do not link. Repeated rows are vectors of their own, equal
to each other; different vectors under one id are one node. Empty tables give empty results. Other columns stay, but a column with the name of
an output is replaced.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.llm.columns import Aside
from cadastra.llm.components import connected_components
from cadastra.scratch import written

#: Numbers that the principal axes are fitted to, at most.
SAMPLE_VALUES = 1 << 21
#: Numbers in a block, about, distinct vectors in a tile, and leading coordinates that blocks are split and bounded in.
BLOCK_VALUES, TILE_ROWS, LEADING = 1 << 20, 1_024, 8
#: Dimensions added before the bound is looked at again.
STEP = 16
_SLACK = 1e-6
_OUTPUTS = ("n_links", "component_id", "kept")


def valid(vector: Column) -> Column:
    """Whether a vector has a direction; never null."""
    finite = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def principal_axes(sample: np.ndarray) -> np.ndarray:
    """Columns are the axes of unit vectors, that with the largest share first."""
    _, axes = np.linalg.eigh(sample.T @ sample)
    return np.ascontiguousarray(axes[:, ::-1])


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


class Side:
    """Vectors of one side: of length one, rotated, and the norms of what is left from each dimension on."""

    def __init__(self, vectors: np.ndarray, axes: np.ndarray) -> None:
        self.unit = _unit(vectors)
        self.turned = self.unit @ axes
        tail = np.sqrt(np.maximum(0.0, np.cumsum((self.turned**2)[:, ::-1], axis=1)[:, ::-1]))
        self.tail = np.c_[tail, np.zeros(len(tail))]

    def part(self, rows: slice) -> Side:
        own = object.__new__(Side)
        own.unit, own.turned, own.tail = self.unit[rows], self.turned[rows], self.tail[rows]
        return own


def tile_pairs(left: Side, right: Side, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all pairs of rows of two tiles with a cosine of the threshold or more."""
    a, b = left.turned, right.turned
    size = a.shape[1]
    at = min(STEP, size)
    part = a[:, :at] @ b[:, :at].T
    i, j = np.nonzero(part + left.tail[:, at, None] * right.tail[None, :, at] >= threshold - _SLACK)
    part = part[i, j]
    while at < size and len(i):
        end = min(size, at + STEP)
        part += np.einsum("ij,ij->i", a[i, at:end], b[j, at:end])
        at = end
        near = part + left.tail[i, at] * right.tail[j, at] >= threshold - _SLACK
        i, j, part = i[near], j[near], part[near]
    exact = np.einsum("ij,ij->i", left.unit[i], right.unit[j]) >= threshold
    return i[exact], j[exact]


def linked_pairs(left: np.ndarray, right: np.ndarray, axes: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all pairs of rows with a cosine of the threshold or more."""
    return tile_pairs(Side(left, axes), Side(right, axes), threshold)


def reach(threshold: float) -> float:
    """How far linked vectors of length one may be apart."""
    return math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-9


def block_links(
    left: np.ndarray, right: np.ndarray | None, copies: np.ndarray, axes: np.ndarray, threshold: float, tile_rows: int
) -> tuple[np.ndarray, np.ndarray]:
    """(links, first) of each row of two blocks, or of one with itself: how many vectors it links with, and the first
    row that links lead to."""
    size = len(left) + (0 if right is None else len(right))
    both = Side(left if right is None else np.concatenate([left, right]), axes)
    links, root = np.zeros(size), np.arange(size)
    order = np.argsort(both.turned[:, 0], kind="stable")
    starts = [order] if right is None else [order[order < len(left)], order[order >= len(left)]]
    tiles = [[own[i : i + tile_rows] for i in range(0, len(own), tile_rows)] for own in starts]
    for k, one in enumerate(tiles[0]):
        for two in tiles[0][k:] if right is None else tiles[1]:
            first, second = both.turned[one, 0], both.turned[two, 0]
            if max(second[0] - first[-1], first[0] - second[-1]) > reach(threshold):
                continue
            i, j = tile_pairs(both.part(one), both.part(two), threshold)
            i, j = one[i], two[j]
            if one is two:
                i, j = i[i < j], j[i < j]
            if len(i):
                links += np.bincount(i, copies[j], size) + np.bincount(j, copies[i], size)
                root = _roots(size, np.append(np.arange(size), i), np.append(root, j))
    return links, root


class Cells:
    """Splits of the space by leading coordinates; a leaf is a cell."""

    def __init__(self, sample: np.ndarray, cells: int) -> None:
        self.splits: list[tuple[int, float, int, int]] = []  # (coordinate, limit, below, above); -1 - cell is a leaf
        self.count = 0
        self.root = self._grow(sample, cells)

    def _grow(self, rows: np.ndarray, cells: int) -> int:
        if cells > 1 and len(rows) > 1:
            at = int(rows.var(axis=0).argmax())
            limit = float(np.quantile(rows[:, at], cells // 2 / cells))
            low = rows[:, at] < limit
            if low.any() and not low.all():
                node = len(self.splits)
                self.splits.append((at, limit, 0, 0))
                below = self._grow(rows[low], cells // 2)
                self.splits[node] = (at, limit, below, self._grow(rows[~low], cells - cells // 2))
                return node
        self.count += 1
        return -self.count

    def of(self, rows: np.ndarray) -> np.ndarray:
        cell, todo = np.zeros(len(rows), np.int32), [(self.root, np.arange(len(rows)))]
        while todo:
            node, own = todo.pop()
            if node < 0:
                cell[own] = -node - 1
                continue
            at, limit, below, above = self.splits[node]
            low = rows[own, at] < limit
            todo += [(below, own[low]), (above, own[~low])]
        return cell


def _roots(size: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest position that pairs connect each position with."""
    root = np.arange(size)
    while True:
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        np.minimum.at(root, before, root.copy())
        root = root[root]
        if np.array_equal(root, before):
            return root


def _sample(vectors: DataFrame, size: int) -> np.ndarray:
    rows = vectors.select("vector", F.xxhash64("uid").alias("h"))
    sample = rows.orderBy("h").limit(max(1, SAMPLE_VALUES // size)).select("vector").toPandas()["vector"]
    return _unit(np.stack(sample.to_list()).astype(float))


def near_duplicates(
    rows: DataFrame, threshold: float, vector: str = "embedding", label: str = "label", vec_id: str = "vec_id",
    tile_rows: int = TILE_ROWS, block_values: int = BLOCK_VALUES,
) -> DataFrame:
    """`rows` with `n_links`, `component_id` and `kept` (whether the row's id is that of its component)."""
    aside = Aside(rows)
    usable = valid(aside[vector]) & aside[label].isNotNull() & aside[vec_id].isNotNull()
    own = aside.frame.where(usable)
    vectors = own.groupBy(aside[label].alias("label"), aside[vector].alias("vector")).agg(
        F.min(aside[vec_id]).alias("uid"), F.count(F.lit(1)).alias("copies")
    )
    vectors = written(vectors.withColumn("size", F.size("vector")), "vectors")
    per_label = vectors.groupBy("size", "label").agg(F.count(F.lit(1)).alias("n"))
    found = None
    for size, most in sorted(tuple(r) for r in per_label.groupBy("size").agg(F.max("n")).collect()):
        part = _links(vectors.where(F.col("size") == size), size, most, threshold, tile_rows, max(1, block_values // size))
        found = part if found is None else found.union(part)
    if found is None:
        found = rows.sparkSession.createDataFrame([], "uid long, links long, other long")
    found = written(found, "links")
    degree = found.groupBy("uid").agg(F.sum("links").alias("links"))
    roots = connected_components(found, "uid", "other").select(F.col("node").alias("uid"), "root")
    nodes = written(degree.join(roots, "uid", "left"), "members")
    members = vectors.join(nodes, "uid", "left").select(
        F.col("label").alias("own_label"), F.col("vector").alias("own_vector"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
        F.coalesce("root", "uid").alias("component_id"),
    )
    same = (aside[label] == F.col("own_label")) & (aside[vector] == F.col("own_vector"))
    linked = own.join(members, same).select(*aside.held, "n_links", "component_id")
    alone = aside.frame.where(~usable).select(*aside.held, F.lit(0).cast("long"), aside[vec_id])
    kept = F.coalesce(F.col("component_id") == aside[vec_id], F.lit(False))
    return aside.back(linked.union(alone).withColumn("kept", kept), _OUTPUTS)


def _links(vectors: DataFrame, size: int, most: int, threshold: float, tile_rows: int, block_rows: int) -> DataFrame:
    """(uid, links, other): for each vector with links in a pair of blocks their number and one edge."""
    sample = _sample(vectors, size)
    axes = principal_axes(sample)
    leading = min(LEADING, size)
    cells = Cells((sample @ axes)[:, :leading], -(-most // block_rows))

    @F.pandas_udf("cell int, lead array<double>")
    def place(batch: pd.Series) -> pd.DataFrame:
        turned = (_unit(np.stack(batch.to_list()).astype(float)) @ axes)[:, :leading]
        return pd.DataFrame({"cell": cells.of(turned), "lead": list(turned)})

    placed = written(vectors.select("label", "uid", "copies", "vector", place("vector").alias("at")).select("*", "at.*").drop("at"), "cells")
    box = [f(F.col("lead")[i]).alias(f"{name}{i}") for name, f in (("low", F.min), ("high", F.max)) for i in range(leading)]
    counts = placed.groupBy("label", "cell").agg(F.count(F.lit(1)).alias("n"), *box)
    counts = counts.withColumn("parts", F.ceil(F.col("n") / block_rows).cast("int"))
    counts = written(counts, "counts")
    blocks = counts.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    block = F.struct("cell", "part")
    sides = []
    for name in ("a", "b"):
        renamed = [F.col(f"{kind}{i}").alias(f"{name}_{kind}{i}") for kind in ("low", "high") for i in range(leading)]
        sides.append(blocks.select("label", block.alias(name), *renamed))
    gaps = [F.greatest(F.lit(0.0), F.col(f"a_low{i}") - F.col(f"b_high{i}"), F.col(f"b_low{i}") - F.col(f"a_high{i}")) for i in range(leading)]
    apart = sum((gap * gap for gap in gaps[1:]), gaps[0] * gaps[0])
    pairs = sides[0].join(sides[1], "label").where((F.col("a") <= F.col("b")) & (apart <= reach(threshold) ** 2 + 1e-9))
    pairs = written(pairs.select("label", "a", "b"), "pairs")
    part = F.pmod(F.xxhash64("uid"), F.col("parts")).cast("int")
    blocked = placed.drop("lead").join(counts.select("label", "cell", "parts"), ["label", "cell"]).withColumn("block", F.struct("cell", part.alias("part")))
    meet = pairs.select("label", F.col("a").alias("block"), "a", "b", F.lit(True).alias("left")).union(
        pairs.where(F.col("a") != F.col("b")).select("label", "b", "a", "b", F.lit(False))
    )
    dealt = blocked.join(meet, ["label", "block"]).select(
        "label", "a", "b", (F.col("a") == F.col("b")).alias("same"), "left", "uid", "copies", "vector"
    )

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["left", "uid"], ascending=[False, True])
        values = np.stack(group["vector"].to_list()).astype(float)
        uid, copies, split = group["uid"].to_numpy(), group["copies"].to_numpy(), int(group["left"].sum())
        right = None if group["same"].iloc[0] else values[split:]  # a part of a cell may have no rows
        links, first = block_links(values[:split], right, copies, axes, threshold, tile_rows)
        own = np.flatnonzero(links)
        return pd.DataFrame({"uid": uid[own], "links": links[own].astype("int64"), "other": uid[first[own]]})

    return dealt.groupBy("label", "a", "b").applyInPandas(compare, "uid long, links long, other long")
