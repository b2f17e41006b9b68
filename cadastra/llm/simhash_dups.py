"""SimHash near-duplicates: fingerprints of whole texts, linked through vantage-point trees.

Fingerprints are reduced to the distinct ones first, so exact copies cost one row each
map task. A tree over a bounded sample splits them by their Hamming distance to vantage
points: nearer than a radius goes one way, the rest the other way, and what lies within
`max_bits` inside the radius goes both ways. By the triangle inequality two linked
fingerprints then share at least one leaf, so leaves can be searched by themselves. A
leaf that is still too large is split again on the cluster, with a vantage point and a
radius of its own, until all leaves are small or no split saves comparisons, as among very many
fingerprints of one dense group: such a leaf is cut into blocks, and each two blocks are compared.
Within a leaf the same tree is built in memory. A leaf hands on one edge per fingerprint to its local group, never all pairs.

Cases: a null text and a text without words have fingerprint zero, which links like any
other. Null ids are kept; a group's id is its smallest id that is not null. Repeated
rows give repeated rows. Empty tables give empty results. Other columns stay, but a column with the name
of an output is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.llm.columns import Aside, named
from cadastra.llm.components import connected_components
from cadastra.scratch import written

#: Fingerprints that the first tree is built from, at most; they are collected.
TREE_SAMPLE = 32_768
#: Leaves of the first tree, at most.
TREE_LEAVES = 4_096
#: Rows that one leaf may hold when it is searched.
LEAF_ROWS = 3_000
#: Fingerprints that one task deals to the leaves, about.
DEALT_AT_ONCE = 20_000
#: A split must leave fewer comparisons than this share of those between all rows.
_WORTHWHILE = 0.9
#: Below this many rows the tree in a leaf ends in plain comparison.
_BUCKET = 128
_VANTAGES = 8
_HASHES_AT_ONCE = 65_536


def text_fingerprint(text: str | None, shingle: int, seed: int) -> int:
    """64 bits: each is 1 if set in over half the hashes of the text's shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    space = b" ".join
    last = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for start in range(0, last, _HASHES_AT_ONCE):
        some = range(start, min(last, start + _HASHES_AT_ONCE))
        hashes = np.array([digest(space(words[i : i + shingle]), seed) for i in some], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > last, bitorder="little").view("<i8")[0])


def fingerprint(text: Column, shingle: int, seed: int = 42) -> Column:
    """The fingerprint as a signed 64-bit number."""

    @F.pandas_udf("long")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([text_fingerprint(value, shingle, seed) for value in batch], dtype="int64")

    return of(text)


def hexadecimal(number: Column) -> Column:
    """16 lowercase hex digits of a signed 64-bit number."""
    return F.lower(F.lpad(F.hex(number), 16, "0"))


def _best_radius(counts: np.ndarray, max_bits: int) -> tuple[float, int]:
    """(cost, radius) of the cheapest split; counts: rows by distance 0 to 64.

    The cost is the number of comparisons that are left; radius 0 if no split saves enough of them.
    """
    below = np.concatenate([[0], np.cumsum(counts)])
    total = int(below[-1])
    best = (_WORTHWHILE * float(total) ** 2, 0)
    for radius in range(1, 65):
        inside, outside = int(below[radius]), total - int(below[max(0, radius - max_bits)])
        best = min(best, (float(inside) ** 2 + float(outside) ** 2, radius))
    return best


def _split(prints: np.ndarray, max_bits: int) -> tuple[np.uint64, int] | None:
    """The vantage point among a few of `prints`, and its radius."""
    best = (_WORTHWHILE * float(len(prints)) ** 2, 0, np.uint64(0))
    for at in np.unique(np.linspace(0, len(prints) - 1, _VANTAGES).astype(int)):
        counts = np.bincount(np.bitwise_count(prints ^ prints[at]), minlength=65)
        best = min(best, (*_best_radius(counts, max_bits), prints[at]))
    return (best[2], best[1]) if best[1] else None


class VantageTree:
    """Nodes as arrays; `inner` and `outer` are the next node, or -1 - leaf."""

    def __init__(self, prints: np.ndarray, leaf_rows: int, max_bits: int) -> None:
        self.max_bits = max_bits
        self.vantage, self.radius, self.inner, self.outer = [], [], [], []
        self.leaves = 0
        self.root = self._grow(prints, leaf_rows)

    def _grow(self, prints: np.ndarray, leaf_rows: int) -> int:
        found = _split(prints, self.max_bits) if len(prints) > leaf_rows else None
        if found is None:
            self.leaves += 1
            return -self.leaves
        node = len(self.vantage)
        distance = np.bitwise_count(prints ^ found[0])
        self.vantage.append(found[0])
        self.radius.append(found[1])
        self.inner.append(0)
        self.outer.append(0)
        self.inner[node] = self._grow(prints[distance < found[1]], leaf_rows)
        self.outer[node] = self._grow(prints[distance >= found[1] - self.max_bits], leaf_rows)
        return node

    def deal(self, prints: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, positions) for each leaf that any of `prints` must be looked up in."""
        todo = [(self.root, np.arange(len(prints)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            if node < 0:
                yield -node - 1, rows
                continue
            distance = np.bitwise_count(prints[rows] ^ self.vantage[node])
            todo.append((self.inner[node], rows[distance < self.radius[node]]))
            todo.append((self.outer[node], rows[distance >= self.radius[node] - self.max_bits]))


def local_groups(prints: np.ndarray, max_bits: int) -> np.ndarray:
    """For each of the distinct `prints` the position of the first one that links lead to."""
    parent = np.arange(len(prints))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    todo = [np.arange(len(prints))]
    while todo:
        rows = todo.pop()
        found = _split(prints[rows], max_bits) if len(rows) > _BUCKET else None
        if found is not None:
            distance = np.bitwise_count(prints[rows] ^ found[0])
            todo += [rows[distance < found[1]], rows[distance >= found[1] - max_bits]]
            continue
        for start in range(0, len(rows), 512):
            block = rows[start : start + 512]
            near = np.bitwise_count(prints[block][:, None] ^ prints[rows][None, :]) <= max_bits
            for i, j in zip(*np.nonzero(near), strict=True):
                if rows[j] > block[i] and (a := root(block[i])) != (b := root(rows[j])):
                    parent[max(a, b)] = min(a, b)
    return np.array([root(i) for i in range(len(prints))], dtype=int)


def _dealt(prints: DataFrame, tree: VantageTree) -> DataFrame:
    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = batch["print"].to_numpy()
            for leaf, rows in tree.deal(values.view(np.uint64)):
                yield pd.DataFrame({"leaf": np.full(len(rows), leaf, np.int64), "print": values[rows]})

    return prints.select("print").mapInPandas(deal, "leaf long, print long")


def _leaves(prints: DataFrame, total: int, max_bits: int, leaf_rows: int) -> DataFrame:
    """(leaf, print): every leaf small, every two linked prints together in one at least."""
    share = min(1.0, TREE_SAMPLE / total)
    chosen = F.pmod(F.xxhash64("print"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1
    sample = np.array([row[0] for row in prints.where(chosen).limit(2 * TREE_SAMPLE).collect()], np.int64)
    leaves = min(TREE_LEAVES, 1 + total * 2 // leaf_rows)
    tree = VantageTree(np.sort(sample).view(np.uint64), max(1, len(sample) // leaves), max_bits)
    spread = prints.select("print").repartition(max(1, -(-total // DEALT_AT_ONCE)), "print")
    rows, done = written(_dealt(spread, tree), "leaves"), []

    @F.pandas_udf("int")
    def radius_of(histograms: pd.Series) -> pd.Series:
        def best(pairs: list) -> int:
            counts = np.zeros(65, np.int64)
            for pair in pairs:
                counts[pair["bits"]] = pair["n"]
            return _best_radius(counts, max_bits)[1]

        return pd.Series([best(pairs) for pairs in histograms], dtype="int32")

    bits = F.bit_count(F.col("print").bitwiseXOR(F.col("vantage"))).cast("int")
    while True:
        sizes = rows.groupBy("leaf").agg(
            F.count(F.lit(1)).alias("n"), F.min_by("print", F.xxhash64("print")).alias("vantage")
        )
        large = sizes.where(F.col("n") > leaf_rows).select("leaf", "vantage")
        splits = written(
            rows.join(large, "leaf").groupBy("leaf", "vantage", bits.alias("bits")).agg(F.count(F.lit(1)).alias("n"))
            .groupBy("leaf", "vantage").agg(F.collect_list(F.struct("bits", "n")).alias("histogram"))
            .select("leaf", "vantage", radius_of("histogram").alias("radius")).where(F.col("radius") > 0),
            "leaves",
        )
        if splits.isEmpty():
            break
        done.append(rows.join(splits, "leaf", "left_anti"))
        side = F.explode(F.array_compact(F.array(
            F.when(bits < F.col("radius"), F.lit(0)), F.when(bits >= F.col("radius") - max_bits, F.lit(1))
        )))
        split = rows.join(splits, "leaf").withColumn("side", side)
        rows = written(split.select(F.xxhash64("leaf", "vantage", "side").alias("leaf"), "print"), "leaves")
    for part in done:
        rows = rows.union(part)
    sizes = rows.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"))
    blocks = sizes.where(F.col("n") > leaf_rows).select("leaf", F.ceil(2 * F.col("n") / leaf_rows).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("print", F.lit("block")), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1))
    cut = rows.join(written(blocks, "leaves"), "leaf", "left").select("*", own.alias("own"), other.alias("other"))
    met = F.xxhash64("leaf", F.least("own", "other"), F.greatest("own", "other"))
    return cut.select(F.when(F.col("blocks").isNull(), F.col("leaf")).otherwise(met).alias("leaf"), "print")


def linked_prints(prints: DataFrame, max_bits: int, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """(print, root) for every distinct `print` that is linked to another, directly or through others."""
    prints = prints.select("print").distinct()
    total = prints.count()
    if total < 2:
        return prints.select("print", F.col("print").alias("root")).limit(0)

    def search(leaf: pd.DataFrame) -> pd.DataFrame:
        values = np.unique(leaf["print"].to_numpy())
        first = local_groups(values.view(np.uint64), max_bits)
        own = first != np.arange(len(values))
        return pd.DataFrame({"a": values[own], "b": values[first[own]]})

    edges = _leaves(prints, total, max_bits, leaf_rows).groupBy("leaf").applyInPandas(search, "a long, b long")
    return connected_components(edges, "a", "b").select(F.col("node").alias("print"), "root")


def _printed(aside: Aside, shingle: int, text: str, left_out: list[str]) -> DataFrame:
    """The rows with their fingerprint as `print`, computed once and stored."""
    return written(aside.frame.select(*(c for c in aside.held if c not in left_out), fingerprint(aside[text], shingle).alias("print")), "prints")


def _rooted(rows: DataFrame, max_bits: int, doc_id: str, leaf_rows: int) -> DataFrame:
    """(print, first_id, root): the distinct fingerprints, each with its group's root."""
    prints = written(rows.groupBy("print").agg(F.min(doc_id).alias("first_id")), "prints")
    linked = linked_prints(prints, max_bits, leaf_rows)
    return prints.join(linked, "print", "left").withColumn("root", F.coalesce("root", "print"))


def _grouped(rows: DataFrame, max_bits: int, doc_id: str, leaf_rows: int) -> DataFrame:
    """The rows with `fingerprint` and `component_id`."""
    rooted = _rooted(rows, max_bits, doc_id, leaf_rows)
    roots = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    members = written(rooted.join(roots, "root").select("print", "component_id"), "members")
    return rows.join(members, "print").withColumn("fingerprint", hexadecimal(F.col("print")))


def near_duplicates(
    docs: DataFrame, shingle: int, max_bits: int, text: str = "text", doc_id: str = "doc_id", leaf_rows: int = LEAF_ROWS
) -> DataFrame:
    """All rows of `docs` with `fingerprint` (hex) and `component_id`."""
    aside = Aside(docs)
    joined = _grouped(_printed(aside, shingle, text, []), max_bits, aside.name(doc_id), leaf_rows)
    return aside.back(joined, ("fingerprint", "component_id"))


def components(
    docs: DataFrame, shingle: int, max_bits: int, text: str = "text", doc_id: str = "doc_id", leaf_rows: int = LEAF_ROWS
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of all rows; texts are not stored."""
    own = docs.select(named(doc_id).alias(doc_id), named(text).alias(text))
    aside = Aside(own)
    joined = _grouped(_printed(aside, shingle, text, [aside.name(text)]), max_bits, aside.name(doc_id), leaf_rows)
    return joined.select(aside[doc_id].alias(doc_id), "fingerprint", "component_id")


def keep_one(
    docs: DataFrame, shingle: int, max_bits: int, text: str = "text", doc_id: str = "doc_id", leaf_rows: int = LEAF_ROWS
) -> DataFrame:
    """One row of each group: that with the smallest id; null ids come last, and of equal rows one stays."""
    aside = Aside(docs)
    rows = _printed(aside, shingle, text, [])
    order = F.struct(F.col("first_id").isNull(), "first_id", "print")
    kept = _rooted(rows, max_bits, aside.name(doc_id), leaf_rows).groupBy("root").agg(F.min(order).alias("kept"))
    kept = written(kept.select("kept.print", "kept.first_id"), "kept")
    chosen = rows.join(kept, "print").where(aside[doc_id].eqNullSafe(F.col("first_id")))
    return aside.back(chosen.dropDuplicates(["print"]), ())
