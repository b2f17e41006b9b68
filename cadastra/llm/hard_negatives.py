"""Hard negatives by shared candidate lists of anchor clusters.

Vectors are quantised to whole numbers and compared by their inner product. Anchors are clustered by angle. For
a cluster with centroid c, whose members are within an angle b of it, no member a can score an item i higher than
|a| |i| cos(max(0, angle(i, c) - b)). Items are sorted by |i| cos(...) once for the cluster, and every member
walks that one list from the top until the bound of what is left falls below what it still needs: the search
ends with a certificate, not at a depth. Equal scores are ordered by id, so a bound that is equal goes on.

First each anchor's positives are searched among rows of its label, then, for each positive, negatives among
other labels, whose score must lie in a window below the positive's. What a bounded sample of items already
yields is a lower limit that searches start with; items below it for a whole cluster are not sent there.

On the cluster: a large cluster of anchors is cut into parts and the items into blocks, of a bounded size both. Each part
meets each block that may hold something for it once, and hands on a few rows an anchor, which are ranked by Spark. So the work
is that of the anchors against all rows, in blocks, less what the bounds take out; where all angles
are wide, as among vectors without structure, they take out little.

Cases: rows with a null id, label or vector, or with a null or non-finite component take no part; an empty vector
takes no part either. Vectors of different lengths do not meet. Rows that share an id, equal ones too, are rows of their own, and each
other's partners. A zero vector scores 0 with everything; its windows are empty but for scores of 0. A negative
positive has an empty window. Scores are exact while sums of products stay below 2**46, rounded as doubles beyond, and end at the
range of 64 bits. Empty tables give empty results. Other columns do not matter.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cadastra.scratch import written

#: Components are multiplied by this before they are cut to whole numbers.
SCALE = 256
POSITIVES, NEGATIVES = 5, 3
#: A negative scores between these percentages of its positive.
LOW, HIGH = 50, 95
#: Anchors of one part, numbers of one block of items, clusters at most.
PART_ANCHORS, BLOCK_VALUES, CLUSTERS = 256, 1 << 19, 64
#: Numbers of the samples that clusters are fitted to and that first limits come from, at most.
SAMPLE_VALUES = 1 << 18
#: Items of a list that are scored at a time.
CHUNK = 512
#: Fixed seed of the items' draw, and the room for rounding: of angles, and of scores as a share.
_DRAW, _ANGLE_SLACK, _SCORE_SLACK = 11, 1e-7, 1e-9

RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
_WINDOWS = "array<struct<of:long,low:double,high:double,floor:double>>"
_FOUND = "uid long, of long, item long, vec_id long, score long"


def quantised(vectors: pd.Series) -> np.ndarray:
    return np.floor(np.stack([np.asarray(v, np.float64) for v in vectors]) * SCALE)


def _unit(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norm > 0, norm, 1.0)


def centroids(anchors: np.ndarray, count: int) -> np.ndarray:
    """Unit centres of spherical k-means."""
    draw, unit = np.random.default_rng(0), _unit(anchors)
    centres = unit[draw.choice(len(unit), min(count, len(unit)), replace=False)]
    for _ in range(8):
        nearest = (unit @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, unit)
        empty = ~np.any(sums, axis=1)
        centres = np.where(empty[:, None], centres, _unit(sums))
    return centres


def angles(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Of each row with each centre; a zero row has the angle 0."""
    cosine = np.clip(_unit(rows) @ centres.T, -1.0, 1.0)
    return np.where(np.any(rows, axis=1)[:, None], np.arccos(cosine), 0.0)


def shared_bound(rows: np.ndarray, centres: np.ndarray, widest: np.ndarray) -> np.ndarray:
    """For each row and cluster: times the norm of a member, the most that the member may score it."""
    apart = np.maximum(0.0, angles(rows, centres) - widest - _ANGLE_SLACK)
    norm = np.linalg.norm(rows, axis=1)[:, None]
    return norm * np.cos(np.minimum(apart, np.pi)) + norm * _SCORE_SLACK


class Best:
    """The best `k` (score, id, row) of each window so far, and the score that a further one must reach."""

    def __init__(self, floor: np.ndarray, k: int) -> None:
        self.k, self.least = k, floor.copy()
        self.window, self.score, self.ident, self.row = (np.zeros(0, t) for t in (int, float, np.int64, int))

    def add(self, window: np.ndarray, score: np.ndarray, ident: np.ndarray, row: np.ndarray) -> None:
        window, score = np.append(self.window, window), np.append(self.score, score)
        ident, row = np.append(self.ident, ident), np.append(self.row, row)
        order = np.lexsort((row, ident, -score, window))
        first = np.searchsorted(window[order], window[order])
        kept = order[np.arange(len(order)) - first < self.k]
        self.window, self.score, self.ident, self.row = window[kept], score[kept], ident[kept], row[kept]
        full = np.flatnonzero(np.bincount(self.window, minlength=len(self.least)) == self.k)
        last = np.searchsorted(self.window, full, "right") - 1
        self.least[full] = np.maximum(self.least[full], self.score[last])


def walk(
    anchors: np.ndarray, anchor_uid: np.ndarray, anchor_label: np.ndarray, owner: np.ndarray, low: np.ndarray, high: np.ndarray,
    floor: np.ndarray, items: np.ndarray, uid: np.ndarray, ident: np.ndarray, label: np.ndarray, bound: np.ndarray, same: bool, k: int,
) -> Best:
    """The best `k` items of each window, from one list in the order of `bound`, the highest first.

    A window belongs to the anchor `owner`, takes scores s with low <= 100 s <= high, and needs none below `floor`.
    `same`: whether partners have the anchor's label, or another.
    """
    best, norm = Best(floor, k), np.linalg.norm(anchors, axis=1)
    order = np.argsort(-bound, kind="stable")
    items, uid, ident, label, bound = items[order], uid[order], ident[order], label[order], bound[order]
    todo = np.flatnonzero(low <= high)
    for start in range(0, len(items), CHUNK):
        needs = np.maximum(low[todo] / 100, best.least[todo])
        most = norm[owner[todo]] * bound[start]
        todo = todo[most + np.abs(most) * _SCORE_SLACK >= needs]  # certified: nothing that is left can reach it
        if not len(todo):
            break
        part = slice(start, start + CHUNK)
        used, at = np.unique(owner[todo], return_inverse=True)
        scores = anchors[used] @ items[part].T
        fits = (anchor_label[used][:, None] == label[part][None, :]) == same
        fits &= anchor_uid[used][:, None] != uid[part][None, :]
        scaled, own = 100 * scores[at], scores[at]
        hit = fits[at] & (scaled >= low[todo][:, None]) & (scaled <= high[todo][:, None]) & (own >= best.least[todo][:, None])
        i, j = np.nonzero(hit)
        if len(i):
            best.add(todo[i], own[i, j], ident[part][j], order[start + j])
    return best


def _windows(column: pd.Series) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Windows of all anchors in a row: their owner, and a row of numbers for each field."""
    rows = [list(w) if w is not None else [] for w in column]
    owner = np.repeat(np.arange(len(rows)), [len(w) for w in rows])
    flat = [w for row in rows for w in row]
    kinds = {"of": np.int64, "low": float, "high": float, "floor": float}
    return owner, {name: np.array([w[name] for w in flat], kind) for name, kind in kinds.items()}


def _search(anchors: pd.DataFrame, items: pd.DataFrame, bound: np.ndarray, same: bool, k: int) -> tuple[Best, np.ndarray, np.ndarray]:
    owner, w = _windows(anchors["windows"])
    best = walk(
        quantised(anchors["vector"]), anchors["uid"].to_numpy(), anchors["label"].to_numpy(), owner, w["low"], w["high"], w["floor"],
        quantised(items["vector"]), items["uid"].to_numpy(), items["vec_id"].to_numpy(), items["label"].to_numpy(), bound, same, k,
    )
    return best, owner, w["of"]


def _with_floors(anchors: DataFrame, sample: pd.DataFrame, same: bool, k: int) -> DataFrame:
    """Anchors whose windows start from what a sample of the items yields."""
    names = anchors.columns

    def seeded(batches):
        norm = np.linalg.norm(quantised(sample["vector"]), axis=1) * (1 + _SCORE_SLACK)
        for batch in batches:
            for start in range(0, len(batch), PART_ANCHORS):
                part = batch.iloc[start : start + PART_ANCHORS].copy()
                best, owner, _ = _search(part, sample, norm, same, k)
                ends = np.searchsorted(owner, np.arange(len(part) + 1))
                windows = [[dict(w) for w in row] if row is not None else [] for row in part["windows"]]
                for at, row in enumerate(windows):
                    for w, least in zip(row, best.least[ends[at] : ends[at + 1]], strict=True):
                        w["floor"] = float(least)
                yield part.assign(windows=windows)[names]

    return anchors.mapInPandas(seeded, anchors.schema)


def _matched(anchors: DataFrame, items: DataFrame, sample: pd.DataFrame, centres: np.ndarray, blocks: int, same: bool, k: int) -> DataFrame:
    """The best `k` items of each window in each block of items."""
    anchors = written(_with_floors(anchors, sample, same, k), "anchors")
    needs = F.array_min(F.transform("windows", lambda w: F.when(w["low"] <= w["high"], F.greatest(w["low"] / 100, w["floor"]))))
    ratio = F.when(F.col("norm") > 0, needs / F.col("norm")).when(needs <= 0, float("-inf"))  # null: no window is open
    known = anchors.groupBy("cluster").agg(F.max("angle"), F.min(ratio), F.count(F.lit(1))).collect()  # `CLUSTERS` rows at most
    widest, least, parts = np.zeros(len(centres)), np.full(len(centres), np.inf), [0] * len(centres)
    for cluster, angle, need, n in known:
        widest[cluster], parts[cluster] = angle, -(-n // PART_ANCHORS)
        least[cluster] = np.inf if need is None else need

    @F.pandas_udf("array<struct<cluster:int,bound:double>>")
    def lists(vectors: pd.Series) -> pd.Series:
        bounds = shared_bound(quantised(vectors), centres, widest)
        wanted = bounds + np.abs(bounds) * _SCORE_SLACK >= least
        return pd.Series([[{"cluster": int(c), "bound": row[c]} for c in np.flatnonzero(keep)] for row, keep in zip(bounds, wanted, strict=True)])

    count = F.array(*map(F.lit, parts))
    block = F.pmod(F.xxhash64("uid", F.lit("block")), F.lit(blocks)).cast("int").alias("block")
    listed = items.select("uid", "vec_id", "label", "vector", block, F.explode(lists("vector")).alias("list"))
    listed = listed.select("uid", "vec_id", "label", "vector", "block", "list.*")
    listed = listed.select("*", F.explode(F.sequence(F.lit(0), F.element_at(count, F.col("cluster") + 1) - 1)).alias("part"))
    part = F.pmod(F.xxhash64("uid", F.lit("part")), F.element_at(count, F.col("cluster") + 1)).cast("int").alias("part")
    members = anchors.where(needs.isNotNull()).select("uid", "label", "vector", "windows", "cluster", part, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))

    def meet(anchors: pd.DataFrame, items: pd.DataFrame) -> pd.DataFrame:
        if anchors.empty or items.empty:
            return pd.DataFrame(columns=[c.split()[0] for c in _FOUND.split(", ")])
        best, owner, of = _search(anchors, items, items["bound"].to_numpy(), same, k)
        score = np.clip(best.score, -(2.0**63), 2.0**63 - 1024).astype(np.int64)
        return pd.DataFrame({
            "uid": anchors["uid"].to_numpy()[owner[best.window]], "of": of[best.window], "item": items["uid"].to_numpy()[best.row],
            "vec_id": best.ident, "score": score,
        })

    key = ["cluster", "part", "block"]
    found = members.groupBy(*key).cogroup(listed.groupBy(*key)).applyInPandas(meet, _FOUND)
    ranked = Window.partitionBy("uid", "of").orderBy(F.desc("score"), "vec_id", "item")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)


def mine(
    rows: DataFrame, anchor: Column, vector: str = "embedding", label: str = "label", vec_id: str = "vec_id",
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
) -> DataFrame:
    """The columns of `RESULT`, for the rows that the condition `anchor` names."""
    finite = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.coalesce(finite & (F.size(vector) > 0) & F.col(label).isNotNull() & F.col(vec_id).isNotNull(), F.lit(False))
    items = rows.where(usable).select(
        F.monotonically_increasing_id().alias("uid"), F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"),
        F.col(vector).alias("vector"), F.size(vector).alias("size"), F.coalesce(anchor, F.lit(False)).alias("anchor"),
    )
    items = written(items, "items")  # once stored, the numbers of rows stay as they are
    sizes = items.groupBy("size").agg(F.count(F.lit(1)).alias("n"), F.count_if("anchor").alias("anchors")).where("anchors > 0").collect()
    found = None
    for size, n, anchors in sorted(map(tuple, sizes)):
        part = _mined(items.where(F.col("size") == size), size, n, anchors, positives, negatives, low, high)
        found = part if found is None else found.union(part)
    return found if found is not None else rows.sparkSession.createDataFrame([], RESULT)


def _mined(items: DataFrame, size: int, n: int, count: int, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    def some(rows: DataFrame) -> pd.DataFrame:
        return rows.orderBy(F.xxhash64("uid", F.lit(_DRAW)), "uid").limit(max(1, SAMPLE_VALUES // size)).toPandas()

    own = items.where("anchor")
    centres = centroids(quantised(some(own.select("uid", "vector"))["vector"]), min(CLUSTERS, -(-count // PART_ANCHORS)))
    sample = some(items.select("uid", "vec_id", "label", "vector"))
    blocks = max(1, -(-n * size // BLOCK_VALUES))

    @F.pandas_udf("cluster int, angle double, norm double")
    def homes(vectors: pd.Series) -> pd.DataFrame:
        values = quantised(vectors)
        apart = angles(values, centres)
        home = apart.argmin(axis=1)
        return pd.DataFrame({
            "cluster": home.astype("int32"), "angle": apart[np.arange(len(home)), home], "norm": np.linalg.norm(values, axis=1)
        })

    open_window = F.array(F.struct(F.lit(0).cast("long").alias("of"), *(
        F.lit(float(limit)).alias(name) for name, limit in (("low", "-inf"), ("high", "inf"), ("floor", "-inf"))
    ))).cast(_WINDOWS)
    anchors = own.select("uid", "vec_id", "label", "vector", homes("vector").alias("home"), open_window.alias("windows"))
    anchors = written(anchors.select("uid", "vec_id", "label", "vector", "home.*", "windows"), "anchors")
    best = written(_matched(anchors, items, sample, centres, blocks, True, positives).select(
        "uid", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    ), "positives")
    scaled = F.col("positive_score").cast("double")
    window = F.struct(
        F.col("positive_score").alias("of"), (scaled * low).alias("low"), (scaled * high).alias("high"),
        F.lit(float("-inf")).alias("floor"),
    )
    windows = best.groupBy("uid").agg(F.sort_array(F.collect_set(window)).cast(_WINDOWS).alias("windows"))
    anchors = written(anchors.drop("windows").join(windows, "uid"), "anchors")
    worst = written(_matched(anchors, items, sample, centres, blocks, False, negatives).select(
        "uid", F.col("of").alias("positive_score"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")
    ), "negatives")
    ids = anchors.select("uid", F.col("vec_id").alias("anchor_id"))
    joined = best.join(worst, ["uid", "positive_score"]).join(ids, "uid")
    return joined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
