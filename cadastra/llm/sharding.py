"""Vector bin packing: documents into shards of nearly equal bytes, tokens and rows.

The groups to place are the documents with equal texts. Groups are summed on the cluster by a digest of the text. Those
above a small share of the whole are placed one by one, and whole if they fit a shard; a group is cut into
pieces by its documents' ids only if it is larger than a shard in one of the sums, or so uneven, by `UNEVEN` of a shard between
its largest and its smallest share, that the shard which holds it could not be filled in all of them. All others are dealt by
their digest into a fixed number of bundles, whose sums take the place of single groups. So what is packed
is bounded by parameters, whatever the number of documents. Groups, pieces
and bundles are placed from large to small; each goes where the dot product of its
(bytes, tokens, rows) with the shard's residual capacity is highest.

Slots number the rows of a shard by id. Rows are counted by (shard, part) first, each
part numbers its own rows, and the parts before it give the offset: no task sees a shard.

Cases: the size of a row is its text's UTF-8 bytes plus `overhead`; a null text has no
bytes and no tokens and forms one group of its own, apart from empty texts. Repeated
rows and null ids are rows like others; ids are ordered with null first,
and rows with equal ids by their text's checksum. An
empty table gives an empty result. Other columns stay; a column with the name of an
output is replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cadastra.llm.columns import Aside
from cadastra.scratch import written

#: Bundles for the groups that are not placed by themselves.
BUNDLES = 4_096
#: A group above this share of any sum is placed by itself: at most 3 x 2,048 of them.
OWN_SHARE = 1 / 2_048
#: A group whose largest and smallest share of one shard are farther apart is cut into pieces that are not.
UNEVEN = 1 / 8
#: Rows of one part of a shard, on average, when slots are numbered.
PART_ROWS = 2_000

_OUTPUTS = ("size", "text_crc32", "shard", "slot")
_DIMENSIONS = ("bytes", "tokens", "rows")


def pack(items: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each item; an item is a row of sums, one column for each dimension."""
    totals = items.sum(axis=0, dtype=float)
    scaled = items / np.where(totals > 0, totals, 1.0) * shards
    residual = np.ones((shards, items.shape[1]))
    placed = np.zeros(len(items), np.int32)
    for at in np.lexsort((np.arange(len(items)), -scaled.max(axis=1, initial=0.0))):
        score = residual @ scaled[at]
        placed[at] = int(np.argmax(score))
        residual[placed[at]] -= scaled[at]
    return placed


def _bundle(group: Column) -> Column:
    return F.pmod(F.xxhash64(group, F.lit("bundle")), F.lit(BUNDLES)).cast("int")


def pieces(group: np.ndarray, totals: np.ndarray, shards: int) -> int:
    """Into how many pieces a group is cut; 1: it stays whole."""
    share = group / np.where(totals > 0, totals, 1.0) * shards
    share = np.where(totals > 0, share, share.max())
    return max(1, int(np.ceil(share.max() - 1e-9)), int(np.ceil((share.max() - share.min()) / UNEVEN - 1e-9)))


def assign(
    docs: DataFrame, shards: int, overhead: int = 8, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """`docs` with `size`, `text_crc32`, `shard` (from 0) and `slot` (gapless from 0 in each shard)."""
    spark, aside = docs.sparkSession, Aside(docs)
    body, ident = aside[text], aside.name(doc_id)
    rows = aside.frame.select(
        *aside.held,
        (F.coalesce(F.octet_length(body), F.lit(0)).cast("long") + overhead).alias("size"),
        F.crc32(F.coalesce(body, F.lit("")).cast("binary")).alias("text_crc32"),
        F.coalesce(F.regexp_count(body, F.lit(r"\S+")), F.lit(0)).cast("long").alias("tokens"),
        F.coalesce(F.md5(body.cast("binary")), F.lit("null")).alias("group"),
    )
    sums = [F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")]
    groups = written(rows.groupBy("group").agg(*sums), "groups")
    total = np.array(groups.agg(*(F.coalesce(F.sum(d), F.lit(0)) for d in _DIMENSIONS)).first(), float)
    least = [F.col(d) > float(t) * OWN_SHARE for d, t in zip(_DIMENSIONS, total, strict=True)]
    own = least[0] | least[1] | least[2]
    bundled = groups.where(~own).groupBy(_bundle(F.col("group")).cast("string").alias("unit"))
    units = [tuple(row) for row in bundled.agg(*(F.sum(d) for d in _DIMENSIONS)).collect()]
    single = [tuple(row) for row in groups.where(own).select("group", *_DIMENSIONS).collect()]
    cuts = [(row[0], pieces(np.array(row[1:], float), total, shards)) for row in single]
    cut = F.broadcast(spark.createDataFrame(cuts, "group string, cuts int"))
    piece = F.pmod(F.xxhash64(ident, F.lit("piece")), F.col("cuts")).cast("string")
    units += [(f"{row[0]}/0", *row[1:]) for row, (_, n) in zip(single, cuts, strict=True) if n == 1]
    if any(n > 1 for _, n in cuts):
        parts = rows.join(cut.where("cuts > 1"), "group").groupBy(F.concat("group", F.lit("/"), piece).alias("unit")).agg(*sums)
        units += [tuple(row) for row in parts.collect()]
    units.sort()
    placed = pack(np.array([row[1:] for row in units], float).reshape(len(units), 3), shards)
    homes = [(row[0], int(shard)) for row, shard in zip(units, placed, strict=True)]
    homes = F.broadcast(spark.createDataFrame(homes, "unit string, shard int"))

    unit = F.when(F.col("cuts").isNull(), _bundle(F.col("group")).cast("string")).otherwise(
        F.concat("group", F.lit("/"), piece)
    )
    parts = max(1, int(total[2] // PART_ROWS // shards) + 1)
    # Rows without an id are dealt by their text, or all of a shard would meet in one part.
    part = F.pmod(F.when(F.col(ident).isNull(), F.xxhash64("group")).otherwise(F.xxhash64(ident, F.lit("part"))), F.lit(parts))
    homed = rows.join(cut, "group", "left").withColumn("unit", unit).join(homes, "unit").withColumn("part", part)
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = homed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("held"))
    offsets = offsets.select("shard", "part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard", "part").orderBy(F.col(ident), F.col("text_crc32"))
    numbered = homed.withColumn("at", F.row_number().over(within) - 1).join(offsets, ["shard", "part"])
    return aside.back(numbered.withColumn("slot", (F.col("offset") + F.col("at")).cast("long")), _OUTPUTS)


def write_shards(assigned: DataFrame, path: str) -> None:
    """One folder for each shard; tasks write the rows they hold, so no task holds a shard."""
    assigned.write.partitionBy("shard").parquet(path)
