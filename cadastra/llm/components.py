"""Connected components of a graph that is too large for one machine.

Rounds of two star operations on the whole edge table: each node hands its larger
neighbours, and then its smaller ones, to the smallest node it knows. The graph shrinks
to one star per component, whose centre is the smallest node, in a number of rounds
that grows with the logarithm of the component's size. Every round is joins and
partial aggregations on the node, so a centre with very many edges is split by Spark's
skew handling. Every round is stored in the shared folder, and those before it are deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.scratch import delete, new_folder


def _stored(edges: DataFrame) -> tuple[DataFrame, str]:
    spark, path = edges.sparkSession, new_folder(edges.sparkSession, "edges")
    edges.write.parquet(path)
    return spark.read.schema(edges.schema).parquet(path), path


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root) of every node that an edge names; root is the component's smallest node.

    Repeated edges, both directions of an edge, loops and null ends are allowed; loops and
    edges with a null end connect nothing. No edges: no rows.
    """
    a, b = F.col(left), F.col(right)
    edges = edges.where(a != b).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct()
    spark = edges.sparkSession
    edges, path = _stored(edges)
    state = _state(edges)
    while state[0]:
        both = edges.select(F.col("hi").alias("node"), F.col("lo").alias("other")).union(edges.select("lo", "hi"))
        smallest = both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("least"))
        outward = (
            both.join(smallest, "node").where(F.col("other") > F.col("node"))
            .select(F.col("other").alias("hi"), F.col("least").alias("lo")).distinct()
        )
        outward, between = _stored(outward)
        parents = outward.groupBy("hi").agg(F.min("lo").alias("least"))
        inward = outward.join(parents, "hi")
        edges = (
            inward.where(F.col("lo") != F.col("least")).select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
            .union(parents.select("hi", "least")).distinct()
        )
        edges, after = _stored(edges)
        for folder in (path, between):
            delete(spark, folder)
        path = after
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(
        edges.select("lo", "lo").distinct()
    )
