"""Means and medians."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T


def mean(df: DataFrame, column: str) -> DataFrame:
    """Mean of any numeric column as one row; NULL when it is empty."""
    return df.agg(F.avg(F.col(column)).alias(f"avg_{column}"))


def year_stats(df: DataFrame, column: str = "year") -> DataFrame:
    """Mean and exact median of a whole-number column as one row; NULLs when it is empty.

    The median is the smallest value that at least half of the rows do not exceed. Columns
    that may hold fractions are refused; `mean` takes them.

    The table is read once, down to a row count per distinct value. The values are
    then searched 16 bits at a time, from the upper ones down, so each ordered step sees
    at most 65,536 rows, whatever the column holds.
    """
    kind = df.schema[column].dataType
    if not isinstance(kind, T.IntegralType):
        raise TypeError(f"{column} is {kind.simpleString()}; the exact median takes whole numbers")
    value = F.col(column)
    kept = kind if isinstance(kind, T.LongType) else T.IntegerType()
    rest = (
        df.filter(value.isNotNull())
        .groupBy(value.cast("bigint").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    everything = W.partitionBy()
    found = None
    for shift in (48, 32, 16, 0) if isinstance(kind, T.LongType) else (16, 0):
        rest = rest.withColumn("high", F.shiftright("value", shift))
        blocks = rest.groupBy("high")
        if found is None:
            ranked = blocks.agg(
                F.sum("n").alias("block_n"),
                F.sum(F.col("value").cast("double") * F.col("n")).alias("block_sum"),
            ).select(
                "high",
                "block_n",
                F.lit(0).cast("bigint").alias("before"),
                F.sum("block_n").over(everything).alias("total"),
                F.sum("block_sum").over(everything).alias("total_sum"),
            )
        elif shift:
            carried = [F.max(c).alias(c) for c in ("before", "total", "total_sum")]
            ranked = blocks.agg(F.sum("n").alias("block_n"), *carried)
        else:  # each block is one value, and has one row already
            ranked = rest.withColumnRenamed("n", "block_n")
        half = F.col("total") / 2
        # Exactly one block holds the middle row, so one row is broadcast.
        found = (
            ranked.withColumn("up_to", F.col("before") + F.sum("block_n").over(W.orderBy("high")))
            .withColumn("before", F.col("up_to") - F.col("block_n"))
            .filter((F.col("before") < half) & (F.col("up_to") >= half))
            .select(F.col("high").alias("middle"), "before", "total", "total_sum")
        )
        # Null-safe, so that no filter is inferred that would keep the uses of the
        # counts from sharing one shuffle.
        rest = rest.select("value", "n", "high").join(
            F.broadcast(found), F.col("high").eqNullSafe(F.col("middle"))
        ).drop("middle")
    return found.agg(
        (F.max("total_sum") / F.max("total")).alias(f"avg_{column}"),
        F.max("middle").cast(kept).alias(f"median_{column}"),
    )


def approx_median(df: DataFrame, column: str = "year", error: float = 0.01) -> DataFrame:
    """A value of the column whose rank is within `error` of the middle, as one row."""
    return df.agg(
        F.percentile_approx(column, 0.5, round(1 / error)).cast("double").alias("approx_median")
    )


def approx_median_check(df: DataFrame, column: str = "year", error: float = 0.01) -> DataFrame:
    """The approximate median, the row count, and whether its rank keeps the bound."""
    return median_check(df, column, approx_median(df, column, error), error)


def median_check(df: DataFrame, column: str, median: DataFrame, error: float = 0.01) -> DataFrame:
    """The given one-row median, the row count, and whether its rank is within `error` of the middle."""
    median = median.scalar()
    present = df.filter(F.col(column).isNotNull())
    ranks = present.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(column) < median).alias("below"),
        F.count_if(F.col(column) <= median).alias("up_to"),
        F.max(median).alias("approx_median"),
    )
    in_bound = (F.col("below") <= F.col("n") * (0.5 + error)) & (
        F.col("up_to") >= F.col("n") * (0.5 - error)
    )
    return ranks.select("n", "approx_median", in_bound.alias("within_bound"))
