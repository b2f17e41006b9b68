"""Table profiles: row counts, NULLs, column types, samples, run metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def quoted(name: str) -> Column:
    """A column by its whole name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def null_counts(columns: list[str]) -> list[Column]:
    """Aggregates for `null_profile`: the row count and the NULLs of every column."""
    nulls = [F.count_if(quoted(c).isNull()).alias(f"nulls_{c}") for c in columns]
    return [F.count(F.lit(1)).alias("total"), *nulls]


def as_null_profile(counts: DataFrame, columns: list[str]) -> DataFrame:
    """The one row of `null_counts` as a row per column, with percentages."""
    rows = [
        F.struct(F.lit(c).alias("column"), quoted(f"nulls_{c}").alias("nulls")) for c in columns
    ]
    percent = F.when(F.col("total") > 0, F.col("nulls") / F.col("total") * 100).otherwise(0.0)
    return counts.select("total", F.inline(F.array(*rows))).select(
        "column", "nulls", percent.alias("pct")
    )


def null_profile(df: DataFrame) -> DataFrame:
    """NULL count and percentage of every column, from a single pass over the table."""
    return as_null_profile(df.agg(*null_counts(df.columns)), df.columns)


def schema_profile(df: DataFrame) -> DataFrame:
    """Position, name and type of every column. Reads no rows of the table."""
    rows = [
        F.struct(F.lit(i).alias("position"), F.lit(name).alias("name"), F.lit(kind).alias("type"))
        for i, (name, kind) in enumerate(df.dtypes, 1)
    ]
    return df.sparkSession.range(1).select(F.inline(F.array(*rows)))


def head_sample(df: DataFrame, n: int = 5, by: str = "id") -> DataFrame:
    """The first rows in the order of `by`."""
    return df.orderBy(F.col(by).asc_nulls_last()).limit(n)


def run_metrics(*one_row_frames: DataFrame) -> DataFrame:
    """Named numbers of a run as (metric, value) rows."""
    long = [
        frame.select(*[F.col(c).cast("double").alias(c) for c in frame.columns]).unpivot(
            [], frame.columns, "metric", "value"
        )
        for frame in one_row_frames
    ]
    return reduce(DataFrame.unionByName, long)
