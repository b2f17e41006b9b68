"""Grouped counts, ranges and extremes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastra.functions.buckets import bucket, bucket_label
from cadastra.scratch import written


def top_groups(df: DataFrame, key: str, n: int = 10) -> DataFrame:
    """The `n` groups with most rows; NULL is a group. Equal counts rank by key."""
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), F.col(key).asc_nulls_last())
        .limit(n)
    )


def _ranges(df: DataFrame, group: str, value: str) -> DataFrame:
    return (
        df.filter(F.col(value).isNotNull())
        .groupBy(group)
        .agg(
            F.max(value).alias(f"max_{value}"),
            F.min(value).alias(f"min_{value}"),
            F.count(F.lit(1)).alias("n"),
        )
    )


def value_ranges(df: DataFrame, group: str = "region", value: str = "area") -> DataFrame:
    """Largest and smallest value and row count per group, largest first.

    NaN counts as the largest value, as it does in Spark's `max`.
    """
    return _largest_first(_ranges(df, group, value), group, value)


def _largest_first(ranges: DataFrame, group: str, value: str) -> DataFrame:
    return ranges.orderBy(F.col(f"max_{value}").desc_nulls_last(), F.col(group).asc_nulls_last())


def range_series(
    df: DataFrame,
    group: str = "region",
    value: str = "area",
    n: int = 15,
    ranges: DataFrame | None = None,
) -> DataFrame:
    """Chart data: the two series, max and min, of the first `n` groups.

    `ranges` is a stored result of `value_ranges`, which saves its pass over the table.
    """
    ranges = _ranges(df, group, value) if ranges is None else ranges
    return (
        _largest_first(ranges, group, value)
        .limit(n)
        .unpivot([group], [f"max_{value}", f"min_{value}"], "series", "value")
    )


def extreme_rows(
    df: DataFrame,
    group: str = "region",
    value: str = "area",
    tie: str = "id",
    largest: bool = True,
    ranges: DataFrame | None = None,
) -> DataFrame:
    """The whole row with the largest (or smallest) value of each group, lowest `tie` first.

    Sorting whole rows by group would dominate on a large table. Instead one pass
    over two columns finds each group's range by hash aggregation, which is
    written right away as a small table; a stored result of `value_ranges` may be
    given as `ranges` instead. Its known size lets Catalyst broadcast it, or
    shuffle when there are too many groups. A second pass finds the first `tie` among the
    rows that reach their group's extreme, again over narrow columns, and a third
    fetches the rows that have both, so many equal values cost no wide rows.
    """
    if ranges is None:
        ranges = written(_ranges(df, group, value), "ranges")
    extreme = f"max_{value}" if largest else f"min_{value}"
    extremes = ranges.select(F.col(group).alias("_group"), F.col(extreme).alias("_extreme"))
    reaches = F.col(group).eqNullSafe(F.col("_group")) & (F.col(value) == F.col("_extreme"))
    ties = df.select(group, value, tie).join(extremes, reaches).groupBy("_group", "_extreme")
    firsts = written(ties.agg(F.min(tie).alias("_tie")), "ties")
    # The least id that is not NULL, or NULL where there is no other.
    chosen = df.join(firsts, reaches & F.col(tie).eqNullSafe(F.col("_tie")))
    # Rows that share the tie-breaking value as well are ordered by all columns.
    first = F.min(F.struct(*df.columns))
    return chosen.groupBy("_group").agg(first.alias("_row")).select("_row.*")


def bucket_counts(
    df: DataFrame, column: str = "year", width: int = 10, name: str = "decade"
) -> DataFrame:
    """Rows per fixed-width bucket, in bucket order.

    Edges are int for an int column and bigint for any other number, so that no two
    buckets of a wide column are merged.
    """
    kind = df.schema[column].dataType
    edge = bucket(F.col(column), width, isinstance(kind, T.IntegralType))
    if isinstance(kind, T.IntegralType) and not isinstance(kind, T.LongType):
        edge = edge.try_cast("int")
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(edge.alias(name))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col(name).asc_nulls_last())
    )


def decade_series(df: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Chart data: buildings per decade with a label; `counts` is a stored `bucket_counts`."""
    counts = bucket_counts(df) if counts is None else counts.orderBy(F.col("decade").asc_nulls_last())
    return counts.select("decade", bucket_label(F.col("decade")).alias("label"), "n")
