"""Fixed-width buckets such as decades."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucket(value: Column, width: int, whole: bool = False) -> Column:
    """Lower edge of the bucket as bigint, rounding down for negative values as well.

    `whole` says that the value is a whole number, whose edge is then exact beyond 53 bits
    too. NULL for NaN and for edges outside 64 bits.
    """
    if whole:
        return F.try_subtract(value.cast("bigint"), F.pmod(value.cast("bigint"), F.lit(width)))
    steps = F.floor(F.nanvl(value / width, F.lit(None).cast("double")))
    return F.try_multiply(steps, F.lit(width)).cast("bigint")


def bucket_label(edge: Column) -> Column:
    """`1950` becomes `1950s`."""
    return F.concat(edge.cast("string"), F.lit("s"))
