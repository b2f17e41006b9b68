"""Text forms of values for printed reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def two_decimals(value: Column) -> Column:
    """Two decimals, rounded by the exact binary value (`printf('%.2f')`).

    `format_string` rounds the printed decimal digits instead and differs on ties.
    """
    return F.call_function("format_number", value, F.lit("0.00"))


def or_missing(value: Column) -> Column:
    """The number as text; `N/A` when it is NULL or zero."""
    return F.coalesce(F.nullif(value, F.lit(0)).cast("string"), F.lit("N/A"))


def shortened(text: Column, length: int) -> Column:
    """The first characters of a text, to fit a report column."""
    return F.substring(text, 1, length)
