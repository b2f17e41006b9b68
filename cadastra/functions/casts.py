"""Text to number, never raising on dirty values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Blanks and control characters around the number are ignored, as in Spark's own cast.
_PADDING = r"[\x00-\x20\x7f]*"
_WHOLE_PART = rf"^{_PADDING}([+-]?\d+)(?:\.\d*)?{_PADDING}$"


def to_int(text: Column) -> Column:
    """Whole part of a decimal number, cut toward zero; NULL when it is not one.

    Exponents, digit groups and values outside 32 bits give NULL. `try_cast` alone
    turns `1953.0` into NULL, and each failed cast costs ten times a good one, so
    only texts that are numbers reach it.
    """
    whole = F.regexp_extract(text, _WHOLE_PART, 1)
    return F.nullif(whole, F.lit("")).try_cast("int")


def to_double(text: Column) -> Column:
    """Floating-point number, NULL when the text is not one; `NaN` stays NaN."""
    return text.try_cast("double")
