"""From all-text registry rows to the typed, cleaned table."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastra.functions.casts import to_double, to_int
from cadastra.schema import CORRUPT, CRITICAL_COLUMNS, FIELDS, RAW_COLUMNS


def _typed_column(field) -> Column:
    text = F.col(field.raw)
    if isinstance(field.type, T.IntegerType):
        text = to_int(text)
    elif isinstance(field.type, T.DoubleType):
        text = to_double(text)
    return text.alias(field.name)


def typed_columns() -> list[Column]:
    """The columns of the cleaned table, from raw text."""
    return [_typed_column(f) for f in FIELDS]


def cast_types(raw: DataFrame) -> DataFrame:
    """Raw text columns as the typed columns of the cleaned table; keeps every row."""
    return raw.select(*typed_columns())


def complete(columns: list[str] = CRITICAL_COLUMNS) -> Column:
    """True when none of the critical columns is NULL. NaN counts as a value."""
    return reduce(and_, [F.col(c).isNotNull() for c in columns])


def drop_incomplete(typed: DataFrame) -> DataFrame:
    """Keep the rows that have all critical fields."""
    return typed.filter(complete())


def clean(raw: DataFrame) -> DataFrame:
    """Cast, rename, order the columns and drop rows without critical fields."""
    return drop_incomplete(cast_types(raw))


def cleaning_counts() -> list[Column]:
    """Aggregates over the typed frame: rows before and after cleaning."""
    return [
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(complete()).alias("clean_rows"),
    ]


def clean_metrics(typed: DataFrame) -> DataFrame:
    """Rows before cleaning, after it, and dropped by it, in one pass."""
    return typed.agg(*cleaning_counts()).withColumn(
        "dropped_rows", F.col("total_rows") - F.col("clean_rows")
    )


def read_counts() -> list[Column]:
    """Aggregates over the raw frame: all rows, malformed rows, rows without any value."""
    return [
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col(CORRUPT).isNotNull()).alias("corrupt_rows"),
        F.count_if(F.coalesce(*RAW_COLUMNS).isNull()).alias("empty_rows"),
    ]


def overflowing_ids() -> Column:
    """Aggregate over the raw frame: ids that are whole numbers but do not fit the id's type.

    Such rows are dropped with those that have no id; this says how many they were.
    """
    text = F.trim(FIELDS[0].raw)
    number = text.rlike(r"^[+-]?[0-9]+(\.[0-9]*)?$")
    return F.count_if(number & to_int(F.col(FIELDS[0].raw)).isNull()).alias("overflowing_ids")


def read_report(raw: DataFrame) -> DataFrame:
    """How well the file was read: all rows, malformed rows, rows without any value."""
    return raw.agg(*read_counts())
