"""The cleaned table as Parquet files, and files that can be searched by values.

A row group tells by its least and greatest value what it cannot hold, which helps only
where the rows are ordered by the column. For lookups by other columns a row group
carries a Bloom filter of each column with many values; of one with few values its
dictionary says the same. Row groups are small, so that a lookup reads little.

A writer holds the filters and statistics of all row groups of a file until it closes the
file. A filter is therefore bounded by a share of its row group, and a file of small row
groups has fewer rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastra.schema import CLEAN

ROWS_PER_FILE = 10_000_000
ROW_GROUP_BYTES = 16 << 20
# The largest filter is this part of its row group; the writer also holds smaller ones, together as large again.
FILTER_PART = 16
# A longer list of values reaches the files only as its least and greatest one.
PUSHED_VALUES = 10


def write_clean(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Replace the table at `path`: one file or more per task, none above the row bound.

    `path` must not be one that `df` reads from.
    """
    df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path)


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    """The cleaned table; the fixed schema spares the footer read for inference."""
    return spark.read.schema(CLEAN).parquet(path)


def write_searchable(
    df: DataFrame,
    path: str,
    blooms: Sequence[str] = ("id",),
    row_group_bytes: int = ROW_GROUP_BYTES,
    rows_per_file: int | None = None,
) -> None:
    """Replace the table at `path` by files that `find` need not read whole.

    `blooms` are the columns with many values; a filter grows with the values of its row
    group. A name with dots is that of a field within a struct. A file has `rows_per_file`
    rows at most, by default fewer where row groups are smaller. No shuffle.
    """
    if rows_per_file is None:
        rows_per_file = max(1, min(ROWS_PER_FILE, ROWS_PER_FILE * row_group_bytes // ROW_GROUP_BYTES))
    options = {
        "parquet.block.size": row_group_bytes,
        "parquet.bloom.filter.adaptive.enabled": True,
        "parquet.bloom.filter.max.bytes": max(1 << 10, row_group_bytes // FILTER_PART),
    }
    options |= {f"parquet.bloom.filter.enabled#{column}": True for column in blooms}
    df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).options(**options).parquet(path)


def find(
    spark: SparkSession, path: str, column: str, values: Sequence[Any], schema: T.StructType = CLEAN
) -> DataFrame:
    """The rows that have one of the values; NULL, given or stored, is equal to nothing.

    The values are asked for in lists that are short enough to be compared with the
    filters and dictionaries of each row group.
    """
    wanted = list(dict.fromkeys(v for v in values if v is not None))
    lists = [wanted[i : i + PUSHED_VALUES] for i in range(0, len(wanted), PUSHED_VALUES)]
    named = F.col("`" + column.replace("`", "``") + "`")
    return spark.read.schema(schema).parquet(path).where(reduce(or_, map(named.isin, lists), F.lit(False)))
