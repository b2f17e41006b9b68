"""Column names and types of the registry files and of the cleaned table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    """One registry field: its header in the file, its name and type once cleaned."""

    raw: str
    name: str
    type: T.DataType
    critical: bool = False


# File headers, cleaned names and types, in documented file order.
# The header `population` holds the floor count; change the mapping here if a
# source says otherwise.
FIELDS = (
    Field("house_id", "id", T.IntegerType(), critical=True),
    Field("latitude", "latitude", T.DoubleType()),
    Field("longitude", "longitude", T.DoubleType()),
    Field("maintenance_year", "year", T.IntegerType(), critical=True),
    Field("square", "area", T.DoubleType(), critical=True),
    Field("population", "floors", T.IntegerType()),
    Field("region", "region", T.StringType()),
    Field("locality_name", "city", T.StringType()),
    Field("address", "address", T.StringType()),
    Field("description", "description", T.StringType()),
)

RAW_COLUMNS = [f.raw for f in FIELDS]
CLEAN_COLUMNS = [f.name for f in FIELDS]
CRITICAL_COLUMNS = [f.name for f in FIELDS if f.critical]

CORRUPT = "_corrupt_record"

CLEAN = T.StructType([T.StructField(f.name, f.type, True) for f in FIELDS])


def text_schema(names: list[str]) -> T.StructType:
    """All-string schema for a file with these columns, plus the malformed-row column."""
    return T.StructType([T.StructField(n, T.StringType(), True) for n in [*names, CORRUPT]])
