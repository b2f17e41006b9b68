"""Rows that cleaning rejects, kept with the reason and their text.

One parse feeds both sinks: a single write puts accepted and rejected rows into a folder
each, below one root, so nothing is read twice and no row is in neither.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cadastra.operators import cleaning, profile
from cadastra.schema import CLEAN, CLEAN_COLUMNS, CORRUPT, FIELDS, RAW_COLUMNS
from cadastra.sources.parquet import ROWS_PER_FILE

ACCEPTED, REJECTED = "accepted", "rejected"
REJECTS = "reason string, raw string, malformed boolean"


def reason() -> Column:
    """Over raw rows: what each critical field lacks, as `no id, bad area`; empty where nothing is missing."""
    typed = dict(zip((f.name for f in FIELDS), cleaning.typed_columns(), strict=True))
    parts = []
    for f in FIELDS:
        if f.critical:
            blank = F.coalesce(F.trim(f.raw), F.lit("")) == ""
            parts.append(F.when(typed[f.name].isNull(), F.concat(F.when(blank, "no ").otherwise("bad "), F.lit(f.name))))
    return F.concat_ws(", ", *parts)


def sorted_out(raw: DataFrame) -> DataFrame:
    """Every raw row: typed columns, the reason of its rejection, its text, and which sink it goes to."""
    if CORRUPT not in raw.columns:
        raw = raw.withColumn(CORRUPT, F.lit(None).cast("string"))
    text = F.coalesce(CORRUPT, F.to_json(F.struct(*RAW_COLUMNS)))
    rows = raw.select(
        *cleaning.typed_columns(), reason().alias("reason"), text.alias("raw"), F.col(CORRUPT).isNotNull().alias("malformed")
    )
    rejected = F.col("reason") != ""
    return rows.select(
        *CLEAN_COLUMNS,
        *(F.when(rejected, F.col(c)).alias(c) for c in ("reason", "raw", "malformed")),
        F.when(rejected, REJECTED).otherwise(ACCEPTED).alias("outcome"),
    )


def write_sinks(raw: DataFrame, root: str, rows_per_file: int = ROWS_PER_FILE) -> dict[str, int]:
    """Write both sinks below `root` from one parse; returns what the writing tasks counted.

    Keys: `read_rows`, `accepted_rows`, `rejected_rows`, and `nulls_` of each column of the accepted ones.
    """
    seen = Observation("sinks")
    accepted = F.col("outcome") == ACCEPTED
    rows = sorted_out(raw).observe(
        seen,
        F.count(F.lit(1)).alias("read_rows"),
        F.count_if(accepted).alias("accepted_rows"),
        F.count_if(~accepted).alias("rejected_rows"),
        *(F.count_if(accepted & profile.quoted(c).isNull()).alias(f"nulls_{c}") for c in CLEAN_COLUMNS),
    )
    rows.write.mode("overwrite").partitionBy("outcome").option("maxRecordsPerFile", rows_per_file).parquet(root)
    return seen.get


def accepted_path(root: str) -> str:
    return f"{root.rstrip('/')}/outcome={ACCEPTED}"


def _sink(spark: SparkSession, root: str, outcome: str, schema) -> DataFrame:
    # The table's schema, so that a sink without rows is an empty one and not a missing folder.
    whole = f"{CLEAN.toDDL()}, {REJECTS}, outcome string"
    rows = spark.read.schema(whole).parquet(root).where(F.col("outcome") == outcome)
    return rows.select(*schema)


def read_accepted(spark: SparkSession, root: str) -> DataFrame:
    """The cleaned table."""
    return _sink(spark, root, ACCEPTED, CLEAN_COLUMNS)


def read_rejected(spark: SparkSession, root: str) -> DataFrame:
    """(reason, raw, malformed) of every rejected row."""
    return _sink(spark, root, REJECTED, [c.split()[0] for c in REJECTS.split(", ")])


def rejects_by_reason(rejected: DataFrame) -> DataFrame:
    """How many rows were rejected for which reason."""
    return rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "reason")
