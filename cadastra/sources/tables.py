"""The cleaned rows as a catalog table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.schema import CLEAN


def ensure_database(spark: SparkSession, database: str) -> None:
    spark.sql("CREATE DATABASE IF NOT EXISTS IDENTIFIER(:db)", args={"db": database})


def ensure_table(spark: SparkSession, table: str, path: str) -> None:
    """Create the typed external table at `path` unless it is there."""
    if spark.catalog.tableExists(table):
        return
    spark.catalog.createTable(table, path=path, source="parquet", schema=CLEAN)


def load_table(df: DataFrame, table: str, key: str = "id", append: bool = False) -> None:
    """Write the rows into the table; a second load replaces the first.

    Each file is ordered by the key, which lets reads by key skip row groups. The
    order is local to the task: no row is shuffled, so a key that repeats often
    cannot overload one of them.
    """
    rows = df.select(*CLEAN.names).sortWithinPartitions(key)
    rows.write.insertInto(table, overwrite=not append)


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """Names of the database's tables, without the session's temporary views."""
    return (
        spark.sql("SHOW TABLES IN IDENTIFIER(:db)", args={"db": database})
        .filter(~F.col("isTemporary"))
        .select(F.col("tableName").alias("table_name"))
    )


def reconcile(source: DataFrame, target: DataFrame) -> DataFrame:
    """Row counts of source and target, and whether they agree."""
    rows = F.count(F.lit(1)).alias("rows")
    sides = (
        source.agg(rows)
        .select("rows", F.lit("source").alias("side"))
        .unionByName(target.agg(rows).select("rows", F.lit("target").alias("side")))
    )
    return sides.agg(
        F.max(F.when(F.col("side") == "source", F.col("rows"))).alias("source_rows"),
        F.max(F.when(F.col("side") == "target", F.col("rows"))).alias("target_rows"),
    ).withColumn("matches", F.col("source_rows") == F.col("target_rows"))
