"""Loads whose files hold ranges of the key, and that replace a table all at once.

Rows are dealt to files by sampled bounds of the key, so a lookup by key reads one file.
A key that repeats very often would fill one task; its rows are dealt by a hash of the
other columns as well, and then its range is shared by neighbouring files. Which file
holds which range is stored beside the table, a row for each file.

Each task sends the driver a sample of the key and its counts. Many small files are
therefore cut from the sorted rows of fewer tasks.

A load is written to a folder of its own, compared with its source, and becomes the
table by a change of the table's location. A load that fails changes nothing.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadastra.operators.reconcile import content_reconciliation
from cadastra.schema import CLEAN
from cadastra.sources.tables import ensure_database, ensure_table

ROWS_PER_FILE = 5_000_000
# Up to so many files are a task each; more are cut from tasks of about so many rows, or from this many tasks.
LEAST_TASKS, ROWS_PER_TASK = 200, 1_000_000
MANIFEST = "file string, low bigint, high bigint, n bigint"


def manifest_path(path: str) -> str:
    return f"{path.rstrip('/')}-ranges"


def write_ranges(
    df: DataFrame, path: str, key: str = "id", rows_per_file: int = ROWS_PER_FILE, rows: int | None = None
) -> None:
    """Write files that hold ranges of a whole-number key, ordered by it; `rows` spares a count if known."""
    rows = df.count() if rows is None else rows
    files = max(1, -(-rows // rows_per_file))
    tasks = min(files, max(LEAST_TASKS, -(-rows // ROWS_PER_TASK)))
    others = [c for c in df.columns if c != key]
    salt = F.xxhash64(*others) if others else F.lit(0)
    dealt = df.repartitionByRange(tasks, F.col(key), salt).sortWithinPartitions(key)
    # Where each file is a task, sampled bounds decide how many rows it has.
    cut = {"maxRecordsPerFile": rows_per_file} if tasks < files else {}
    dealt.write.mode("overwrite").options(**cut).parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    place = F.col("_metadata.file_path").alias("file")
    number = F.col(key).cast("bigint")
    ranges = written.groupBy(place).agg(
        F.min(number).alias("low"), F.max(number).alias("high"), F.count(F.lit(1)).alias("n")
    )
    ranges.coalesce(1).write.mode("overwrite").parquet(manifest_path(path))


def ranges(spark: SparkSession, path: str) -> DataFrame:
    """The range of each file, and whether it starts at or before the end of one before it.

    Files of one task follow each other in its sorted rows; two of them may share a key
    that repeats where the first was full, which is no overlap.
    """
    stored = spark.read.schema(MANIFEST).parquet(manifest_path(path))
    # A row for each file: few, whatever the table holds.
    order = Window.orderBy("low", "high", "file")
    end = F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    task = F.regexp_extract("file", r"(part-\d+)[^/]*$", 1)
    apart = task != F.lag(task).over(order)
    overlaps = (F.col("low") < end) | ((F.col("low") == end) & apart)
    return stored.withColumn("overlaps", F.coalesce(overlaps, F.lit(False)))


def lookup(spark: SparkSession, path: str, values: list[int], key: str = "id", schema=CLEAN) -> DataFrame:
    """The rows with these keys, from the files whose ranges may hold them."""
    stored = spark.read.schema(MANIFEST).parquet(manifest_path(path))
    wanted = spark.createDataFrame([(v,) for v in sorted(set(values))], "value bigint")
    inside = F.col("value").between(F.col("low"), F.col("high"))
    files = [r.file for r in stored.join(F.broadcast(wanted), inside).select("file").distinct().collect()]
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*files).where(F.col(key).isin(*map(int, values)))


def location(spark: SparkSession, table: str) -> str | None:
    """Where the table's files are; None if there is no table."""
    if not spark.catalog.tableExists(table):
        return None
    told = spark.sql("DESCRIBE FORMATTED IDENTIFIER(:t)", args={"t": table})
    return told.where("col_name = 'Location'").first()["data_type"]


def load_swapped(
    df: DataFrame, table: str, root: str, key: str = "id", rows_per_file: int = ROWS_PER_FILE, rows: int | None = None
) -> DataFrame:
    """Replace the table's rows at once, by a load below `root`; returns how its content compares.

    Until the last step the table has its old rows, and their files stay for the caller
    to delete. Raises, and leaves the table alone, where the load differs from its source.
    """
    spark = df.sparkSession
    path = f"{root.rstrip('/')}/load-{uuid4().hex}"
    source = df.select(*CLEAN.names)
    write_ranges(source, path, key, rows_per_file, rows)
    report = content_reconciliation(source, spark.read.schema(CLEAN).parquet(path)).persist()
    if differing := [r["column"] for r in report.where(~F.col("matches")).collect()]:
        raise ValueError(f"the load at {path} differs from its source in {differing}")
    ensure_database(spark, table.rpartition(".")[0] or "default")
    ensure_table(spark, table, path)
    spark.sql("ALTER TABLE IDENTIFIER(:t) SET LOCATION :p", args={"t": table, "p": path})
    spark.catalog.refreshTable(table)
    return report
