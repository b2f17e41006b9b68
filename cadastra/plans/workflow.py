"""The whole run: ingest once, clean once, analyse the cleaned table, load it, report.

Every step reads the stored cleaned table, never the CSV again, and stores its
result as Parquet below the output folder. The session is the caller's: nothing
here changes its settings or stops it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cadastra.operators import cleaning, groups, profile, quarantine, reconcile, statistics, topk
from cadastra.schema import CORRUPT
from cadastra.sources import csv_files, jdbc, loads, parquet, tables


@dataclass(frozen=True)
class RunSettings:
    """Where a run reads and writes."""

    csv_path: str
    out_dir: str
    table: str = "registry.houses"
    header: bool = True
    encoding: str = "UTF-16LE"
    layout: str = "auto"
    keep_rejected: bool = True
    external: jdbc.JdbcTarget | None = None

    def path(self, name: str) -> str:
        return f"{self.out_dir.rstrip('/')}/{name}"


@dataclass(frozen=True)
class Prepared:
    """What the writing pass counted: how the file was read, rows before and after
    cleaning, NULLs per column."""

    report: DataFrame
    counts: DataFrame
    null_profile: DataFrame


def prepare(raw: DataFrame, path: str) -> Prepared:
    """Write the cleaned table from a single parse, counting along the way.

    The counts are taken in the same tasks that write the files, so they need no
    pass of their own. Each of these tasks counts once, also when an executor is
    lost and its tasks run again.
    """
    if CORRUPT not in raw.columns:
        raw = raw.withColumn(CORRUPT, F.lit(None).cast("string"))
    reading = Observation("reading")
    before, after = Observation("before cleaning"), Observation("after cleaning")
    read = raw.observe(reading, *cleaning.read_counts(), cleaning.overflowing_ids())
    typed = cleaning.cast_types(read).observe(before, *cleaning.cleaning_counts())
    clean = cleaning.drop_incomplete(typed)
    parquet.write_clean(clean.observe(after, *profile.null_counts(clean.columns)), path)
    return Prepared(
        one_row(raw.sparkSession, reading.get),
        one_row(raw.sparkSession, before.get),
        profile.as_null_profile(one_row(raw.sparkSession, after.get), clean.columns),
    )


def prepare_sinks(raw: DataFrame, root: str) -> Prepared:
    """`prepare` with two sinks: the cleaned table, and the rejected rows with reason and text, below `root`.

    The same single parse writes and counts both.
    """
    if CORRUPT not in raw.columns:
        raw = raw.withColumn(CORRUPT, F.lit(None).cast("string"))
    reading = Observation("reading")
    read = raw.observe(reading, *cleaning.read_counts(), cleaning.overflowing_ids())
    seen = quarantine.write_sinks(read, root)
    spark, columns = raw.sparkSession, parquet.CLEAN.names
    nulls = {"total": seen["accepted_rows"], **{f"nulls_{c}": seen[f"nulls_{c}"] for c in columns}}
    return Prepared(
        one_row(spark, reading.get),
        one_row(spark, {"total_rows": seen["read_rows"], "clean_rows": seen["accepted_rows"]}),
        profile.as_null_profile(one_row(spark, nulls), columns),
    )


def one_row(spark: SparkSession, numbers: dict[str, int]) -> DataFrame:
    return spark.range(1).select(*[F.lit(n).cast("bigint").alias(k) for k, n in numbers.items()])


def analyses(houses: DataFrame) -> dict[str, DataFrame]:
    """Every analytic over the cleaned table, by name; nothing runs until written."""
    return {
        "schema_profile": profile.schema_profile(houses),
        "head_sample": profile.head_sample(houses, 10),
        "year_stats": statistics.year_stats(houses),
        "year_median_approx": statistics.approx_median(houses),
        "top_regions": groups.top_groups(houses, "region"),
        "top_cities": groups.top_groups(houses, "city"),
        "area_by_region": groups.value_ranges(houses),
        "by_decade": groups.bucket_counts(houses),
    }


def load(houses: DataFrame, table: str, path: str) -> DataFrame:
    """Create the table if needed, replace its rows, and compare the row counts."""
    spark = houses.sparkSession
    tables.ensure_database(spark, table.rpartition(".")[0] or "default")
    tables.ensure_table(spark, table, path)
    tables.load_table(houses, table)
    return tables.reconcile(houses, spark.table(table))


def load_swapped(houses: DataFrame, table: str, path: str, rows: int | None = None) -> DataFrame:
    """Replace the table's rows at once, in files by ranges of the id, and compare the contents."""
    return loads.load_swapped(houses, table, path, rows=rows)


def load_external(
    houses: DataFrame, target: jdbc.JdbcTarget, connections: int | None = None
) -> DataFrame:
    """Replace the rows of an external database table, and compare the row counts."""
    jdbc.write_jdbc(houses, target, connections=connections)
    return tables.reconcile(houses, jdbc.read_jdbc(houses.sparkSession, target))


def run(spark: SparkSession, settings: RunSettings) -> dict[str, str]:
    """Run everything; returns the path of each stored result by name."""
    stored = {}

    def store(name: str, result: DataFrame) -> None:
        stored[name] = settings.path(name)
        result.write.mode("overwrite").parquet(stored[name])

    raw = csv_files.read_raw(
        spark, settings.csv_path, settings.header, settings.encoding, settings.layout
    )
    clean_path = settings.path("houses")
    if settings.keep_rejected:
        prepared = prepare_sinks(raw, clean_path)
        houses = quarantine.read_accepted(spark, clean_path)
        store("rejects_by_reason", quarantine.rejects_by_reason(quarantine.read_rejected(spark, clean_path)))
    else:
        prepared = prepare(raw, clean_path)
        houses = parquet.read_clean(spark, clean_path)
    store("prepare_report", prepared.report)
    store("null_profile", prepared.null_profile)
    for name, result in analyses(houses).items():
        store(name, result)
    # What follows from a stored result is derived from it, without the table.
    ranges = spark.read.parquet(stored["area_by_region"])
    decades = spark.read.parquet(stored["by_decade"])
    store("area_series", groups.range_series(houses, ranges=ranges))
    store("decade_series", groups.decade_series(houses, decades))
    store("largest_in_region", groups.extreme_rows(houses, ranges=ranges))
    store("smallest_in_region", groups.extreme_rows(houses, largest=False, ranges=ranges))

    table_counts = profile.row_count(houses).selectExpr("n AS row_count", "n AS clean_count")
    years = spark.read.parquet(stored["year_stats"])
    store("run_metrics", profile.run_metrics(prepared.counts, table_counts, years))
    rows = prepared.counts.first()["clean_rows"]
    contents = load_swapped(houses, settings.table, settings.path("table"), rows)
    store("load_reconcile_content", contents)
    stored_contents = spark.read.parquet(stored["load_reconcile_content"])
    store("load_reconcile", stored_contents.where(F.col("column") == reconcile.ROWS).drop("column"))
    if settings.external:
        store("external_reconcile", load_external(houses, settings.external))
    store("top_houses", topk.top_houses(spark, spark.table(settings.table)))
    top = spark.read.parquet(stored["top_houses"])
    order = [F.col("area").desc_nulls_last(), F.col("id").asc_nulls_last()]
    store("topk_report", topk.topk_report(top.orderBy(*order)))
    return stored
