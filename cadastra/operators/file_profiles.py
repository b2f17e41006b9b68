"""Profiles that grow with a table: a state for each file, merged when asked for.

The state of a file is its row count, the NULLs of each column, and a quantile sketch
of each whole-number column asked for. A new file costs a scan of its own; the table's profile and
medians follow from the states alone, in any order of loads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastra.operators.profile import as_null_profile, null_counts

#: Size of the sketches; 400 keeps ranks within about 0.7 %.
SKETCH_SIZE = 400


def _files(spark: SparkSession, path: str) -> DataFrame:
    """Names of the table's files, as readers take them and as rows tell them. Reads no contents."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(path)
    return listed.select("path", F.col("_metadata.file_path").alias("file"))


def _state_schema(schema: T.StructType, sketched: list[str]) -> str:
    counts = ", ".join(f"`nulls_{c}` bigint" for c in schema.names)
    return f"file string, total bigint, {counts}" + "".join(f", `sketch_{c}` binary" for c in sketched)


def _state(spark: SparkSession, state_path: str, schema: T.StructType, sketched: list[str]) -> DataFrame:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(state_path)
    there = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)
    told = _state_schema(schema, sketched)
    return spark.read.schema(told).parquet(state_path) if there else spark.createDataFrame([], told)


def update(spark: SparkSession, path: str, state_path: str, schema: T.StructType, sketched: list[str] = ()) -> list[str]:
    """Add the states of files that have none yet; returns their paths."""
    known = _state(spark, state_path, schema, list(sketched)).select("file")
    new = sorted(r["path"] for r in _files(spark, path).join(known, "file", "left_anti").collect())
    if new:
        rows = spark.read.schema(schema).parquet(*new).select("*", F.col("_metadata.file_path").alias("file"))
        sketches = [F.kll_sketch_agg_bigint(F.col(c).cast("bigint"), F.lit(SKETCH_SIZE)).alias(f"sketch_{c}") for c in sketched]
        states = rows.groupBy("file").agg(*null_counts(schema.names), *sketches)
        states.write.mode("append").parquet(state_path)
    return new


def states(spark: SparkSession, path: str, state_path: str, schema: T.StructType, sketched: list[str] = ()) -> DataFrame:
    """One state for each file that the table has now."""
    stored = _state(spark, state_path, schema, list(sketched)).dropDuplicates(["file"])
    return stored.join(_files(spark, path).select("file"), "file", "left_semi")


def merged_null_profile(found: DataFrame, schema: T.StructType) -> DataFrame:
    """`null_profile` of the table, from the states of its files."""
    sums = [F.coalesce(F.sum(f"`{c}`"), F.lit(0)).alias(c) for c in ("total", *(f"nulls_{n}" for n in schema.names))]
    return as_null_profile(found.agg(*sums), schema.names)


def merged_median(found: DataFrame, column: str) -> DataFrame:
    """A value whose rank is near the middle, as one row; NULL where the column has no value."""
    sketch = f"sketch_{column}"
    merged = found.agg(F.kll_merge_agg_bigint(sketch).alias("sketch"))
    n = F.kll_sketch_get_n_bigint("sketch")
    return merged.select(F.when(n > 0, F.kll_sketch_get_quantile_bigint("sketch", F.lit(0.5))).alias("approx_median"))
