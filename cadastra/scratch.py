"""Where intermediate tables go: the shared folder that the cluster names."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def new_folder(spark: SparkSession, label: str) -> str:
    """A path not used before, below the session's shared folder.

    Only a local session may fall back to a temporary folder: on a cluster the
    executors would each write to a disk of their own. The folder is the caller's to
    delete; within `cleared` it is deleted at the end.
    """
    base = spark.conf.get(SETTING, None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise ValueError(f"set {SETTING} to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="cadastra-")
    path = f"{base.rstrip('/')}/cadastra-{label}-{uuid4().hex}"
    for paths in _open:
        paths.append(path)
    return path


_open: list[list[str]] = []


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever file system it is."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def cleared(spark: SparkSession) -> Iterator[list[str]]:
    """Delete the intermediate tables made within, once their results are stored elsewhere.

    A frame that still reads one of them cannot be used afterwards.
    """
    paths: list[str] = []
    _open.append(paths)
    try:
        yield paths
    finally:
        _open.remove(paths)
        for path in paths:
            delete(spark, path)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once and read it back.

    This cuts the lineage, and gives Catalyst the true size of an intermediate
    result, so it decides on a broadcast from a known size.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
