"""The encoding of each file, told from its first bytes.

A byte-order mark decides. Without one, text with a comma or a digit in its first line has
zero bytes in UTF-16: at odd places in little-endian files, at even ones in big-endian files, and none in UTF-8.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.sources.csv_lines import byte_lines

#: Bytes of a file that are looked at, at most.
LOOKED_AT = 4_096
# Marks and the encodings they stand for.
MARKED = {"FFFE": "UTF-16LE", "FEFF": "UTF-16BE", "EFBBBF": "UTF-8"}


def _zeros(content: Column, first: int) -> Column:
    """Zero bytes at every second place, from the place `first` on."""
    places = F.filter(F.sequence(F.lit(1), F.greatest(F.length(content), F.lit(1))), lambda i: i % 2 == (first + 1) % 2)
    return F.size(F.filter(places, lambda i: F.substring(content, i, F.lit(1)) == F.lit(b"\0")))


def told_by(content: Column) -> Column:
    """The encoding that a file's first bytes tell."""
    told = None
    for mark, encoding in MARKED.items():
        starts = F.startswith(content, F.unhex(F.lit(mark)))
        told = F.when(starts, encoding) if told is None else told.when(starts, encoding)
    even, odd = _zeros(content, 0), _zeros(content, 1)
    return told.when(odd > even, "UTF-16LE").when(even > odd, "UTF-16BE").otherwise("UTF-8")


def encodings(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(uri, encoding) of every file that has a byte. One narrow pass; a row for each file is kept."""
    lines = byte_lines(spark, paths, "UTF-8").filter("leading")
    # With its line feed, since a little-endian one is cut before the zero that ends it.
    first = F.min_by(F.substring(F.concat("bytes", F.lit(b"\n")), 1, LOOKED_AT), "position")
    return lines.groupBy("uri").agg(first.alias("content")).select("uri", told_by(F.col("content")).alias("encoding"))
