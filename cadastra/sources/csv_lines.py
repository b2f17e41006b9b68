"""Which CSV files can be read in splits with the same rows as a multi-line read.

Where every line is a whole record, Spark's line reader splits a file by itself. That is
so for well-formed files, in which a field is quoted from end to end or has no quote at
all, and no field holds a line break. Every line of a file is checked before the file is
read so. A byte-order mark belongs to the start of a file; one anywhere else is text to
the multi-line read, but is dropped where a split happens to start with it, so a file
that may hold one is not read in splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.schema import CORRUPT

# Encodings whose byte-order mark and line feed are told by bytes, and
# suffixes of files that cannot be read in splits.
MARKS = {"UTF-16LE": "FFFE", "UTF-8": "EFBBBF"}
UNSPLITTABLE = (".gz", ".zst", ".lz4", ".snappy", ".deflate")

_UNDECODED = "\ufffd"
_UNUSED_SEPARATOR = "\x01"

# A line without its line end. A carriage return anywhere else makes a file unfit.
# Possessive quantifiers keep the matches linear, and plain character classes fast.
_OPEN = r'"[^"\r]*+(?:""[^"\r]*+)*+'
_FIELD = rf'(?:{_OPEN}"|[^",\r]*+)'
_WHOLE = rf"^{_FIELD}(?:,{_FIELD})*+\z"


def byte_lines(spark: SparkSession, paths: str | list[str], encoding: str) -> DataFrame:
    """Lines as bytes, with the file, and whether the line is in the file's first split."""
    lines = spark.read.option("encoding", encoding).option("lineSep", "\n").text(paths)
    return lines.select(
        F.col("_metadata.file_path").alias("uri"),
        (F.col("_metadata.file_block_start") == 0).alias("leading"),
        F.monotonically_increasing_id().alias("position"),
        F.col("value").cast("binary").alias("bytes"),
    )


def _mark(encoding: str) -> Column:
    return F.unhex(F.lit(MARKS[encoding]))


def first_lines(spark: SparkSession, paths: str | list[str], encoding: str) -> DataFrame:
    """(uri, bytes): the first line of every file, without a byte-order mark.

    Two narrow passes: the place of each first line, then the lines at these places.
    """
    lines = byte_lines(spark, paths, encoding).filter("leading")
    places = lines.groupBy("uri").agg(F.min("position").alias("position")).drop("uri")
    first = lines.join(places, "position")
    size = len(MARKS[encoding]) // 2
    bare = F.when(F.startswith("bytes", _mark(encoding)), F.substring("bytes", size + 1, 1 << 30))
    return first.select("uri", F.coalesce(bare, "bytes").alias("bytes"))


def line_profile(spark: SparkSession, paths: list[str], encoding: str) -> DataFrame:
    """Per file: its line end, NULL where mixed, undecodable or marked inside, and whether
    every line is a whole record."""
    lines = spark.read.schema(f"line string, {CORRUPT} string").csv(
        paths,
        encoding=encoding,
        sep=_UNUSED_SEPARATOR,
        quote="",
        escape="",
        lineSep="\n",
        mode="PERMISSIVE",
        columnNameOfCorruptRecord=CORRUPT,
    )
    has_return = F.endswith("line", F.lit("\r"))
    body = F.when(has_return, F.expr("left(line, length(line) - 1)")).otherwise(F.col("line"))
    odd = F.contains(body, F.lit("\r")) | F.contains(body, F.lit(_UNDECODED))
    fit = F.col(CORRUPT).isNull() & ~odd
    total, returns = F.count(F.lit(1)), F.count_if(has_return)
    line_end = F.when(returns == 0, "\n").when(returns == total, "\r\n")
    profile = lines.groupBy(F.col("_metadata.file_path").alias("uri")).agg(
        F.when(F.count_if(fit) == total, line_end).alias("line_end"),
        (F.count_if(body.rlike(_WHOLE)) == total).alias("one_line"),
    )
    marked = _marked_inside(spark, paths, encoding)
    return profile.join(marked, "uri", "left").select(
        "uri",
        F.when(~F.coalesce("marked", F.lit(False)), F.col("line_end")).alias("line_end"),
        "one_line",
    )


def _marked_inside(spark: SparkSession, paths: list[str], encoding: str) -> DataFrame:
    """(uri, marked): files with the bytes of a mark anywhere but at their start.

    In UTF-16 these bytes may also be halves of two characters; such a file is then read
    whole, which gives the same rows.
    """
    size = len(MARKS[encoding]) // 2
    mark = _mark(encoding)
    lines = byte_lines(spark, paths, encoding)
    again = F.contains(F.substring("bytes", size + 1, 1 << 30), mark)
    has, starts = F.contains("bytes", mark), F.startswith("bytes", mark) & F.col("leading") & ~again
    found = lines.groupBy("uri").agg(
        F.count_if(has).alias("marked_lines"),
        F.count_if(starts).alias("starting"),
        F.min(F.when(starts, F.col("position"))).alias("position"),
        F.min(F.when(F.col("leading"), F.col("position"))).alias("first"),
    )
    # The one mark that is not inside opens the first line of the first split.
    own = (F.col("starting") == 1) & (F.col("position") == F.col("first"))
    clean = (F.col("marked_lines") == 0) | (F.col("marked_lines") == 1) & F.coalesce(own, F.lit(False))
    return found.select("uri", (~clean).alias("marked"))
