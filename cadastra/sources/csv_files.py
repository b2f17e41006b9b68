"""Registry CSV files: quoted, possibly with line breaks inside quotes.

Every file is bound by its own header, and gives the same rows whatever its size and
wherever splits begin. Spark reads a multi-line CSV file in one task. With
`layout="auto"` large files whose records keep to one line are read in splits instead
(see `csv_lines`). The rest, so all large files whose records span lines, are read by one
task each, named in the log, and spread over the cluster right after the parse: a producer
who wants them read in parallel writes files of bounded size, or one record a line.
"""

from __future__ import annotations

import csv
import logging
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.schema import CORRUPT, RAW_COLUMNS, text_schema
from cadastra.sources import csv_lines
from cadastra.sources.encodings import encodings

# Smaller files are read whole without a look at their lines; the rows are the same.
SPLIT_ABOVE = 128 * 1024 * 1024

log = logging.getLogger(__name__)

_UNSPLITTABLE = rf"({'|'.join(csv_lines.UNSPLITTABLE)})$".replace(".", r"\.")

Paths = str | list[str]


def _options(encoding: str, line_end: str | None) -> dict:
    options = {
        "encoding": encoding,
        "quote": '"',
        "escape": '"',
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
    }
    if line_end is None:
        return options | {"multiLine": True}
    return options | {"lineSep": line_end}


def _header_names(line: str) -> list[str] | None:
    """The names in a header line; None if it goes on in the next line."""
    if line.count('"') % 2:
        return None
    return next(csv.reader([line.removesuffix("\r")]), [])


def _by_header(
    spark: SparkSession, paths: Paths, options: dict
) -> list[tuple[Paths, list[str], bool]]:
    """The files with the same header, its names, and whether it is one line, for each header.

    Headers are compared on the cluster; where all files have the same one, as they
    mostly do, no list of files is made. A single file is asked for its header alone.
    """
    encoding = options["encoding"]
    if encoding not in csv_lines.MARKS or len(_listed(spark, paths).select("path").take(2)) < 2:
        names = spark.read.csv(paths, **options, header=True).columns
        # A name that spans lines would show as one with a line feed in it.
        return [(paths, _own_names(paths, names), not any("\n" in n for n in names))]
    first = csv_lines.first_lines(spark, paths, encoding)
    lines = [bytes(row[0]) for row in first.select("bytes").distinct().collect()]
    if len(lines) <= 1:
        groups = [(paths, lines[0] if lines else b"")]
    else:
        files = first.groupBy("bytes").agg(F.collect_list("uri").alias("uris")).collect()
        names = {row.uri: row.path for row in _listed(spark, paths).collect()}
        groups = [([names[uri] for uri in row.uris], bytes(row.bytes)) for row in files]
    found = []
    for group, line in groups:
        names = _header_names(line.decode(encoding, "replace"))
        one_line = names is not None
        if not one_line:
            names = spark.read.csv(group, **options, header=True).columns
        found.append((group, _own_names(group, names), one_line))
    return found


def _own_names(paths: Paths, names: list[str]) -> list[str]:
    """The names of a file's columns; those of no interest get names that cannot clash."""
    if not names:
        return RAW_COLUMNS  # an empty file
    if missing := set(RAW_COLUMNS) - set(names):
        raise ValueError(f"columns missing in {paths}: {sorted(missing)}")
    known = set(RAW_COLUMNS)
    return [n if n in known and n not in names[:i] else f"_{i}" for i, n in enumerate(names)]


def _read(spark: SparkSession, paths: Paths, header: bool, options: dict) -> DataFrame:
    """All-text rows, columns bound by each file's header, or by position without one."""
    groups = _by_header(spark, paths, options) if header else [(paths, RAW_COLUMNS, True)]
    parts = []
    for group, names, _ in groups:
        # The schema is that of the header, so the header need not be compared to it.
        reader = spark.read.schema(text_schema(names))
        rows = reader.csv(group, **options, header=header, enforceSchema=True)
        parts.append(rows.select(*RAW_COLUMNS, CORRUPT))
    return reduce(DataFrame.unionByName, parts)


def _listed(spark: SparkSession, paths: Paths) -> DataFrame:
    """Every file with its size. Reads no contents.

    `path` names a file as readers take it, `uri` as `_metadata.file_path` spells it.
    """
    files = spark.read.format("binaryFile").load(paths)
    return files.select("path", "length", F.col("_metadata.file_path").alias("uri"))


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Every file below `path` with its size. Reads no contents."""
    return _listed(spark, path)


def read_raw(
    spark: SparkSession,
    path: Paths,
    header: bool = True,
    encoding: str = "UTF-16LE",
    layout: str = "auto",
    split_above: int = SPLIT_ABOVE,
) -> DataFrame:
    """Registry rows as text, in documented column order, with `_corrupt_record`.

    Short rows are padded with NULL and long rows cut; both are kept and also
    reported in `_corrupt_record`. `layout` is "multiline" (any file, one task
    per file), "lines" (the caller knows that records and lines are the same, end
    with a line feed alone, and hold no byte-order mark but at the start of a file: the
    fast way, which reads the data once), or "auto", which reads large files
    once more to see how they are made.
    `UTF-16LE` is right with and without a byte-order mark at the start of a file. `auto`
    tells each file's encoding from its first bytes, by a pass over the files.
    """
    if encoding == "auto":
        return _read_by_encoding(spark, path, header, layout, split_above)
    whole = _options(encoding, None)
    if layout == "multiline":
        return _read(spark, path, header, whole)
    if layout == "lines":
        return _read(spark, path, header, _options(encoding, "\n"))
    if layout != "auto":
        raise ValueError(f"unknown layout: {layout}")

    packed = F.col("path").rlike(_UNSPLITTABLE)
    files = file_sizes(spark, path).withColumn(
        "kind", F.when(packed, "packed").when(F.col("length") > split_above, "large").otherwise("small")
    )
    # One row per kind; files are only listed where kinds differ.
    kinds = {row.kind for row in files.select("kind").distinct().collect()}
    if kinds <= {"small"}:
        return _read(spark, path, header, whole)
    parts = []
    if "large" in kinds:
        large = files.filter(F.col("kind") == "large").collect()
        parts = _large_files(spark, {f.uri: f.path for f in large}, header, encoding)
    if "packed" in kinds:
        paths = [f.path for f in files.filter(F.col("kind") == "packed").collect()]
        parts.append(_one_task_each(spark, paths, header, whole))
    if "small" in kinds:
        paths = [f.path for f in files.filter(F.col("kind") == "small").collect()]
        parts.append(_read(spark, paths, header, whole))
    return reduce(DataFrame.unionByName, parts)


def _read_by_encoding(spark: SparkSession, path: Paths, header: bool, layout: str, split_above: int) -> DataFrame:
    """Files of several encodings as one; files without a byte have no rows."""
    told = encodings(spark, path)
    kinds = [r.encoding for r in told.select("encoding").distinct().collect()]
    if len(kinds) < 2:
        return read_raw(spark, path, header, kinds[0] if kinds else "UTF-8", layout, split_above)
    groups: dict[str, list[str]] = {}
    for row in _listed(spark, path).join(told, "uri").select("path", "encoding").collect():
        groups.setdefault(row.encoding, []).append(row.path)
    parts = [read_raw(spark, paths, header, kind, layout, split_above) for kind, paths in sorted(groups.items())]
    return reduce(DataFrame.unionByName, parts)


def _one_task_each(spark: SparkSession, paths: list[str], header: bool, options: dict) -> DataFrame:
    log.warning("one task per file: %s", ", ".join(sorted(paths)))
    return _read(spark, paths, header, options).hint("rebalance")


def _large_files(
    spark: SparkSession, paths: dict[str, str], header: bool, encoding: str
) -> list[DataFrame]:
    """One read per kind of large file; `paths` has the path of each uri."""
    left, parts = dict(paths), []
    if encoding in csv_lines.MARKS:
        profile = csv_lines.line_profile(spark, list(left.values()), encoding).collect()
        if not {row.uri for row in profile} <= left.keys():
            raise ValueError("the file listing and the read name files differently")
        for end in ("\n", "\r\n"):
            same = [left.pop(row.uri) for row in profile if row.line_end == end and row.one_line]
            if same:
                parts.append(_read(spark, same, header, _options(encoding, end)))
    if left:
        parts.append(_one_task_each(spark, list(left.values()), header, _options(encoding, None)))
    return parts


def write_raw(
    df: DataFrame,
    path: str,
    header: bool = True,
    encoding: str = "UTF-16LE",
    rows_per_file: int = 1_000_000,
) -> None:
    """Write text columns in the form that `read_raw` reads, in files of bounded size."""
    df.write.option("maxRecordsPerFile", rows_per_file).csv(
        path,
        header=header,
        encoding=encoding,
        quote='"',
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
