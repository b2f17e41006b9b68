"""Whether two tables hold the same rows, whatever their order.

For every column, and for whole rows, a digest is taken that no order of rows changes:
the sum of a hash of each value, and the exclusive or of another hash of it. Equal rows
that are there twice count twice in the sum, so a lost duplicate is noticed; a value that
changed places between two rows changes the rows' digest though not the column's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.operators.profile import quoted

_PARTS = ("rows", "total", "mixed")
#: Stands for whole rows among the columns' names.
ROWS = "*"


def _digest(values: list[Column], seed: int, rows: Column) -> list[Column]:
    # The literal first: a hash goes on from that of the column before it.
    one, two = (F.xxhash64(F.lit(s), *values) for s in (2 * seed, 2 * seed + 1))
    total = F.coalesce(F.sum(one.cast("decimal(20,0)")), F.lit(0).cast("decimal(30,0)"))
    return [rows.alias("rows"), total.cast("string").alias("total"), F.coalesce(F.bit_xor(two), F.lit(0)).alias("mixed")]


def content_digest(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, rows, total, mixed) for each column, and for whole rows; one pass.

    `rows` are those in which the column has a value. NULL is told from every value, in whole rows too.
    """
    columns = df.columns if columns is None else columns
    # A NULL leaves a hash as it is, so each value of a row is preceded by whether it is there.
    whole = [x for c in columns for x in (quoted(c).isNull(), quoted(c))]
    digests = [(ROWS, _digest(whole, 0, F.count(F.lit(1))))]
    digests += [(c, _digest([quoted(c)], at, F.count(quoted(c)))) for at, c in enumerate(columns, 1)]
    one = df.agg(*(F.struct(*parts).alias(f"digest_{at}") for at, (_, parts) in enumerate(digests)))
    rows = [
        F.struct(F.lit(name).alias("column"), *(F.col(f"digest_{at}.{part}").alias(part) for part in _PARTS))
        for at, (name, _) in enumerate(digests)
    ]
    return one.select(F.inline(F.array(*rows)))


def content_reconciliation(source: DataFrame, target: DataFrame) -> DataFrame:
    """For each column, and for whole rows: values in source and target, and whether the contents agree."""
    one, two = content_digest(source), content_digest(target, source.columns)
    one, two = (
        side.select("column", *(F.col(c).alias(f"{name}_{c}") for c in _PARTS))
        for name, side in (("source", one), ("target", two))
    )
    same = [F.col(f"source_{c}") == F.col(f"target_{c}") for c in _PARTS]
    agrees = (same[0] & same[1] & same[2]).alias("matches")
    return one.join(two, "column").select("column", "source_rows", "target_rows", agrees)
