"""Casts, buckets and display forms."""

from __future__ import annotations

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from cadastra.functions.buckets import bucket, bucket_label
from cadastra.functions.casts import to_double, to_int
from cadastra.functions.display import or_missing, shortened, two_decimals

# Text and the whole number it stands for.
INT_CASES = {
    "1953.0": 1953,
    "1953": 1953,
    " 1953 ": 1953,
    "\t1953.5\n": 1953,
    "": None,
    "abc": None,
    "99999999999": None,
    "-5.9": -5,
    "1e3": None,
    "NaN": None,
    ".5": None,
    "1953.": 1953,
    "+5": 5,
    "5.x": None,
    "2147483648.0": None,
    "2147483647.9": 2147483647,
    "-2147483648.0": -2147483648,
    ".": None,
    "-": None,
    "1,5": None,
}


def one(spark, value, kind, expression):
    row = spark.createDataFrame([(value,)], f"v {kind}").select(expression(F.col("v")).alias("r"))
    return row.first().r


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_to_int(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([(t,) for t in INT_CASES] + [(None,)], "t string")
        got = {r.t: r.n for r in df.select("t", to_int(F.col("t")).alias("n")).collect()}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert got == {**INT_CASES, None: None}


def test_to_int_agrees_with_the_lenient_cast(spark):
    """The cast without ANSI mode, but for numbers without a whole part, which are no years."""
    rnd = random.Random(7)
    texts = {
        "".join(rnd.choice("0123456789+-. e\t") for _ in range(rnd.randint(0, 12)))
        for _ in range(20_000)
    }
    key = "spark.sql.ansi.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        rows = df.select("t", F.col("t").cast("int").alias("lenient"), to_int(F.col("t")).alias("n"))
        rows = rows.collect()
    finally:
        spark.conf.set(key, before)
    assert sum(r.n is not None for r in rows) > 1000
    for r in rows:
        no_whole_part = re.fullmatch(r"\s*[+-]?\.\d*\s*", r.t)
        assert r.n == (None if no_whole_part else r.lenient), repr(r.t)


def test_to_double(spark):
    assert one(spark, "585.60", "string", to_double) == 585.6
    assert one(spark, "нет данных", "string", to_double) is None
    assert one(spark, "", "string", to_double) is None
    assert math.isnan(one(spark, "NaN", "string", to_double))


@pytest.mark.parametrize(
    ("year", "decade"),
    [(1953, 1950), (1960, 1960), (0, 0), (-5, -10), (-10, -10), (2147483647, 2147483640)],
)
def test_bucket_rounds_down(spark, year, decade):
    assert one(spark, year, "int", lambda c: bucket(c, 10)) == decade


def test_bucket_below_the_int_range(spark):
    assert one(spark, -2147483648, "int", lambda c: bucket(c, 10, True)) == -2147483650


@pytest.mark.parametrize("value", [0, 9, -1, 3_000_000_005, -6_000_000_005, 2**62 + 7, 2**63 - 1])
def test_bucket_of_large_whole_numbers_is_exact(spark, value):
    assert one(spark, value, "bigint", lambda c: bucket(c, 10, True)) == value // 10 * 10


def test_bucket_beyond_64_bits_is_null(spark):
    assert one(spark, -(2**63), "bigint", lambda c: bucket(c, 10, True)) is None
    assert one(spark, 1e300, "double", lambda c: bucket(c, 10)) is None


@pytest.mark.parametrize(
    ("value", "edge"),
    [(-0.5, -10), (9.99, 0), (math.nan, None), (math.inf, None), (-math.inf, None), (None, None)],
)
def test_bucket_of_doubles(spark, value, edge):
    assert one(spark, value, "double", lambda c: bucket(c, 10)) == edge


def test_bucket_label(spark):
    assert one(spark, 1950, "int", bucket_label) == "1950s"


def test_two_decimals_round_the_binary_value(spark):
    rnd = random.Random(1)
    values = [rnd.randrange(10**7) / 1000 for _ in range(5000)] + [0.125, 1.005, 2.675, 0.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for row in df.select("v", two_decimals(F.col("v")).alias("t")).collect():
        assert row.t == f"{row.v:.2f}"


def test_or_missing(spark):
    assert [one(spark, v, "int", or_missing) for v in (None, 0, 7)] == ["N/A", "N/A", "7"]


def test_shortened_counts_characters(spark):
    assert one(spark, "Смоленская область", "string", lambda c: shortened(c, 5)) == "Смоле"
    assert one(spark, None, "string", lambda c: shortened(c, 5)) is None
