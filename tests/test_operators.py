"""Edge cases and properties of the operators."""

from __future__ import annotations

import math
import random
import statistics as py

import pytest
from pyspark.sql import functions as F

from cadastra.operators import cleaning, groups, profile, topk
from cadastra.operators import statistics as st
from cadastra.plans.houses import houses, raw_houses
from cadastra.schema import CLEAN, CLEAN_COLUMNS

SF = "/root/testdata/sf0.001"


@pytest.fixture
def table(spark):
    def build(*rows):
        full = [{**dict.fromkeys(CLEAN_COLUMNS), **row} for row in rows]
        return spark.createDataFrame(
            [tuple(r[c] for c in CLEAN_COLUMNS) for r in full], CLEAN
        )

    return build


def test_clean_keeps_nan_area_and_drops_null(table):
    df = table(
        {"id": 1, "year": 1950, "area": math.nan},
        {"id": 2, "year": 1950, "area": None},
        {"id": 3, "year": None, "area": 1.0},
        {"id": None, "year": 1950, "area": 1.0},
    )
    assert [r.id for r in cleaning.drop_incomplete(df).collect()] == [1]
    assert tuple(cleaning.clean_metrics(df).first()) == (4, 1, 3)


def test_empty_table(table):
    empty = table()
    assert tuple(st.year_stats(empty).first()) == (None, None)
    assert st.approx_median(empty).first()[0] is None
    assert profile.row_count(empty).first().n == 0
    assert {r.pct for r in profile.null_profile(empty).collect()} == {0.0}
    assert tuple(cleaning.clean_metrics(empty).first()) == (0, 0, 0)
    for result in (
        groups.top_groups(empty, "region"),
        groups.value_ranges(empty),
        groups.range_series(empty),
        groups.extreme_rows(empty),
        groups.bucket_counts(empty),
        groups.decade_series(empty),
        topk.topk_report(topk.top_houses(empty.sparkSession, empty)),
    ):
        assert result.collect() == []


def test_null_profile(table):
    df = table({"id": 1, "region": "A"}, {"id": 2}, {"id": None, "region": "B"})
    got = {r.column: (r.nulls, round(r.pct, 4)) for r in profile.null_profile(df).collect()}
    assert got["id"] == (1, 33.3333)
    assert got["region"] == (1, 33.3333)
    assert got["year"] == (3, 100.0)
    assert list(got) == CLEAN_COLUMNS


def test_schema_profile(table):
    rows = profile.schema_profile(table()).collect()
    assert [(r.position, r.name, r.type) for r in rows[:4]] == [
        (1, "id", "int"),
        (2, "latitude", "double"),
        (3, "longitude", "double"),
        (4, "year", "int"),
    ]
    assert [r.name for r in rows] == CLEAN_COLUMNS


@pytest.mark.parametrize("seed", range(6))
def test_year_stats_against_python(spark, seed):
    rnd = random.Random(seed)
    spread = [3, 300, 200_000, 2**31 - 1][seed % 4]
    years = [rnd.randint(-spread, spread) for _ in range(rnd.choice([1, 2, 5, 10, 500]))]
    if seed > 3:
        years += [1953] * 200
    df = spark.createDataFrame([(y,) for y in years] + [(None,)], "year int")
    row = st.year_stats(df).first()
    assert row.median_year == py.median_low(years)
    assert row.avg_year == pytest.approx(sum(years) / len(years))


@pytest.mark.parametrize("kind", ["tinyint", "smallint", "bigint"])
def test_year_stats_of_other_whole_numbers(spark, kind):
    rnd = random.Random(kind)
    top = {"tinyint": 2**7, "smallint": 2**15, "bigint": 2**63}[kind]
    values = [rnd.randint(-top, top - 1) for _ in range(301)] + [-top, top - 1, 0, -1]
    df = spark.createDataFrame([(v,) for v in values], "year bigint").selectExpr(f"cast(year as {kind}) as year")
    row = st.year_stats(df).first()
    assert row.median_year == py.median_low(values)
    assert row.avg_year == pytest.approx(sum(values) / len(values), rel=1e-9, abs=top * 1e-9)


def test_fractions_have_a_mean_and_no_exact_median(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (None,)], "v double")
    assert st.mean(df, "v").first().avg_v == 1.5
    assert st.mean(df.limit(0), "v").first().avg_v is None
    for kind in ("double", "float", "decimal(10,2)"):
        with pytest.raises(TypeError, match="whole numbers"):
            st.year_stats(df.selectExpr(f"cast(v as {kind}) as v"), "v")


def test_buckets_of_wide_columns_are_not_merged(spark):
    wide = spark.createDataFrame([(3_000_000_005,), (6_000_000_005,), (None,)], "v bigint")
    for df in (wide, wide.selectExpr("cast(v as double) as v")):
        rows = groups.bucket_counts(df, "v", 10, "edge")
        assert [tuple(r) for r in rows.collect()] == [(3_000_000_000, 1), (6_000_000_000, 1)]
        assert rows.dtypes[0] == ("edge", "bigint")
    assert groups.bucket_counts(wide.selectExpr("cast(1953 as int) as v"), "v").dtypes[0] == ("decade", "int")


def test_null_profile_of_names_with_dots(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "`a.b` int, `c``d` int")
    assert [(r.column, r.nulls) for r in profile.null_profile(df).collect()] == [("a.b", 1), ("c`d", 2)]


def test_approx_median_keeps_its_rank_bound(spark):
    df = spark.range(0, 20_000, 1, 7).select((F.hash("id") % 5000).cast("int").alias("year"))
    row = st.approx_median_check(df).first()
    assert row.within_bound and row.n == 20_000
    values = sorted(r.year for r in df.collect())
    below = sum(v < row.approx_median for v in values) / len(values)
    up_to = sum(v <= row.approx_median for v in values) / len(values)
    assert below <= 0.51 and up_to >= 0.49


def test_top_groups_breaks_ties_and_ranks_null(table):
    df = table(
        *[{"id": i, "region": r} for i, r in enumerate([None, None, "B", "A", "B", "A", "C"])]
    )
    rows = [tuple(r) for r in groups.top_groups(df, "region", 3).collect()]
    assert rows == [("A", 2), ("B", 2), (None, 2)]


def test_value_ranges_order_and_nan(table):
    df = table(
        {"id": 1, "region": "A", "area": 5.0},
        {"id": 2, "region": "A", "area": None},
        {"id": 3, "region": "B", "area": math.nan},
        {"id": 4, "region": "B", "area": 2.0},
        {"id": 5, "region": None, "area": 5.0},
    )
    rows = groups.value_ranges(df).collect()
    assert [r.region for r in rows] == ["B", "A", None]
    assert math.isnan(rows[0].max_area) and rows[0].min_area == 2.0 and rows[0].n == 2
    assert tuple(rows[1]) == ("A", 5.0, 5.0, 1)
    series = groups.range_series(df, n=1).collect()
    assert [(r.region, r.series) for r in series] == [("B", "max_area"), ("B", "min_area")]


def _extremes_by_hand(rows, largest):
    best = {}
    for r in rows:
        if r.area is None:
            continue
        area = (1, 0.0) if math.isnan(r.area) else (0, r.area)
        key = (tuple(-a for a in area) if largest else area, r.id)
        if r.region not in best or key < best[r.region][0]:
            best[r.region] = (key, r.id)
    return sorted((str(k), v[1]) for k, v in best.items())


@pytest.mark.parametrize("largest", [True, False])
def test_extreme_rows_with_ties_nulls_and_nan(table, largest):
    rnd = random.Random(5)
    df = table(
        *[
            {
                "id": i,
                "region": rnd.choice([None, "A", "A", "A", "B", "C"]),
                "area": rnd.choice([0.0, 0.0, 1.0, 2.5, 2.5, None, -0.0]),
                "year": rnd.randint(1900, 2000),
            }
            for i in rnd.sample(range(1000), 300)
        ],
        {"id": 2000, "region": "N", "area": math.nan},
        {"id": 2001, "region": "N", "area": 1.0},
        {"id": 2002, "region": "only null", "area": None},
    )
    got = groups.extreme_rows(df, largest=largest).collect()
    again = groups.extreme_rows(df, largest=largest, ranges=groups.value_ranges(df)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))
    assert sorted((str(r.region), r.id) for r in got) == _extremes_by_hand(df.collect(), largest)
    whole = {r.id: r.asDict() for r in df.collect()}
    for r in got:
        assert repr(r.asDict()) == repr(whole[r.id])


def test_extreme_rows_without_broadcast(spark, table):
    """Beyond the broadcast threshold the extremes are joined by shuffle, with the same rows."""
    rows = [{"id": i, "region": str(i % 7), "area": float(i % 11)} for i in range(200)]
    df = table(*rows)
    expected = sorted(map(repr, groups.extreme_rows(df).collect()))
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        result = groups.extreme_rows(df)
        assert sorted(map(repr, result.collect())) == expected
    finally:
        spark.conf.set(key, before)


def test_extreme_rows_with_equal_ties_are_deterministic(table):
    rows = [{"id": 1, "region": "A", "area": 5.0, "city": c} for c in "zyxa"]
    for order in (rows, rows[::-1]):
        assert [r.city for r in groups.extreme_rows(table(*order)).collect()] == ["a"]


def test_bucket_counts_add_up_and_are_ordered(spark):
    df = houses(spark, SF)
    rows = groups.bucket_counts(df).collect()
    assert sum(r.n for r in rows) == df.count()
    assert [r.decade for r in rows] == sorted(r.decade for r in rows)
    assert [r.label for r in groups.decade_series(df).collect()] == [f"{r.decade}s" for r in rows]


def test_group_counts_add_up(spark):
    df = houses(spark, SF)
    n = df.count()
    assert sum(r.n for r in groups.value_ranges(df).collect()) == n
    assert sum(r.n for r in groups.top_groups(df, "city", 10**6).collect()) == n
    total, kept, dropped = cleaning.clean_metrics(
        cleaning.cast_types(raw_houses(spark, SF))
    ).first()
    assert (kept, kept + dropped) == (n, total)


def test_top_houses_order_ties_and_nan(spark, table):
    df = table(
        *[{"id": i, "area": a} for i, a in [(9, 70.0), (3, 70.0), (5, 60.0), (6, 99.5)]],
        {"id": 1, "area": math.nan},
        {"id": 2, "area": None},
    )
    assert [r.id for r in topk.top_houses(spark, df).collect()] == [6, 3, 9]
    assert [r.id for r in topk.top_houses(spark, df, n=2).collect()] == [6, 3]
    assert [r.id for r in topk.top_houses(spark, df, min_area=90).collect()] == [6]


def test_topk_report(spark, table):
    df = table(
        {"id": 1, "area": 70.125, "region": "Р" * 40, "city": "Г" * 40, "floors": 0},
        {"id": 2, "area": 65.0, "year": 1953, "floors": 5},
    )
    rows = topk.topk_report(topk.top_houses(spark, df)).collect()
    assert [tuple(r) for r in rows] == [
        (1, "Р" * 28, "Г" * 23, "70.12", "N/A", "N/A"),
        (2, None, None, "65.00", "1953", "5"),
    ]


def test_head_sample_is_sorted(table):
    df = table(*[{"id": i} for i in (5, 3, 9, 1)], {"id": None})
    assert [r.id for r in profile.head_sample(df, 3).collect()] == [1, 3, 5]


def test_run_metrics(spark):
    first = spark.sql("SELECT 5L AS total_rows, 3L AS clean_rows")
    second = spark.sql("SELECT 1950.5D AS avg_year, CAST(NULL AS INT) AS median_year")
    rows = profile.run_metrics(first, second).collect()
    assert [tuple(r) for r in rows] == [
        ("total_rows", 5.0),
        ("clean_rows", 3.0),
        ("avg_year", 1950.5),
        ("median_year", None),
    ]
