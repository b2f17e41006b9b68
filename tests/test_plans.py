"""The physical plans are the intended ones."""

from __future__ import annotations

import pytest

from cadastra.operators import cleaning, groups, profile, statistics, topk
from cadastra.plans.catalog import QUERIES
from cadastra.plans.houses import houses
from cadastra.schema import CLEAN_COLUMNS, RAW_COLUMNS
from cadastra.sources import parquet

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "houses")
    parquet.write_clean(houses(spark, SF), path)
    return parquet.read_clean(spark, path)


@pytest.fixture
def plan(capsys):
    def text(df, run=False):
        if run:
            df.collect()
        df.explain("formatted")
        return capsys.readouterr().out

    return text


def read_schema(text):
    return [line for line in text.splitlines() if line.startswith("ReadSchema")]


def test_topk_pushes_the_filter_and_keeps_only_k(spark, stored, plan):
    text = plan(topk.top_houses(spark, stored))
    assert "GreaterThan(area,60.0)" in text
    assert "TakeOrderedAndProject" in text and "Exchange" not in text
    assert not any("description" in s or "latitude" in s for s in read_schema(text))


def test_top_groups_reads_one_column(stored, plan):
    text = plan(groups.top_groups(stored, "city"))
    assert read_schema(text) == ["ReadSchema: struct<city:string>"]
    assert "TakeOrderedAndProject" in text
    assert text.count("Exchange (") <= 2 and "partial_count" in text


def test_decades_push_the_null_filter(stored, plan):
    text = plan(groups.bucket_counts(stored))
    assert "IsNotNull(year)" in text
    assert read_schema(text) == ["ReadSchema: struct<year:int>"]


def test_null_profile_is_one_scan(stored, plan):
    assert len(read_schema(plan(profile.null_profile(stored)))) == 1


def test_year_stats_scan_and_group_once(stored, plan):
    text = plan(statistics.year_stats(stored), run=True)
    final = text.split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final


def test_extreme_rows_do_not_sort_or_shuffle_the_table(stored, plan):
    text = plan(groups.extreme_rows(stored))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert "Window" not in text


def test_clean_is_one_stage(stored, plan):
    raw = stored.selectExpr(*[f"cast({c} as string) as {c}" for c in CLEAN_COLUMNS])
    raw = raw.toDF(*RAW_COLUMNS)
    assert "Exchange" not in plan(cleaning.clean(raw))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_any_plan(spark, plan, name):
    text = plan(QUERIES[name](spark, SF))
    # Records that span lines are brought together in Arrow batches.
    if name != "ingest_csv_stitched":
        assert "Python" not in text and "Pandas" not in text and "MapInArrow" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
