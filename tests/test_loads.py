"""Loads by ranges, swapped loads, reconciliation by content, rejected rows, and merged profiles."""

from __future__ import annotations

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cadastra.operators import cleaning, file_profiles, profile, quarantine, reconcile, statistics
from cadastra.plans import workflow
from cadastra.plans.houses import houses, raw_houses
from cadastra.schema import CLEAN, CLEAN_COLUMNS, CORRUPT, RAW_COLUMNS
from cadastra.sources import csv_files, loads

SF = "/root/testdata/sf0.001"


def test_a_lookup_reads_one_file(spark, tmp_path):
    path = str(tmp_path / "ranged")
    loads.write_ranges(houses(spark, SF), path, rows_per_file=100)
    files = loads.ranges(spark, path).collect()
    assert len(files) > 10 and not any(f.overlaps for f in files)
    assert max(f.n for f in files) < 300
    for wanted in (files[3].low, files[7].high):
        found = loads.lookup(spark, path, [wanted])
        assert len(found.inputFiles()) == 1
        assert [r.id for r in found.collect()] == [wanted]
    assert loads.lookup(spark, path, [-7]).collect() == []
    spread = loads.lookup(spark, path, [f.low for f in files[:4]])
    assert len(spread.inputFiles()) == 4 and spread.count() == 4


def test_a_key_with_a_third_of_all_rows_is_spread(spark, tmp_path):
    rows = spark.range(9_000).select(
        F.when(F.col("id") % 3 == 0, 4_000).otherwise(F.col("id")).alias("id"), F.col("id").cast("string").alias("name")
    )
    path = str(tmp_path / "hot")
    loads.write_ranges(rows, path, rows_per_file=500)
    files = loads.ranges(spark, path).collect()
    assert sum(f.n for f in files) == 9_000 and max(f.n for f in files) < 1_500
    found = loads.lookup(spark, path, [4_000], schema=rows.schema)
    assert found.count() == 3_000 + (4_000 % 3 != 0)
    outside = [f for f in files if not f.low <= 4_000 <= f.high]
    assert len(found.inputFiles()) == len(files) - len(outside) and len(outside) > 8


def tasks_of(files):
    return {f.file.rsplit("/", 1)[-1].split("-")[1] for f in files}


def test_many_small_files_are_cut_from_fewer_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(loads, "LEAST_TASKS", 8, raising=False)
    rows = spark.range(2_400).select((F.col("id") * 3).alias("id"), F.col("id").cast("string").alias("name"))
    path = str(tmp_path / "small")
    loads.write_ranges(rows, path, rows_per_file=20)
    files = loads.ranges(spark, path).collect()
    assert len(tasks_of(files)) <= 8 and len(files) >= 120
    assert sum(f.n for f in files) == 2_400 and max(f.n for f in files) <= 20 and not any(f.overlaps for f in files)
    found = loads.lookup(spark, path, [0, 1, 600], schema=rows.schema)
    assert len(found.inputFiles()) <= 3 and sorted(r.id for r in found.collect()) == [0, 600]
    assert spark.read.schema(rows.schema).parquet(path).exceptAll(rows).count() == 0


def test_repeats_cut_by_a_full_file_do_not_overlap(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(loads, "LEAST_TASKS", 4, raising=False)
    key = F.col("id") % 300
    same = spark.range(2_100).select(key.alias("id"), key.cast("string").alias("name"))
    rows = same.union(spark.range(60).select(F.lit(None).cast("bigint"), F.lit("none")))
    path = str(tmp_path / "repeats")
    loads.write_ranges(rows, path, rows_per_file=10)
    files = loads.ranges(spark, path).collect()
    assert len(tasks_of(files)) <= 4 and sum(f.n for f in files) == 2_160 and max(f.n for f in files) <= 10
    shared = {f.high for f in files} & {f.low for f in files if f.low != f.high}
    assert shared and not any(f.overlaps for f in files)
    wanted = sorted(shared - {None})[0]
    assert loads.lookup(spark, path, [wanted], schema=rows.schema).count() == 7


def test_ranges_that_reach_into_others_are_told(spark, tmp_path):
    path = str(tmp_path / "told")
    stored = [("/t/part-00000-u-c000", 1, 5), ("/t/part-00000-u-c001", 5, 7), ("/t/part-00001-u-c000", 7, 9), ("/t/part-00002-u-c000", 8, 8)]
    manifest = spark.createDataFrame([(*s, 4) for s in stored], loads.MANIFEST)
    manifest.write.parquet(loads.manifest_path(path))
    assert [f.overlaps for f in loads.ranges(spark, path).orderBy("low").collect()] == [False, False, True, True]


def test_a_swapped_load_sends_the_driver_little(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(loads, "LEAST_TASKS", 8, raising=False)
    table, root = "small_files.houses", str(tmp_path / "loads")
    rows = spark.range(3_000).select(F.col("id").cast("int").alias("id"))
    rows = rows.select(*[F.col("id").cast(f.dataType).alias(f.name) for f in CLEAN])
    loads.load_swapped(rows, table, root, rows_per_file=25)
    assert sorted(spark.table(table).collect()) == sorted(rows.collect())
    files = loads.ranges(spark, loads.location(spark, table)).collect()
    assert len(files) >= 120 and len(tasks_of(files)) <= 8
    spark.sql("DROP DATABASE small_files CASCADE")


def test_empty_and_single_loads(spark, tmp_path):
    for rows in (spark.createDataFrame([], CLEAN), houses(spark, SF).limit(1)):
        path = str(tmp_path / str(rows.count()))
        loads.write_ranges(rows, path)
        assert loads.lookup(spark, path, [1]).count() <= 1
        assert spark.read.schema(CLEAN).parquet(path).count() == rows.count()


def test_a_load_that_fails_leaves_the_old_rows(spark, tmp_path):
    table, root = "swapped_loads.houses", str(tmp_path / "loads")
    rows = houses(spark, SF)
    report = loads.load_swapped(rows, table, root, rows_per_file=200)
    assert all(r.matches for r in report.collect()) and spark.table(table).count() == rows.count()
    before = loads.location(spark, table)
    broken = rows.withColumn("floors", F.when(F.col("id") == 700, F.raise_error(F.lit("lost"))).otherwise(F.col("floors")).cast("int"))
    with pytest.raises(PySparkException):
        loads.load_swapped(broken, table, root, rows_per_file=200, rows=1_000)
    assert loads.location(spark, table) == before and spark.table(table).count() == rows.count()
    fewer = rows.filter("id < 500")
    loads.load_swapped(fewer, table, root)
    assert loads.location(spark, table) != before
    assert sorted(spark.table(table).collect()) == sorted(fewer.collect())
    spark.sql("DROP DATABASE swapped_loads CASCADE")


def test_a_load_that_differs_is_not_swapped_in(spark, tmp_path, monkeypatch):
    table, root = "differing_loads.houses", str(tmp_path / "loads")
    rows = houses(spark, SF)
    loads.load_swapped(rows, table, root)
    whole = loads.write_ranges
    monkeypatch.setattr(loads, "write_ranges", lambda df, *args: whole(df.filter("id <> 5"), *args))
    with pytest.raises(ValueError, match="differs"):
        loads.load_swapped(rows, table, root)
    assert spark.table(table).count() == rows.count()
    spark.sql("DROP DATABASE differing_loads CASCADE")


def differing(one, two):
    return {r.column for r in reconcile.content_reconciliation(one, two).collect() if not r.matches}


def test_changes_of_content_are_noticed(spark):
    schema = "a int, b string, `c.d` double"
    rows = [(1, "x", 0.5), (1, "x", 0.5), (2, None, 0.25), (None, "y", None), (3, "", float("nan")), (None, None, None)]
    make = lambda r: spark.createDataFrame(r, schema)
    base = make(rows)
    assert differing(base, make(rows[::-1]).repartition(4)) == set()
    assert differing(base, make([(1, "x", 0.75), *rows[1:]])) == {"*", "c.d"}  # one changed cell
    swapped = [(2, "x", 0.5), rows[1], (1, None, 0.25), *rows[3:]]
    assert differing(base, make(swapped)) == {"*"}  # a pair that changed places
    assert differing(base, make(rows[1:])) == {"*", "a", "b", "c.d"}  # a lost duplicate
    assert differing(base, make([*rows[1:], rows[2]])) == {"*", "a", "b", "c.d"}  # one lost, another there twice
    assert differing(base, make([*rows[:2], (None, "2", 0.25), *rows[3:]])) == {"*", "a", "b"}
    shifted = make([(None, "x", None)]), make([(None, None, None)])
    assert "*" in differing(*shifted)
    empty = base.limit(0)
    assert differing(empty, empty) == set() and differing(base, empty) == {"*", "a", "b", "c.d"}


def test_a_value_and_a_null_that_change_columns_are_noticed(spark):
    one = spark.createDataFrame([(7, None)], "a int, b int")
    two = spark.createDataFrame([(None, 7)], "a int, b int")
    assert differing(one, two) == {"*", "a", "b"}


def dirty(spark):
    names = [*RAW_COLUMNS, CORRUPT]
    rows = [
        {"house_id": "1", "maintenance_year": "1950.0", "square": "10"},
        {"house_id": "x", "maintenance_year": "1950", "square": "10"},
        {"house_id": " ", "maintenance_year": None, "square": "ten", "region": 'R "q"'},
        {"house_id": "3", "maintenance_year": "1950", CORRUPT: "3,,,1950"},
        {},
        {"house_id": "4", "maintenance_year": "1960", "square": "NaN", CORRUPT: "too,long"},
        {"house_id": "9999999999", "maintenance_year": "1960", "square": "5"},
    ]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], ", ".join(f"{n} string" for n in names))


def test_rejected_rows_are_kept_with_their_reason(spark, tmp_path):
    root = str(tmp_path / "sinks")
    counts = quarantine.write_sinks(dirty(spark), root)
    assert (counts["read_rows"], counts["accepted_rows"], counts["rejected_rows"]) == (7, 2, 5)
    accepted = quarantine.read_accepted(spark, root)
    assert accepted.columns == CLEAN_COLUMNS
    assert sorted(map(repr, accepted.collect())) == sorted(map(repr, cleaning.clean(dirty(spark)).collect()))
    rejected = {r.reason: r for r in quarantine.read_rejected(spark, root).collect()}
    assert rejected.keys() == {"bad id", "no id, no year, bad area", "no area", "no id, no year, no area"}
    assert json.loads(rejected["no id, no year, bad area"].raw) == {"house_id": " ", "square": "ten", "region": 'R "q"'}
    assert (rejected["no area"].raw, rejected["no area"].malformed) == ("3,,,1950", True)
    by = {r.reason: r.n for r in quarantine.rejects_by_reason(quarantine.read_rejected(spark, root)).collect()}
    assert by["bad id"] == 2 and sum(by.values()) == 5


def test_both_sinks_are_written_by_one_parse(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    raw = dirty(spark)
    quarantine.write_sinks(raw.mapInPandas(count, raw.schema), str(tmp_path / "sinks"))
    assert seen.value == 7


def test_a_sink_without_rows_is_empty(spark, tmp_path):
    root = str(tmp_path / "none")
    counts = quarantine.write_sinks(dirty(spark).where("house_id = '1'"), root)
    assert counts["rejected_rows"] == 0
    assert quarantine.read_rejected(spark, root).collect() == [] and quarantine.read_accepted(spark, root).count() == 1


def test_prepare_counts_the_same_with_both_sinks(spark, tmp_path):
    one = workflow.prepare(dirty(spark), str(tmp_path / "one"))
    two = workflow.prepare_sinks(dirty(spark), str(tmp_path / "two"))
    for a, b in ((one.report, two.report), (one.counts, two.counts), (one.null_profile, two.null_profile)):
        assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def test_accepted_and_rejected_rows_of_a_file(spark, tmp_path):
    source = str(tmp_path / "csv")
    csv_files.write_raw(raw_houses(spark, SF), source)
    counts = quarantine.write_sinks(csv_files.read_raw(spark, source), str(tmp_path / "sinks"))
    assert counts["read_rows"] == 1_500 == counts["accepted_rows"] + counts["rejected_rows"]
    assert counts["accepted_rows"] == houses(spark, SF).count()


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1)])
def test_profiles_of_files_are_scanned_once_and_merged(spark, tmp_path, order):
    path, state = str(tmp_path / "houses"), str(tmp_path / "states")
    rows = houses(spark, SF)
    for left in order:
        rows.filter(F.col("id") % 3 == left).repartition(2).write.mode("append").parquet(path)
        new = file_profiles.update(spark, path, state, CLEAN, ["year", "floors"])
        assert len(new) == 2
    assert file_profiles.update(spark, path, state, CLEAN, ["year", "floors"]) == []
    found = file_profiles.states(spark, path, state, CLEAN, ["year", "floors"])
    assert found.count() == 6
    want = sorted(profile.null_profile(rows).collect())
    assert sorted(file_profiles.merged_null_profile(found, CLEAN).collect()) == want
    for column in ("year", "floors"):
        median = file_profiles.merged_median(found, column)
        assert statistics.median_check(rows, column, median).first().within_bound


def test_a_file_that_is_gone_does_not_count(spark, tmp_path):
    path, state = str(tmp_path / "houses"), str(tmp_path / "states")
    rows = houses(spark, SF)
    for left in (0, 1):
        rows.filter(F.col("id") % 2 == left).coalesce(1).write.mode("append").parquet(path)
    file_profiles.update(spark, path, state, CLEAN, ["year"])
    rows.filter("id < 10").coalesce(1).write.mode("overwrite").parquet(path)
    assert len(file_profiles.update(spark, path, state, CLEAN, ["year"])) == 1
    found = file_profiles.states(spark, path, state, CLEAN, ["year"])
    assert sorted(file_profiles.merged_null_profile(found, CLEAN).collect()) == sorted(profile.null_profile(rows.filter("id < 10")).collect())


def test_medians_of_nothing(spark, tmp_path):
    path, state = str(tmp_path / "empty"), str(tmp_path / "states")
    spark.createDataFrame([], CLEAN).coalesce(1).write.parquet(path)
    file_profiles.update(spark, path, state, CLEAN, ["year"])
    found = file_profiles.states(spark, path, state, CLEAN, ["year"])
    assert file_profiles.merged_median(found, "year").first().approx_median is None
    assert {r.pct for r in file_profiles.merged_null_profile(found, CLEAN).collect()} == {0.0}
