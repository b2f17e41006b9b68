"""Stored tables, loads, settings and the whole run."""

from __future__ import annotations

import os

import pytest

from cadastra import scratch
from cadastra.operators import cleaning, groups, profile
from cadastra.plans import catalog, workflow
from cadastra.plans.houses import houses, raw_houses
from cadastra.schema import CLEAN, RAW_COLUMNS
from cadastra.sources import csv_files, jdbc, parquet, tables
from cadastra.sources.jdbc import JdbcTarget, query_jdbc, read_jdbc, write_jdbc

SF = "/root/testdata/sf0.001"


def test_parquet_roundtrip_in_bounded_files(spark, tmp_path):
    df = houses(spark, SF)
    path = str(tmp_path / "t")
    parquet.write_clean(df, path, rows_per_file=500)
    parquet.write_clean(df, path, rows_per_file=500)
    back = parquet.read_clean(spark, path)
    assert back.schema == CLEAN
    assert sorted(back.collect()) == sorted(df.collect())
    assert len(list((tmp_path / "t").glob("*.parquet"))) == -(-df.count() // 500)


def test_load_replaces_unless_told_to_append(spark, tmp_path):
    df = houses(spark, SF)
    n = df.count()
    report = workflow.load(df, "loads.houses", str(tmp_path / "t"))
    assert tuple(report.first()) == (n, n, True)
    tables.load_table(df, "loads.houses")
    assert spark.table("loads.houses").count() == n
    tables.load_table(df, "loads.houses", append=True)
    assert spark.table("loads.houses").count() == 2 * n
    assert tuple(tables.reconcile(df, spark.table("loads.houses")).first()) == (n, 2 * n, False)


def test_load_takes_over_files_that_an_earlier_session_left(spark, tmp_path):
    df = houses(spark, SF)
    for _ in range(2):
        report = workflow.load(df, "again.houses", str(tmp_path / "t"))
        assert report.first().matches
        spark.sql("DROP TABLE again.houses")


def test_prepare_counts_in_the_writing_pass(spark, tmp_path):
    raw = raw_houses(spark, SF)
    prepared = workflow.prepare(raw, str(tmp_path / "t"))
    metrics = cleaning.clean_metrics(cleaning.cast_types(raw)).drop("dropped_rows")
    assert prepared.counts.collect() == metrics.collect()
    stored = parquet.read_clean(spark, str(tmp_path / "t"))
    assert prepared.null_profile.collect() == profile.null_profile(stored).collect()


def test_prepare_counts_behind_a_shuffle(spark, tmp_path, caplog):
    """Files that cannot be split are spread over the cluster before the counting pass."""
    source = str(tmp_path / "in")
    csv_files.write_raw(raw_houses(spark, SF), source)
    raw = csv_files.read_raw(spark, source, split_above=0)
    assert "one task per file" in caplog.text
    prepared = workflow.prepare(raw, str(tmp_path / "t"))
    n = houses(spark, SF).count()
    assert tuple(prepared.counts.first()) == (1500, n)
    assert parquet.read_clean(spark, str(tmp_path / "t")).count() == n


def test_table_files_are_ordered_by_key(spark, tmp_path):
    workflow.load(houses(spark, SF), "ordered.houses", str(tmp_path / "t"))
    for file in (tmp_path / "t").glob("*.parquet"):
        ids = [r.id for r in spark.read.parquet(str(file)).select("id").collect()]
        assert ids == sorted(ids)


def test_list_tables_leaves_out_temporary_views(spark, tmp_path):
    tables.ensure_database(spark, "listing")
    tables.ensure_table(spark, "listing.houses", str(tmp_path / "t"))
    tables.ensure_table(spark, "listing.houses", str(tmp_path / "t"))
    spark.range(1).createOrReplaceTempView("passing_view")
    assert [r.table_name for r in tables.list_tables(spark, "listing").collect()] == ["houses"]
    assert spark.table("listing.houses").schema == CLEAN


def test_scratch_follows_the_session_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch.new_folder(spark, "x"), scratch.new_folder(spark, "x")
    assert one != two and one.startswith(base + "/")


class _Conf:
    def __init__(self, **values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key.replace(".", "_"), default)


class _Session:
    def __init__(self, **values):
        self.conf = _Conf(**values)


def test_scratch_never_uses_a_machine_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.new_folder(_Session(spark_master="yarn"), "x")
    shared = _Session(spark_master="yarn", spark_checkpoint_dir="hdfs:///shared/")
    assert scratch.new_folder(shared, "x").startswith("hdfs:///shared/cadastra-x-")
    assert "cadastra-" in scratch.new_folder(_Session(spark_master="local[2]"), "x")


def test_jdbc_settings_come_from_the_environment(monkeypatch):
    monkeypatch.setenv("CH_HOST", "db.example")
    monkeypatch.setenv("CH_PORT", "9999")
    monkeypatch.setenv("CH_DATABASE", "registry")
    monkeypatch.setenv("CH_USER", "loader")
    monkeypatch.setenv("CH_PASSWORD", "s3cret")
    target = JdbcTarget.from_env()
    assert target.options() == {
        "url": "jdbc:clickhouse://db.example:9999/registry",
        "user": "loader",
        "password": "s3cret",
    }
    monkeypatch.delenv("CH_PASSWORD")
    with pytest.raises(KeyError):
        JdbcTarget.from_env()


class _Recorder:
    """Stands in for a reader or writer; no database may be started here."""

    def __init__(self, first=None):
        self.calls, self.row, self.set = [], first, {}

    read = write = property(lambda self: self)

    def format(self, name):
        self.set = {"format": name}
        return self

    def options(self, **options):
        self.set |= options
        return self

    def mode(self, mode):
        self.set["mode"] = mode
        return self

    def save(self):
        self.calls.append(self.set)

    def load(self):
        self.calls.append(self.set)
        return self

    def first(self):
        return self.row


TARGET = JdbcTarget("jdbc:db://h/d", "houses", "u", "p", create_options="ORDER BY id")


def test_jdbc_write_options():
    frame = _Recorder()
    write_jdbc(frame, TARGET, connections=4)
    write_jdbc(frame, TARGET, append=True)
    first, second = frame.calls
    assert first["mode"] == "overwrite" and first["truncate"] and first["batchsize"] == 50_000
    assert first["numPartitions"] == 4 and first["createTableOptions"] == "ORDER BY id"
    assert second["mode"] == "append" and "numPartitions" not in second


def test_jdbc_reads_in_key_ranges():
    session = _Recorder(first=(7, 100))
    read_jdbc(session, TARGET, connections=8)
    edges, ranges = session.calls
    assert edges["query"] == "SELECT min(id) AS low, max(id) AS high FROM houses"
    assert (ranges["partitionColumn"], ranges["numPartitions"]) == ("id", 8)
    assert (ranges["lowerBound"], ranges["upperBound"]) == (7, 101)
    empty = _Recorder(first=(None, None))
    read_jdbc(empty, TARGET)
    assert "partitionColumn" not in empty.calls[-1]
    asked = _Recorder()
    query_jdbc(asked, TARGET, "SELECT 1")
    assert asked.calls[0]["query"] == "SELECT 1" and "dbtable" not in asked.calls[0]


def test_whole_run(spark, tmp_path):
    source = str(tmp_path / "in")
    csv_files.write_raw(raw_houses(spark, SF), source)
    settings = workflow.RunSettings(source, str(tmp_path / "out"), table="whole_run.houses")
    for _ in range(2):
        stored = workflow.run(spark, settings)
    n = houses(spark, SF).count()
    metrics = {r.metric: r.value for r in spark.read.parquet(stored["run_metrics"]).collect()}
    assert metrics["total_rows"] == 1500
    assert metrics["clean_rows"] == metrics["row_count"] == metrics["clean_count"] == n
    assert 1795 < metrics["avg_year"] < 2040 and 1795 < metrics["median_year"] < 2040
    assert tuple(spark.read.parquet(stored["load_reconcile"]).first()) == (n, n, True)
    decades = spark.read.parquet(stored["by_decade"])
    assert sorted(decades.collect()) == sorted(groups.bucket_counts(houses(spark, SF)).collect())
    assert spark.read.parquet(stored["topk_report"]).count() == 25
    report = spark.read.parquet(stored["prepare_report"]).first().asDict()
    assert report == {"total_rows": 1500, "corrupt_rows": 0, "empty_rows": 0, "overflowing_ids": 0}
    direct = {"area_series": groups.range_series, "decade_series": groups.decade_series}
    for name, operator in direct.items():
        got = sorted(map(repr, spark.read.parquet(stored[name]).collect()))
        assert got == sorted(map(repr, operator(houses(spark, SF)).collect()))


def test_results_that_follow_from_others_do_not_scan_the_table(spark, tmp_path, capsys):
    path = str(tmp_path / "houses")
    parquet.write_clean(houses(spark, SF), path)
    table = parquet.read_clean(spark, path)
    for name, result in (("ranges", groups.value_ranges(table)), ("decades", groups.bucket_counts(table))):
        result.write.parquet(str(tmp_path / name))
    stored = {name: spark.read.parquet(str(tmp_path / name)) for name in ("ranges", "decades")}
    groups.range_series(table, ranges=stored["ranges"]).explain("formatted")
    groups.decade_series(table, stored["decades"]).explain("formatted")
    assert "/houses" not in capsys.readouterr().out


def test_prepare_counts_ids_that_do_not_fit(spark, tmp_path):
    ids = ["1", "3000000000", "-3000000000.0", " 2147483648 ", "x", None, "1e99"]
    rows = [(i, "1", "1", "1990.0", "5", "1", "R", "C", "A", "D", None if i else "bad") for i in ids]
    raw = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in [*RAW_COLUMNS, "_corrupt_record"]))
    prepared = workflow.prepare(raw, str(tmp_path / "out"))
    assert tuple(prepared.report.first()) == (7, 1, 0, 3)
    assert parquet.read_clean(spark, str(tmp_path / "out")).count() == 1


def test_databases_of_queries_can_be_dropped(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS registry_of_others")
    catalog.load_reconcile(spark, SF).collect()
    made = catalog.drop_loaded(spark)
    left = {d.name for d in spark.catalog.listDatabases()}
    assert made and not left & set(made) and "registry_of_others" in left
    spark.sql("DROP DATABASE registry_of_others")


def test_password_is_not_printed():
    target = jdbc.JdbcTarget("jdbc:x", "t", "u", "secret-word")
    settings = workflow.RunSettings("in", "out", external=target)
    assert "secret-word" not in repr(target) + repr(settings)


def test_scratch_folders_are_deleted_at_the_end(spark, tmp_path):
    with scratch.cleared(spark) as paths:
        scratch.written(spark.range(5), "a")
        scratch.written(spark.range(6), "b").write.parquet(str(tmp_path / "kept"))
    folders = [p.removeprefix("file:") for p in paths]
    assert len(folders) == 2 and not any(os.path.exists(f) for f in folders)
    assert spark.read.parquet(str(tmp_path / "kept")).count() == 6
