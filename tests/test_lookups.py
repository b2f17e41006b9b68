"""Lookups by filters and dictionaries of row groups, and parts of a table cut at quantiles of its key."""

from __future__ import annotations

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cadastra.plans import catalog
from cadastra.plans.houses import houses
from cadastra.schema import CLEAN
from cadastra.sources import jdbc, parquet

SF = "/root/testdata/sf0.01"
SMALL = 32 << 10


def rows_read(df):
    """Rows that the scan handed on: those of the row groups that it did not skip."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().get("numOutputRows").get().value()


def groups_of(path):
    return [pq.ParquetFile(f).metadata for f in sorted(path.glob("*.parquet"))]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Only even ids, in the order of a hash; once with filters, once without."""
    base = tmp_path_factory.mktemp("searchable")
    rows = houses(spark, SF).withColumn("id", F.col("id") * 2)
    rows = rows.repartition(2, "id").sortWithinPartitions(F.xxhash64("id"))
    rows = rows.withColumn("region", F.when(F.spark_partition_id() == 0, "A").otherwise("C"))
    for name, blooms in (("with", ["id"]), ("without", [])):
        parquet.write_searchable(rows, str(base / name), blooms, SMALL)
    return base


def test_filters_skip_row_groups_that_min_and_max_do_not(spark, stored):
    files = groups_of(stored / "with")
    n, groups = sum(f.num_rows for f in files), sum(f.num_row_groups for f in files)
    assert groups > 20
    largest = max(f.row_group(i).num_rows for f in files for i in range(f.num_row_groups))
    ids = [r.id for r in parquet.read_clean(spark, str(stored / "with")).select("id").collect()]
    present = sorted(ids)[n // 2]
    one = parquet.find(spark, str(stored / "with"), "id", [present])
    assert [r.id for r in one.collect()] == [present] and rows_read(one) <= 2 * largest
    assert rows_read(parquet.find(spark, str(stored / "without"), "id", [present])) == n
    # An odd id is in no row group, though between the least and the greatest of each.
    assert rows_read(parquet.find(spark, str(stored / "with"), "id", [present + 1])) <= largest
    assert rows_read(parquet.find(spark, str(stored / "without"), "id", [present + 1])) == n


def test_many_values_are_compared_with_the_filters_too(spark, stored):
    path = str(stored / "with")
    ids = sorted(r.id for r in parquet.read_clean(spark, path).select("id").collect())
    middle = len(ids) // 2
    odd = [i + 1 for i in ids[middle : middle + 3 * parquet.PUSHED_VALUES]]
    absent = parquet.find(spark, path, "id", odd)
    assert absent.collect() == [] and rows_read(absent) < len(ids) / 2
    found = parquet.find(spark, path, "id", [*odd, *ids[:25], ids[0], None])
    assert sorted(r.id for r in found.collect()) == ids[:25]


def test_dictionaries_skip_files_without_a_value(spark, stored):
    path = str(stored / "with")
    first, second = groups_of(stored / "with")
    assert rows_read(parquet.find(spark, path, "region", ["A"])) == first.num_rows
    assert rows_read(parquet.find(spark, path, "region", ["C"])) == second.num_rows
    # Between the two in order, and in no file.
    assert rows_read(parquet.find(spark, path, "region", ["B"])) == 0


def plain_rows(spark, n):
    text = [F.col("id").cast("string").alias(c) for c in ("region", "city", "address", "description")]
    numbers = [F.col("id").cast(f.dataType).alias(f.name) for f in CLEAN if f.name in ("latitude", "longitude", "year", "area", "floors")]
    return spark.range(0, n, 1, 1).select(F.col("id").cast("int"), *numbers, *text).select(*CLEAN.names)


def test_filters_are_a_small_part_of_the_files(spark, tmp_path):
    rows, size = plain_rows(spark, 40_000), {}
    for name, blooms in (("with", ["id"]), ("without", [])):
        parquet.write_searchable(rows, str(tmp_path / name), blooms, SMALL)
        size[name] = sum(f.stat().st_size for f in (tmp_path / name).glob("*.parquet"))
    groups = sum(f.num_row_groups for f in groups_of(tmp_path / "with"))
    assert groups > 50
    assert 0 < size["with"] - size["without"] < groups * (SMALL // 16 + 256)
    assert rows_read(parquet.find(spark, str(tmp_path / "with"), "id", [12_345])) < 4_000


def test_files_of_small_row_groups_have_few_rows(spark, tmp_path):
    parquet.write_searchable(plain_rows(spark, 50_000), str(tmp_path / "small"), row_group_bytes=SMALL)
    files = groups_of(tmp_path / "small")
    assert sum(f.num_rows for f in files) == 50_000
    assert max(f.num_rows for f in files) < 20_000
    parquet.write_searchable(plain_rows(spark, 50_000), str(tmp_path / "large"))
    assert [f.num_rows for f in groups_of(tmp_path / "large")] == [50_000]
    parquet.write_searchable(plain_rows(spark, 5_000), str(tmp_path / "given"), rows_per_file=2_000)
    assert sorted(f.num_rows for f in groups_of(tmp_path / "given")) == [1_000, 2_000, 2_000]


def test_more_rows_are_dealt_to_more_tasks(spark, tmp_path, monkeypatch):
    """As many tasks as the rows need, not four; a region with half of all rows is spread too."""
    priority = F.when(F.col("id") % 2 == 0, "2-HIGH").otherwise(F.concat(F.lit("P"), F.col("id").cast("string")))
    orders = spark.range(12_000).select(
        F.col("id").alias("o_orderkey"),
        F.col("id").alias("o_custkey"),
        F.lit("O").alias("o_orderstatus"),
        F.col("id").cast("double").alias("o_totalprice"),
        F.lit("1995-05-05").cast("timestamp").alias("o_orderdate"),
        priority.alias("o_orderpriority"),
    )
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    monkeypatch.setattr(catalog, "SEARCHABLE_ROWS", 1_000, raising=False)
    for order in ("id", "region"):
        _, path = catalog._searchable(spark, str(tmp_path), order)
        sizes = [f["count"] for f in parquet.read_clean(spark, path).groupBy(F.col("_metadata.file_path")).count().collect()]
        assert sum(sizes) == 12_000 and len(sizes) >= 10 and max(sizes) < 2_500
    found = catalog.find_regions(spark, str(tmp_path))
    assert sorted(r.id for r in found.collect()) == list(range(0, 12_000, 2))
    assert len(catalog.find_ids(spark, str(tmp_path)).collect()) == 25


def test_nothing_is_found_in_nothing(spark, tmp_path, stored):
    path = str(tmp_path / "none")
    parquet.write_searchable(spark.createDataFrame([], CLEAN), path)
    assert parquet.find(spark, path, "id", [1, 2]).collect() == []
    for values in ([], [None]):
        assert parquet.find(spark, str(stored / "with"), "id", values).collect() == []
    odd = spark.createDataFrame([(1, "x"), (None, "y")], "`a b` int, name string")
    parquet.write_searchable(odd, path, ["a b"])
    assert [r.name for r in parquet.find(spark, path, "a b", [1], odd.schema).collect()] == ["x"]


def parts_of(rows, cuts):
    counts = rows.agg(*[F.count_if(F.expr(p)).alias(str(i)) for i, p in enumerate(jdbc.range_predicates("id", cuts))])
    return list(counts.first())


def test_quantiles_balance_clustered_keys(spark):
    rows = spark.range(30_000).select(F.when(F.col("id") < 29_000, F.col("id")).otherwise(F.col("id") * 10**12).alias("id"))
    sizes = parts_of(rows, jdbc.key_cuts(rows, "id", 10))
    assert len(sizes) == 10 and sum(sizes) == 30_000 and max(sizes) < 3_200
    # Even ranges of the same keys leave nearly all rows to the first part.
    width = 30_000 * 10**12 // 10
    assert parts_of(rows, [width * i for i in range(1, 10)])[0] >= 29_000


def test_every_row_meets_one_condition(spark):
    hot = spark.range(9_000).select(F.when(F.col("id") % 3 == 0, 4_000).when(F.col("id") % 100 != 1, F.col("id")).alias("id"))
    cuts = jdbc.key_cuts(hot, "id", 8)
    assert cuts == sorted(set(cuts)) and 4_000 in cuts
    sizes = parts_of(hot, cuts)
    assert sum(sizes) == 9_000 and len(sizes) == len(cuts) + 1
    for rows in ([], [(None,)], [(5,)] * 20):
        same = spark.createDataFrame(rows, "id bigint")
        assert jdbc.key_cuts(same, "id", 8) == []
        assert parts_of(same, []) == [len(rows)]
    assert jdbc.key_cuts(hot, "id", 1) == [] and sum(parts_of(hot, [-3, 0, 7])) == 9_000


class Reader:
    """Records how it is asked for tables, and answers with given ones."""

    def __init__(self, answers):
        self.calls, self.answers, self.asked = [], answers, {}

    @property
    def read(self):
        return self

    def format(self, name):
        self.asked = {}
        return self

    def options(self, **options):
        self.asked |= options
        return self

    def load(self):
        self.calls.append(self.asked)
        return self.answers.pop(0)

    def jdbc(self, url, table, predicates, properties):
        self.calls.append({"url": url, "dbtable": table, "predicates": predicates, **properties})


def test_balanced_reads(spark):
    keys = spark.range(1_000)
    target = jdbc.JdbcTarget("jdbc:db://h/d", "houses", "u", "p")
    edges = spark.createDataFrame([(0, 999)], "low bigint, high bigint")
    reader = Reader([edges, keys])
    jdbc.read_jdbc_balanced(reader, target, connections=4)
    assert reader.calls[1]["partitionColumn"] == "id" and len(reader.calls) == 3
    last = reader.calls[2]
    assert (last["url"], last["dbtable"], last["user"], last["password"]) == ("jdbc:db://h/d", "houses", "u", "p")
    assert len(last["predicates"]) == 4 and last["predicates"][0].endswith("OR id IS NULL")
    sampled = Reader([keys])
    jdbc.read_jdbc_balanced(sampled, target, connections=4, sample="SELECT id FROM houses SAMPLE 0.01")
    assert sampled.calls[0]["query"] == "SELECT id FROM houses SAMPLE 0.01" and len(sampled.calls[1]["predicates"]) == 4
