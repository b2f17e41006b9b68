"""The named queries: each takes the session and a folder of tables, over whole tables."""

from __future__ import annotations

import re
from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.functions.casts import to_double
from cadastra.operators import cleaning, file_profiles, groups, profile, quarantine, reconcile, statistics, topk
from cadastra.plans import workflow
from cadastra.plans.houses import houses, raw_houses
from cadastra.schema import CLEAN, RAW_COLUMNS
from cadastra.scratch import new_folder
from cadastra.sources import csv_files, jdbc, loads, parquet, tables

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Files: written to the shared scratch folder first, then read back.


def _through_csv(raw: DataFrame, limits: dict[str, int] | None = None, **form) -> DataFrame:
    path = new_folder(raw.sparkSession, "csv")
    csv_files.write_raw(raw, path, **form)
    return csv_files.read_raw(raw.sparkSession, path, **form, **(limits or {}))


def _comparable(raw: DataFrame) -> DataFrame:
    """Number texts as numbers: engines print the same double differently."""
    numbers = ["latitude", "longitude", "square"]
    return raw.select(
        *[to_double(F.col(c)).alias(c) if c in numbers else F.col(c) for c in RAW_COLUMNS]
    )


def ingest_csv(spark, sf_dir):
    return _comparable(_through_csv(raw_houses(spark, sf_dir)))


def ingest_csv_headerless(spark, sf_dir):
    return _comparable(_through_csv(raw_houses(spark, sf_dir), header=False, encoding="UTF-8"))


def ingest_csv_split(spark, sf_dir):
    """One record per line, so that the line check lets the files be read in splits."""
    one_line = F.translate("address", "\n", " ").alias("address")
    raw = raw_houses(spark, sf_dir).withColumn("address", one_line)
    return _comparable(_through_csv(raw, {"split_above": 0}))


def ingest_csv_stitched(spark, sf_dir):
    """Every record spans lines, so each file is read whole, however large, and then spread."""
    return _comparable(_through_csv(raw_houses(spark, sf_dir), {"split_above": 0}))


def ingest_csv_encodings(spark, sf_dir):
    """Files of three encodings, told by their first bytes, read as one folder."""
    raw, path = raw_houses(spark, sf_dir), new_folder(spark, "csv")
    for left, encoding in enumerate(("UTF-16LE", "UTF-16BE", "UTF-8")):
        own = raw.filter(F.col("house_id").cast("bigint") % 3 == left)
        csv_files.write_raw(own, f"{path}/{encoding}", encoding=encoding)
    return _comparable(csv_files.read_raw(spark, f"{path}/*", encoding="auto"))


def ingest_csv_mixed_headers(spark, sf_dir):
    """Files with two column orders, one with a column more, each bound by its own header."""
    raw = raw_houses(spark, sf_dir)
    path = new_folder(spark, "csv")
    even = F.col("house_id").cast("bigint") % 2 == 0
    csv_files.write_raw(raw.filter(even), f"{path}/a")
    other = raw.filter(~even).select(F.lit("x").alias("note"), *reversed(RAW_COLUMNS))
    csv_files.write_raw(other, f"{path}/b")
    return _comparable(csv_files.read_raw(spark, f"{path}/*"))


def ingest_csv_marks(spark, sf_dir):
    """Every line starts with a byte-order mark, which is text anywhere but at a file's start."""
    marked = F.concat(F.lit("\ufeff"), "house_id").alias("house_id")
    one_line = F.translate("address", "\n", " ").alias("address")
    raw = raw_houses(spark, sf_dir).withColumns({"house_id": marked, "address": one_line})
    return _comparable(_through_csv(raw, {"split_above": 0}))


def ingest_documents(spark, sf_dir):
    """Long texts with quotes, commas and line breaks survive the file form."""
    documents = _table(spark, sf_dir, "documents")
    given = {"house_id": F.col("doc_id").cast("string"), "description": F.col("text")}
    raw = documents.select(
        *[given.get(c, F.lit(None).cast("string")).alias(c) for c in RAW_COLUMNS]
    )
    return _through_csv(raw).select(
        F.col("house_id").cast("bigint").alias("doc_id"), F.col("description").alias("text")
    )


def _dirty_file(spark, sf_dir) -> DataFrame:
    """Pending orders are short rows, open low-priority ones are empty, and finished
    high-priority ones have an id of more than 32 bits."""
    orders = _table(spark, sf_dir, "orders")
    wide = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "2-HIGH")
    short = F.concat_ws(",", "o_orderkey", "o_totalprice", "o_totalprice")
    empty = F.lit("," * (len(RAW_COLUMNS) - 1))
    own = F.when(wide, F.concat(F.lit("7000000000"), "o_orderkey")).otherwise(F.col("o_orderkey"))
    whole = F.concat_ws(",", own, "o_totalprice", "o_totalprice")
    full = F.concat(whole, F.lit(',1953.0,585.6,5,"A","B","C ""D"", 1",E'))
    line = (
        F.when(F.col("o_orderstatus") == "P", short)
        .when((F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "5-LOW"), empty)
        .otherwise(full)
    )
    path = new_folder(spark, "csv")
    orders.select(line.alias("value")).write.text(path)
    return csv_files.read_raw(spark, path, header=False, encoding="UTF-8")


def dq_report(spark, sf_dir):
    return cleaning.read_report(_dirty_file(spark, sf_dir))


def prepare_report(spark, sf_dir):
    """The same counts, and ids that do not fit, taken by the pass that writes the table."""
    return workflow.prepare(_dirty_file(spark, sf_dir), new_folder(spark, "houses")).report


# Rows that cleaning rejects.


def _sorted_out(spark, sf_dir) -> tuple[str, dict[str, int]]:
    root = new_folder(spark, "sinks")
    return root, quarantine.write_sinks(_without_some_ids(spark, sf_dir), root)


def accepted_rows(spark, sf_dir):
    return quarantine.read_accepted(spark, _sorted_out(spark, sf_dir)[0])


def rejected_rows(spark, sf_dir):
    """Every rejected row with its reason, and two fields of its text."""
    rejected = quarantine.read_rejected(spark, _sorted_out(spark, sf_dir)[0])
    text = F.from_json("raw", "locality_name string, description string")
    return rejected.select("reason", "malformed", text["locality_name"].alias("city"), text["description"].alias("description"))


def rejects_by_reason(spark, sf_dir):
    return quarantine.rejects_by_reason(quarantine.read_rejected(spark, _sorted_out(spark, sf_dir)[0]))


def sink_counts(spark, sf_dir):
    """What the writing pass counted: read rows are accepted and rejected ones."""
    counts = _sorted_out(spark, sf_dir)[1]
    return workflow.one_row(spark, {k: counts[k] for k in ("read_rows", "accepted_rows", "rejected_rows")})


# Profiles merged from the states of files.


def _two_loads(spark, sf_dir) -> DataFrame:
    """States of a table that was written in two loads, taken after each."""
    path, state = new_folder(spark, "houses"), new_folder(spark, "states")
    rows = houses(spark, sf_dir)
    for left in (0, 1):
        rows.filter(F.col("id") % 2 == left).write.mode("append").parquet(path)
        file_profiles.update(spark, path, state, CLEAN, ["year"])
    return file_profiles.states(spark, path, state, CLEAN, ["year"])


def null_profile_merged(spark, sf_dir):
    return file_profiles.merged_null_profile(_two_loads(spark, sf_dir), CLEAN)


def year_median_merged(spark, sf_dir):
    """The median from stored sketches; the table is read to check its rank."""
    median = file_profiles.merged_median(_two_loads(spark, sf_dir), "year")
    return statistics.median_check(houses(spark, sf_dir), "year", median).select("n", "within_bound")


def _stored(spark, sf_dir) -> DataFrame:
    path = new_folder(spark, "houses")
    parquet.write_clean(houses(spark, sf_dir), path)
    return parquet.read_clean(spark, path)


def scan_parquet(spark, sf_dir):
    """Two columns and a filter, both reaching the scan."""
    return _stored(spark, sf_dir).filter(F.col("year") >= 1900).select("id", "year")


def parquet_roundtrip(spark, sf_dir):
    return _stored(spark, sf_dir)


# Typed and cleaned rows.


def cast_types(spark, sf_dir):
    return cleaning.cast_types(raw_houses(spark, sf_dir))


def clean(spark, sf_dir):
    return cleaning.clean(raw_houses(spark, sf_dir))


def clean_metrics(spark, sf_dir):
    return cleaning.clean_metrics(cast_types(spark, sf_dir))


def _without_some_ids(spark, sf_dir) -> DataFrame:
    """Raw rows where one id in eleven is missing, and one is no number."""
    left = F.col("house_id").cast("bigint") % 11
    own = F.when(left == 3, F.lit("x")).when(left != 4, F.col("house_id"))
    return raw_houses(spark, sf_dir).withColumn("house_id", own)


def clean_bad_ids(spark, sf_dir):
    return cleaning.clean(_without_some_ids(spark, sf_dir))


def clean_bad_ids_metrics(spark, sf_dir):
    return cleaning.clean_metrics(cleaning.cast_types(_without_some_ids(spark, sf_dir)))


def schema_profile(spark, sf_dir):
    """The column listing, with how many rows of the table lack each value."""
    rows = houses(spark, sf_dir)
    nulls = profile.null_profile(rows).select(F.col("column").alias("name"), "nulls")
    return profile.schema_profile(rows).join(nulls, "name")


def run_metrics(spark, sf_dir):
    rows = houses(spark, sf_dir)
    return profile.run_metrics(
        clean_metrics(spark, sf_dir).drop("dropped_rows"),
        profile.row_count(rows).selectExpr("n AS row_count", "n AS clean_count"),
        statistics.year_stats(rows),
    )


def year_median_approx(spark, sf_dir):
    return statistics.approx_median_check(houses(spark, sf_dir)).select("n", "within_bound")


# Catalog tables.


def _loaded(spark, sf_dir, loads: int = 1) -> tuple[DataFrame, str]:
    """A table of its own per call; returns the load's reconciliation and the database."""
    database = f"registry_{uuid4().hex}"
    path = new_folder(spark, "table")
    source = houses(spark, sf_dir)
    for _ in range(loads):
        report = workflow.load(source, f"{database}.houses", path)
    return report, database


def drop_loaded(spark: SparkSession) -> list[str]:
    """Drop the databases that these queries made, once their results are no longer read."""
    made = [d.name for d in spark.catalog.listDatabases("registry_*")]
    made = [name for name in made if re.fullmatch("registry_[0-9a-f]{32}", name)]
    for name in made:
        spark.sql("DROP DATABASE IDENTIFIER(:db) CASCADE", args={"db": name})
    return made


def load_table(spark, sf_dir):
    """Loaded twice: the second load replaces the first."""
    _, database = _loaded(spark, sf_dir, loads=2)
    return spark.table(f"{database}.houses")


def load_reconcile(spark, sf_dir):
    return _loaded(spark, sf_dir)[0]


def _ranged(spark, sf_dir) -> str:
    """Houses in files of 1,000 rows, by ranges of the id."""
    path = new_folder(spark, "ranges")
    loads.write_ranges(houses(spark, sf_dir), path, rows_per_file=1_000)
    return path


def load_ranges(spark, sf_dir):
    """No file's range reaches into another's, and all rows are there."""
    found = loads.ranges(spark, _ranged(spark, sf_dir))
    return found.agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.count_if("overlaps").alias("overlaps")
    )


def lookup_rows(spark, sf_dir):
    """Rows by id, from the files that may hold them: the first and last ids, and ids that are not there."""
    path = _ranged(spark, sf_dir)
    ends = loads.ranges(spark, path).agg(F.min("low"), F.max("high")).first()
    low, high = ends[0] or 0, ends[1] or 0
    return loads.lookup(spark, path, [low - 5, low, low + 1, (low + high) // 2, high, high + 5])


# Rows that a task sorts and writes.
SEARCHABLE_ROWS = 200_000


def _searchable(spark, sf_dir, order: str) -> tuple[DataFrame, str]:
    """Houses, and files of them in which the rows stand in the order of a hash of one column."""
    rows, path = houses(spark, sf_dir), new_folder(spark, "searchable")
    parts = max(4, -(-rows.count() // SEARCHABLE_ROWS))
    # The id deals the rows of a frequent value to several files.
    dealt = rows.repartitionByRange(parts, F.xxhash64(order), "id").sortWithinPartitions(F.xxhash64(order))
    parquet.write_searchable(dealt, path, ["id"], row_group_bytes=64 << 10)
    return rows, path


def find_ids(spark, sf_dir):
    """Rows by id from files that are in no order of it; of the ids asked for, some are not there."""
    rows, path = _searchable(spark, sf_dir, "id")
    ends = rows.agg(F.min("id"), F.max("id")).first()
    low, high = ends[0] or 0, ends[1] or 0
    return parquet.find(spark, path, "id", [low + i * (high - low) // 24 for i in range(25)] + [high + 5, None])


def find_regions(spark, sf_dir):
    """Rows by region, which the dictionaries of the row groups tell; one region is not there."""
    _, path = _searchable(spark, sf_dir, "region")
    return parquet.find(spark, path, "region", ["2-HIGH / 1995", "3-MEDIUM / 1996", "2-HIGH / nowhere"])


def clustered_parts(spark, sf_dir):
    """Parts of a table whose keys are clustered, cut at quantiles: all rows in one part each, none of them large.

    A third of the lines has keys far above the others.
    """
    number = F.col("l_orderkey").cast("bigint")
    far = number % 3 == 0
    lines = _table(spark, sf_dir, "lineitem").select(F.when(far, number * 1_000_000).otherwise(number).alias("id"))
    parts = jdbc.range_predicates("id", jdbc.key_cuts(lines, "id", 16))
    counts = lines.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.expr(p)).alias(f"part_{i}") for i, p in enumerate(parts)])
    sizes = [F.col(f"part_{i}") for i in range(len(parts))]
    return counts.select(
        "n",
        F.lit(len(parts)).cast("bigint").alias("parts"),
        sum(sizes[1:], sizes[0]).alias("in_parts"),
        (F.greatest(*sizes, F.lit(0)) <= F.col("n") / 16 * 1.1).alias("balanced"),
    )


def load_swapped(spark, sf_dir):
    """Loaded whole, then replaced by a second load; the table shows the second one."""
    table, root = f"registry_{uuid4().hex}.houses", new_folder(spark, "loads")
    rows = houses(spark, sf_dir)
    loads.load_swapped(rows.filter(F.col("id") % 2 == 0), table, root, rows_per_file=1_000)
    loads.load_swapped(rows, table, root, rows_per_file=1_000)
    return spark.table(table)


def reconcile_content(spark, sf_dir):
    """Source and loaded table, column by column and by whole rows."""
    _, database = _loaded(spark, sf_dir)
    return reconcile.content_reconciliation(houses(spark, sf_dir), spark.table(f"{database}.houses"))


def _damaged(spark, sf_dir) -> DataFrame:
    """Houses in which ids divisible by 1,000 have a floor more, and those of half of that have no city."""
    floors = F.when(F.col("id") % 1_000 == 0, F.col("floors") + 1).otherwise(F.col("floors"))
    city = F.when(F.col("id") % 500 != 0, F.col("city"))
    return houses(spark, sf_dir).withColumns({"floors": floors, "city": city})


def reconcile_damaged(spark, sf_dir):
    return reconcile.content_reconciliation(houses(spark, sf_dir), _damaged(spark, sf_dir))


def show_tables(spark, sf_dir):
    """Names in the database, with the row count of the loaded table."""
    report, database = _loaded(spark, sf_dir)
    rows = report.select("target_rows").scalar()
    return tables.list_tables(spark, database).select("table_name", rows.alias("n"))


def sql_topk(spark, sf_dir):
    _, database = _loaded(spark, sf_dir)
    return topk.top_houses(spark, spark.table(f"{database}.houses"))


def _on_houses(operator: Callable[..., DataFrame], *args, **kwargs) -> Query:
    return lambda spark, sf_dir: operator(houses(spark, sf_dir), *args, **kwargs)


def _on(name: str, operator: Callable[..., DataFrame], *args, **kwargs) -> Query:
    return lambda spark, sf_dir: operator(_table(spark, sf_dir, name), *args, **kwargs)


def top_orders(spark, sf_dir):
    """The SQL report over `orders` under the registry's column names."""
    orders = _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("region"),
        F.col("o_orderstatus").alias("city"),
        F.col("o_orderpriority").alias("address"),
        F.col("o_totalprice").alias("area"),
        F.year("o_orderdate").alias("year"),
        F.col("o_custkey").alias("floors"),
    )
    return topk.top_houses(spark, orders, min_area=60_000.0)


def _odd_houses(spark, sf_dir) -> DataFrame:
    """Few areas above 60, many of 60 and many that are no number; long names, zero years."""
    key = F.col("o_orderkey")
    area = F.when(key % 7 == 0, F.lit(float("nan"))).when(key % 900 == 1, 60 + (key % 5) / 10)
    return _table(spark, sf_dir, "orders").select(
        key.alias("id"),
        F.concat(F.lit("Очень длинное название области № "), "o_orderkey").alias("region"),
        F.concat(F.lit("Город с длинным именем "), "o_custkey").alias("city"),
        F.col("o_orderpriority").alias("address"),
        F.coalesce(area, F.when(key % 3 == 0, F.lit(60.0)).otherwise(F.lit(59.99))).alias("area"),
        F.when(key % 4 != 0, (key % 2).cast("int")).alias("year"),
        (F.col("o_custkey") % 3).cast("int").alias("floors"),
    )


def topk_edges(spark, sf_dir):
    return topk.top_houses(spark, _odd_houses(spark, sf_dir))


def topk_edges_report(spark, sf_dir):
    return topk.topk_report(topk_edges(spark, sf_dir))


def largest_with_ties(spark, sf_dir):
    """Many orders share their group's largest value; the lowest key decides."""
    rounded = F.floor(F.col("o_totalprice") / 100_000).cast("int").alias("value")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", rounded)
    return groups.extreme_rows(orders, "o_orderstatus", "value", "o_orderkey")


QUERIES: dict[str, Query] = {
    "ingest_csv": ingest_csv,
    "ingest_csv_headerless": ingest_csv_headerless,
    "ingest_csv_split": ingest_csv_split,
    "ingest_csv_stitched": ingest_csv_stitched,
    "ingest_csv_mixed_headers": ingest_csv_mixed_headers,
    "ingest_csv_encodings": ingest_csv_encodings,
    "ingest_csv_marks": ingest_csv_marks,
    "ingest_documents": ingest_documents,
    "dq_report": dq_report,
    "prepare_report": prepare_report,
    "cast_types": cast_types,
    "clean": clean,
    "clean_metrics": clean_metrics,
    "clean_bad_ids": clean_bad_ids,
    "clean_bad_ids_metrics": clean_bad_ids_metrics,
    "accepted_rows": accepted_rows,
    "rejected_rows": rejected_rows,
    "rejects_by_reason": rejects_by_reason,
    "sink_counts": sink_counts,
    "null_profile_merged": null_profile_merged,
    "year_median_merged": year_median_merged,
    "load_ranges": load_ranges,
    "lookup_rows": lookup_rows,
    "find_ids": find_ids,
    "find_regions": find_regions,
    "clustered_parts": clustered_parts,
    "load_swapped": load_swapped,
    "reconcile_content": reconcile_content,
    "reconcile_damaged": reconcile_damaged,
    "scan_parquet": scan_parquet,
    "parquet_roundtrip": parquet_roundtrip,
    "row_count": _on_houses(profile.row_count),
    "null_profile": _on_houses(profile.null_profile),
    "schema_profile": schema_profile,
    "head_sample": _on_houses(profile.head_sample),
    "run_metrics": run_metrics,
    "year_stats": _on_houses(statistics.year_stats),
    "year_median_approx": year_median_approx,
    "top_regions": _on_houses(groups.top_groups, "region"),
    "top_cities": _on_houses(groups.top_groups, "city"),
    "area_by_region": _on_houses(groups.value_ranges),
    "area_series": _on_houses(groups.range_series),
    "largest_in_region": _on_houses(groups.extreme_rows),
    "smallest_in_region": _on_houses(groups.extreme_rows, largest=False),
    "by_decade": _on_houses(groups.bucket_counts),
    "decade_series": _on_houses(groups.decade_series),
    "load_table": load_table,
    "load_reconcile": load_reconcile,
    "show_tables": show_tables,
    "sql_topk": sql_topk,
    "topk_report": lambda spark, sf_dir: topk.topk_report(
        topk.top_houses(spark, houses(spark, sf_dir))
    ),
    "topk_edges": topk_edges,
    "topk_edges_report": topk_edges_report,
    "largest_with_ties": largest_with_ties,
    # The same operators straight over the given tables.
    "customers_by_nation": _on("customer", groups.top_groups, "c_nationkey"),
    "price_by_priority": _on("orders", groups.value_ranges, "o_orderpriority", "o_totalprice"),
    "parts_by_size": _on("part", groups.bucket_counts, "p_size", 10, "size"),
    "customers_by_balance": _on("customer", groups.bucket_counts, "c_acctbal", 1000, "balance"),
    "top_orders": top_orders,
    "top_event_users": _on("events", groups.top_groups, "user_id"),
    "largest_events": _on("events", groups.extreme_rows, "event_type", "value", "event_id"),
    "price_by_return_flag": _on(
        "lineitem", groups.value_ranges, "l_returnflag", "l_extendedprice"
    ),
    "lines_by_quantity": _on("lineitem", groups.bucket_counts, "l_quantity", 10, "quantity"),
    "line_number_stats": _on("lineitem", statistics.year_stats, "l_linenumber"),
    "order_customer_stats": _on("orders", statistics.year_stats, "o_custkey"),
    "orders_by_customer_range": _on("orders", groups.bucket_counts, "o_custkey", 100, "customers"),
    "lineitem_nulls": _on("lineitem", profile.null_profile),
    "first_documents": _on("documents", profile.head_sample, 10, "doc_id"),
}
