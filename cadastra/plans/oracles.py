"""The same results in ANSI SQL, one statement per query name."""

from __future__ import annotations

from cadastra.plans.houses import HOUSES_SQL
from cadastra.schema import FIELDS

_RAW = f"""
WITH {HOUSES_SQL}
SELECT CAST(o_orderkey AS VARCHAR) AS house_id, t.latitude, t.longitude,
       CAST(t.year AS VARCHAR) || '.0' AS maintenance_year, t.area AS square,
       CAST(t.floors AS VARCHAR) AS population, t.region, t.city AS locality_name,
       {{address}} AS address, t.description
FROM orders JOIN typed t ON t.id = o_orderkey
"""


def _houses(sql: str) -> str:
    return f"WITH {HOUSES_SQL}\n{sql}"


def _nulls(table: str, columns: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls,"
        f" CAST((count(*) - count({c})) / count(*) * 100 AS DOUBLE) AS pct FROM {table}"
        for c in columns
    )


def _extreme(table: str, group: str, value: str, tie: str, direction: str) -> str:
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {group} "
        f"ORDER BY {value} {direction}, {tie}) AS rn FROM {table}) WHERE rn = 1"
    )


def _ranges(table: str, group: str, value: str) -> str:
    return (
        f"SELECT {group}, max({value}) AS max_{value}, min({value}) AS min_{value}, "
        f"count(*) AS n FROM {table} GROUP BY {group}"
    )


def _top(table: str, key: str) -> str:
    return (
        f"SELECT {key}, count(*) AS n FROM {table} GROUP BY {key} "
        f"ORDER BY n DESC, {key} NULLS LAST LIMIT 10"
    )


def _buckets(table: str, column: str, width: int, name: str, kind: str = "BIGINT") -> str:
    return (
        f"SELECT CAST(floor({column} / {width}) * {width} AS {kind}) AS {name}, count(*) AS n "
        f"FROM {table} GROUP BY 1"
    )


def _stats(table: str, column: str, kind: str = "INT") -> str:
    return (
        f"SELECT avg({column}) AS avg_{column}, "
        f"CAST(quantile_disc({column}, 0.5) AS {kind}) AS median_{column} FROM {table}"
    )


_TOP = """
SELECT id, region, city, address, area, year, floors FROM {source}
WHERE area > {above} AND NOT isnan(area) ORDER BY area DESC, id LIMIT 25
"""

_ODD_HOUSES = """(
SELECT o_orderkey AS id, 'Очень длинное название области № ' || o_orderkey AS region,
       'Город с длинным именем ' || o_custkey AS city, o_orderpriority AS address,
       CASE WHEN o_orderkey % 7 = 0 THEN CAST('NaN' AS DOUBLE)
            WHEN o_orderkey % 900 = 1 THEN CAST(60 + (o_orderkey % 5) / 10 AS DOUBLE)
            WHEN o_orderkey % 3 = 0 THEN 60.0 ELSE 59.99 END AS area,
       CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderkey % 2 AS INT) END AS year,
       CAST(o_custkey % 3 AS INT) AS floors
FROM orders)"""

_METRICS = """
SELECT 'total_rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM typed
UNION ALL SELECT 'clean_rows', CAST(count(*) AS DOUBLE) FROM houses
UNION ALL SELECT 'row_count', CAST(count(*) AS DOUBLE) FROM houses
UNION ALL SELECT 'clean_count', CAST(count(*) AS DOUBLE) FROM houses
UNION ALL SELECT 'avg_year', avg(year) FROM houses
UNION ALL SELECT 'median_year', CAST(quantile_disc(year, 0.5) AS DOUBLE) FROM houses
"""

_LINEITEM_COLUMNS = [
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
]

_SCHEMA = "\nUNION ALL\n".join(
    f"SELECT {i} AS position, '{f.name}' AS name, '{f.type.simpleString()}' AS type, "
    f"count(*) - count({f.name}) AS nulls FROM houses"
    for i, f in enumerate(FIELDS, 1)
)

_REASONS = """, outcome AS (
  SELECT t.*, CASE WHEN o_orderkey % 11 = 3 THEN 'bad id' WHEN o_orderkey % 11 = 4 THEN 'no id' END AS bad_id,
         CASE WHEN year IS NULL THEN 'no year' END AS bad_year, CASE WHEN area IS NULL THEN 'bad area' END AS bad_area,
         concat_ws(', ', bad_id, bad_year, bad_area) AS reason
  FROM orders JOIN typed t ON t.id = o_orderkey
)
"""
_DAMAGED = "CASE WHEN id % 500 <> 0 THEN city END AS city, CASE WHEN id % 1000 = 0 THEN floors + 1 ELSE floors END AS floors"



def _reconciled(target: str) -> str:
    """Values of each column in houses and in `target`, and whether all are equal, row by row."""
    pairs = [("*", "count(*)", "count(*)", "bool_and(s IS NOT DISTINCT FROM t)")]
    for f in FIELDS:
        same = f"bool_and(s.{f.name} IS NOT DISTINCT FROM t.{f.name})"
        pairs.append((f.name, f"count(s.{f.name})", f"count(t.{f.name})", same))
    return _houses(f", target AS ({target}) " + " UNION ALL ".join(
        f"SELECT '{name}' AS \"column\", {one} AS source_rows, {two} AS target_rows, {same} AS matches"
        " FROM houses s JOIN target t ON s.id = t.id"
        for name, one, two, same in pairs
    ))


ORACLES: dict[str, str] = {
    "ingest_csv": _RAW.format(address="t.address"),
    "ingest_csv_headerless": _RAW.format(address="t.address"),
    "ingest_csv_stitched": _RAW.format(address="t.address"),
    "ingest_csv_split": _RAW.format(address="replace(t.address, chr(10), ' ')"),
    "ingest_csv_mixed_headers": _RAW.format(address="t.address"),
    "ingest_csv_encodings": _RAW.format(address="t.address"),
    "accepted_rows": _houses("SELECT * FROM houses WHERE id % 11 NOT IN (3, 4)"),
    "rejected_rows": _houses(_REASONS + "SELECT reason, false AS malformed, city, description FROM outcome WHERE reason <> ''"),
    "rejects_by_reason": _houses(_REASONS + "SELECT reason, count(*) AS n FROM outcome WHERE reason <> '' GROUP BY reason"),
    "sink_counts": _houses(
        _REASONS + "SELECT count(*) AS read_rows, count(*) FILTER (reason = '') AS accepted_rows,"
        " count(*) FILTER (reason <> '') AS rejected_rows FROM outcome"
    ),
    "null_profile_merged": _houses(_nulls("houses", [f.name for f in FIELDS])),
    "year_median_merged": _houses("SELECT count(*) AS n, true AS within_bound FROM houses"),
    "load_ranges": _houses(
        "SELECT count(*) AS n, CAST(min(id) AS BIGINT) AS low, CAST(max(id) AS BIGINT) AS high, 0 AS overlaps FROM houses"
    ),
    "lookup_rows": _houses(
        ", ends AS (SELECT min(id) AS low, max(id) AS high FROM houses)"
        " SELECT houses.* FROM houses, ends WHERE id IN (low, low + 1, (low + high) // 2, high)"
    ),
    "find_ids": _houses(
        ", ends AS (SELECT min(id) AS low, max(id) AS high FROM houses)"
        " SELECT * FROM houses WHERE id IN (SELECT low + i * (high - low) // 24 FROM ends, range(25) AS asked(i))"
    ),
    "find_regions": _houses("SELECT * FROM houses WHERE region IN ('2-HIGH / 1995', '3-MEDIUM / 1996')"),
    "clustered_parts": (
        "SELECT count(*) AS n, CAST(16 AS BIGINT) AS parts, count(*) AS in_parts, true AS balanced FROM lineitem"
    ),
    "load_swapped": _houses("SELECT * FROM houses"),
    "reconcile_content": _reconciled("SELECT * FROM houses"),
    "reconcile_damaged": _reconciled(f"SELECT * REPLACE ({_DAMAGED}) FROM houses"),
    "ingest_csv_marks": _RAW.replace(
        "CAST(o_orderkey AS VARCHAR) AS house_id", "chr(65279) || o_orderkey AS house_id"
    ).format(address="replace(t.address, chr(10), ' ')"),
    "ingest_documents": "SELECT doc_id, text FROM documents",
    "dq_report": (
        "SELECT count(*) AS total_rows,"
        " count(*) FILTER (o_orderstatus = 'P') AS corrupt_rows,"
        " count(*) FILTER (o_orderstatus = 'O' AND o_orderpriority = '5-LOW') AS empty_rows"
        " FROM orders"
    ),
    "prepare_report": (
        "SELECT count(*) AS total_rows,"
        " count(*) FILTER (o_orderstatus = 'P') AS corrupt_rows,"
        " count(*) FILTER (o_orderstatus = 'O' AND o_orderpriority = '5-LOW') AS empty_rows,"
        " count(*) FILTER (o_orderstatus = 'F' AND o_orderpriority = '2-HIGH') AS overflowing_ids"
        " FROM orders"
    ),
    "cast_types": _houses("SELECT * FROM typed"),
    "clean": _houses("SELECT * FROM houses"),
    "clean_metrics": _houses(
        "SELECT count(*) AS total_rows, count(*) FILTER (complete) AS clean_rows,"
        " count(*) FILTER (NOT complete) AS dropped_rows"
        " FROM (SELECT id IS NOT NULL AND year IS NOT NULL AND area IS NOT NULL AS complete FROM typed)"
    ),
    "clean_bad_ids": _houses("SELECT * FROM houses WHERE id % 11 NOT IN (3, 4)"),
    "clean_bad_ids_metrics": _houses(
        "SELECT count(*) AS total_rows, count(*) FILTER (complete) AS clean_rows,"
        " count(*) FILTER (NOT complete) AS dropped_rows"
        " FROM (SELECT id % 11 NOT IN (3, 4) AND year IS NOT NULL AND area IS NOT NULL AS complete"
        " FROM typed)"
    ),
    "scan_parquet": _houses("SELECT id, year FROM houses WHERE year >= 1900"),
    "parquet_roundtrip": _houses("SELECT * FROM houses"),
    "row_count": _houses("SELECT count(*) AS n FROM houses"),
    "null_profile": _houses(_nulls("houses", [f.name for f in FIELDS])),
    "schema_profile": _houses(_SCHEMA),
    "head_sample": _houses("SELECT * FROM houses ORDER BY id LIMIT 5"),
    "run_metrics": _houses(_METRICS),
    "year_stats": _houses(_stats("houses", "year")),
    "year_median_approx": _houses("SELECT count(*) AS n, true AS within_bound FROM houses"),
    "top_regions": _houses(_top("houses", "region")),
    "top_cities": _houses(_top("houses", "city")),
    "area_by_region": _houses(_ranges("houses", "region", "area")),
    "area_series": _houses(
        f", ranges AS ({_ranges('houses', 'region', 'area')}"
        " ORDER BY max_area DESC, region NULLS LAST LIMIT 15)"
        " SELECT region, 'max_area' AS series, max_area AS value FROM ranges"
        " UNION ALL SELECT region, 'min_area', min_area FROM ranges"
    ),
    "largest_in_region": _houses(_extreme("houses", "region", "area", "id", "DESC")),
    "smallest_in_region": _houses(_extreme("houses", "region", "area", "id", "ASC")),
    "by_decade": _houses(_buckets("houses", "year", 10, "decade", "INT")),
    "decade_series": _houses(
        "SELECT CAST(floor(year / 10) * 10 AS INT) AS decade,"
        " CAST(floor(year / 10) * 10 AS INT) || 's' AS label, count(*) AS n"
        " FROM houses GROUP BY 1, 2"
    ),
    "load_table": _houses("SELECT * FROM houses"),
    "load_reconcile": _houses(
        "SELECT count(*) AS source_rows, count(*) AS target_rows, true AS matches FROM houses"
    ),
    "show_tables": _houses("SELECT 'houses' AS table_name, count(*) AS n FROM houses"),
    "sql_topk": _houses(_TOP.format(source="houses", above=60)),
    "topk_report": _houses(
        "SELECT id, substring(region, 1, 28) AS region, substring(city, 1, 23) AS city,"
        " printf('%.2f', h.area) AS area,"
        " coalesce(CAST(nullif(h.year, 0) AS VARCHAR), 'N/A') AS year,"
        " coalesce(CAST(nullif(h.floors, 0) AS VARCHAR), 'N/A') AS floors"
        f" FROM ({_TOP.format(source='houses', above=60)}) h"
    ),
    "topk_edges": _TOP.format(source=_ODD_HOUSES, above=60),
    "topk_edges_report": (
        "SELECT id, substring(region, 1, 28) AS region, substring(city, 1, 23) AS city,"
        " printf('%.2f', h.area) AS area,"
        " coalesce(CAST(nullif(h.year, 0) AS VARCHAR), 'N/A') AS year,"
        " coalesce(CAST(nullif(h.floors, 0) AS VARCHAR), 'N/A') AS floors"
        f" FROM ({_TOP.format(source=_ODD_HOUSES, above=60)}) h"
    ),
    "largest_with_ties": _extreme(
        "(SELECT o_orderkey, o_custkey, o_orderstatus,"
        " CAST(floor(o_totalprice / 100000) AS INT) AS value FROM orders)",
        "o_orderstatus", "value", "o_orderkey", "DESC",
    ),
    "customers_by_nation": _top("customer", "c_nationkey"),
    "price_by_priority": _ranges("orders", "o_orderpriority", "o_totalprice"),
    "parts_by_size": _buckets("part", "p_size", 10, "size", "INT"),
    "customers_by_balance": _buckets("customer", "c_acctbal", 1000, "balance"),
    "top_orders": _TOP.format(
        source="(SELECT o_orderkey AS id, o_orderpriority AS region, o_orderstatus AS city,"
        " o_orderpriority AS address, o_totalprice AS area,"
        " CAST(year(o_orderdate) AS INT) AS year, o_custkey AS floors FROM orders)",
        above=60_000,
    ),
    "top_event_users": _top("events", "user_id"),
    "largest_events": _extreme("events", "event_type", "value", "event_id", "DESC"),
    "price_by_return_flag": _ranges("lineitem", "l_returnflag", "l_extendedprice"),
    "lines_by_quantity": _buckets("lineitem", "l_quantity", 10, "quantity"),
    "line_number_stats": _stats("lineitem", "l_linenumber"),
    "order_customer_stats": _stats("orders", "o_custkey", "BIGINT"),
    "orders_by_customer_range": _buckets("orders", "o_custkey", 100, "customers"),
    "lineitem_nulls": _nulls("lineitem", _LINEITEM_COLUMNS),
    "first_documents": "SELECT * FROM documents ORDER BY doc_id LIMIT 10",
}
