"""Registry-shaped rows derived from the `orders` table, dirty values included.

Every order becomes one row. Pending low-priority orders have no year and finished
urgent ones have words for their area, so cleaning drops those. Orders give plenty of
skew: a fifth of all rows share the missing region.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.operators.cleaning import drop_incomplete
from cadastra.schema import FIELDS

HOUSES_SQL = """
typed AS (
  SELECT TRY_CAST(o_orderkey AS INT) AS id,
         o_totalprice / 10000 AS latitude,
         o_totalprice / 5000 AS longitude,
         CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL
              ELSE CAST(1795 + floor(date_diff('day', DATE '1995-01-01',
                                               CAST(o_orderdate AS DATE)) / 10) AS INT)
         END AS year,
         CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN NULL
              ELSE o_totalprice / 1000 END AS area,
         CASE WHEN o_orderstatus = 'P' THEN NULL
              ELSE CAST(floor(o_totalprice / 20000) AS INT) END AS floors,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL
              ELSE o_orderpriority || ' / ' || year(o_orderdate) END AS region,
         'Город-' || o_custkey AS city,
         'ул. "Тест", д. ' || o_orderkey || chr(10) || 'корп. 1' AS address,
         'Дом № ' || o_orderkey || ', владелец ' || o_custkey AS description
  FROM orders
),
houses AS (SELECT * FROM typed WHERE id IS NOT NULL AND year IS NOT NULL AND area IS NOT NULL)
"""


def typed_houses(orders: DataFrame) -> DataFrame:
    """Registry columns with their types, incomplete rows included."""
    price = F.col("o_totalprice")
    status = F.col("o_orderstatus")
    priority = F.col("o_orderpriority")
    date = F.to_date("o_orderdate")
    days = F.datediff(date, F.lit("1995-01-01").cast("date"))
    year = F.lit(1795) + F.floor(days / 10).cast("int")
    order = F.col("o_orderkey").cast("string")
    owner = F.col("o_custkey").cast("string")
    return orders.select(
        F.col("o_orderkey").try_cast("int").alias("id"),
        (price / 10000).alias("latitude"),
        (price / 5000).alias("longitude"),
        F.when(~((status == "P") & (priority == "5-LOW")), year).alias("year"),
        F.when(~((status == "F") & (priority == "1-URGENT")), price / 1000).alias("area"),
        F.when(status != "P", F.floor(price / 20000).cast("int")).alias("floors"),
        F.when(
            priority != "4-NOT SPECIFIED",
            F.concat(priority, F.lit(" / "), F.year(date).cast("string")),
        ).alias("region"),
        F.concat(F.lit("Город-"), owner).alias("city"),
        F.concat(F.lit('ул. "Тест", д. '), order, F.lit("\nкорп. 1")).alias("address"),
        F.concat(F.lit("Дом № "), order, F.lit(", владелец "), owner).alias("description"),
    )


def as_registry(typed: DataFrame) -> DataFrame:
    """The same rows as a registry file holds them: all text, file headers."""
    text = {
        "year": F.concat(F.col("year").cast("string"), F.lit(".0")),
        "area": F.coalesce(F.col("area").cast("string"), F.lit("нет данных")),
    }
    return typed.select(
        *[text.get(f.name, F.col(f.name).cast("string")).alias(f.raw) for f in FIELDS]
    )


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet")


def raw_houses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw registry row per order."""
    return as_registry(typed_houses(_orders(spark, sf_dir)))


def houses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned rows, derived lazily, so a query reads and computes only what it uses."""
    return drop_incomplete(typed_houses(_orders(spark, sf_dir)))
