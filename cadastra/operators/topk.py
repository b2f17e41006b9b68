"""The largest buildings above an area, by SQL, and their printed form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.functions.display import or_missing, shortened, two_decimals

# NaN is not above any area; Spark would otherwise rank it first.
_TOP_HOUSES = """
SELECT id, region, city, address, area, year, floors
FROM {houses}
WHERE area > :min_area AND NOT isnan(area)
ORDER BY area DESC NULLS LAST, id ASC NULLS LAST
LIMIT :n
"""


def top_houses(
    spark: SparkSession, houses: DataFrame, min_area: float = 60.0, n: int = 25
) -> DataFrame:
    """The `n` largest buildings with more than `min_area` square metres."""
    return spark.sql(_TOP_HOUSES, args={"min_area": min_area, "n": n}, houses=houses)


def topk_report(top: DataFrame) -> DataFrame:
    """The same rows as report text: cut names, two decimals, `N/A` for missing numbers."""
    return top.select(
        "id",
        shortened(F.col("region"), 28).alias("region"),
        shortened(F.col("city"), 23).alias("city"),
        two_decimals(F.col("area")).alias("area"),
        or_missing(F.col("year")).alias("year"),
        or_missing(F.col("floors")).alias("floors"),
    )
