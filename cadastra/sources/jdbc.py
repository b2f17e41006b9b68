"""The cleaned rows in an external database over JDBC.

Rows travel between executors and the database; the driver program sees none.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from itertools import pairwise

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: rows per insert statement batch.
BATCH_ROWS = 50_000


@dataclass(frozen=True)
class JdbcTarget:
    """Where the table is and how to log in."""

    url: str
    table: str
    user: str
    password: str = field(repr=False)
    driver: str | None = None
    # Appended when Spark creates the table, such as an engine and its sort key.
    create_options: str | None = None

    @classmethod
    def from_env(cls, table: str = "houses", scheme: str = "clickhouse") -> JdbcTarget:
        """Settings from CH_HOST, CH_PORT, CH_USER, CH_PASSWORD and CH_DATABASE.

        There is no default password and no default database.
        """
        # The names of the settings, and the host, port and user without them.
        host = os.environ.get("CH_HOST", "clickhouse")
        port = int(os.environ.get("CH_PORT", "8123"))
        return cls(
            url=f"jdbc:{scheme}://{host}:{port}/{os.environ['CH_DATABASE']}",
            table=table,
            user=os.environ.get("CH_USER", "default"),
            password=os.environ["CH_PASSWORD"],
        )

    def options(self) -> dict[str, str]:
        options = {"url": self.url, "user": self.user, "password": self.password}
        return options | ({"driver": self.driver} if self.driver else {})


def write_jdbc(
    df: DataFrame,
    target: JdbcTarget,
    append: bool = False,
    batch_rows: int = BATCH_ROWS,
    connections: int | None = None,
) -> None:
    """Write the rows, one connection per task, replacing the table's rows by default.

    A table that exists keeps its definition; Spark creates a missing one.
    `connections` bounds how many tasks write at once. JDBC has no commit across
    tasks, so compare the counts afterwards (`reconcile`): a task that is lost
    after its commit runs again.
    """
    options = target.options() | {"dbtable": target.table, "batchsize": batch_rows, "truncate": True}
    if connections:
        options["numPartitions"] = connections
    if target.create_options:
        options["createTableOptions"] = target.create_options
    mode = "append" if append else "overwrite"
    df.write.format("jdbc").options(**options).mode(mode).save()


def query_jdbc(spark: SparkSession, target: JdbcTarget, sql: str) -> DataFrame:
    """The result of a statement that the database itself runs, such as a top-k."""
    return spark.read.format("jdbc").options(**target.options(), query=sql).load()


def read_jdbc(
    spark: SparkSession, target: JdbcTarget, key: str = "id", connections: int = 32
) -> DataFrame:
    """Read the table in ranges of its key, so that no single task reads it whole."""
    edges = query_jdbc(
        spark, target, f"SELECT min({key}) AS low, max({key}) AS high FROM {target.table}"
    ).first()
    options = target.options() | {"dbtable": target.table}
    if edges is not None and edges[0] is not None:
        options |= {
            "partitionColumn": key,
            "lowerBound": int(edges[0]),
            "upperBound": int(edges[1]) + 1,
            "numPartitions": connections,
        }
    return spark.read.format("jdbc").options(**options).load()


def key_cuts(keys: DataFrame, key: str = "id", parts: int = 32, error: float = 0.001) -> list[int]:
    """Keys that cut the rows into parts of about equal size, at most one fewer than the parts.

    Each part's bounds lie within `error` of all rows of where they should. A key that
    stands in more rows than a part holds is one cut, and the part after it has all its rows.
    """
    shares = [i / parts for i in range(1, parts)]
    if not shares:
        return []
    number = F.col(key).cast("bigint")
    found = keys.agg(F.percentile_approx(number, shares, round(1 / error)).alias("cuts"), F.min(number).alias("low")).first()
    return sorted({int(c) for c in found["cuts"] or [] if c > found["low"]})


def range_predicates(key: str, cuts: list[int]) -> list[str]:
    """One condition for each part: every row, also one without a key, meets exactly one."""
    if not cuts:
        return ["1 = 1"]
    between = [f"{key} >= {low} AND {key} < {high}" for low, high in pairwise(cuts)]
    return [f"{key} < {cuts[0]} OR {key} IS NULL", *between, f"{key} >= {cuts[-1]}"]


def read_jdbc_balanced(
    spark: SparkSession, target: JdbcTarget, key: str = "id", connections: int = 32, sample: str | None = None
) -> DataFrame:
    """Read the table in parts of about equal size, however its keys are spread.

    Even ranges of the key (`read_jdbc`) leave most rows to one task where keys are
    clustered. Here the bounds are quantiles, which Spark takes of the key column alone,
    read in even ranges; or of `sample`, a statement with that column, where the database can draw one.
    """
    keys = query_jdbc(spark, target, sample) if sample else read_jdbc(spark, target, key, connections).select(key)
    predicates = range_predicates(key, key_cuts(keys, key, connections))
    options = {k: v for k, v in target.options().items() if k != "url"}
    return spark.read.jdbc(target.url, target.table, predicates=predicates, properties=options)
