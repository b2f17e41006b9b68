"""Run everything on one registry file or folder: spark-submit run_registry.py --csv … --out …"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from cadastra.plans.workflow import RunSettings, run
from cadastra.sources.jdbc import JdbcTarget


def main() -> None:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("--csv", required=True, help="CSV file or folder")
    args.add_argument("--out", required=True, help="folder for the cleaned table and all results")
    args.add_argument("--table", default="registry.houses")
    args.add_argument("--encoding", default="UTF-16LE")
    args.add_argument("--layout", default="auto", choices=["auto", "lines", "multiline"])
    args.add_argument("--headerless", action="store_true")
    args.add_argument(
        "--external",
        action="store_true",
        help="also load the database that CH_HOST, CH_PORT, CH_USER, CH_PASSWORD, CH_DATABASE name",
    )
    given = args.parse_args()
    spark = SparkSession.builder.appName("building-registry").getOrCreate()
    stored = run(
        spark,
        RunSettings(
            csv_path=given.csv,
            out_dir=given.out,
            table=given.table,
            header=not given.headerless,
            encoding=given.encoding,
            layout=given.layout,
            external=JdbcTarget.from_env() if given.external else None,
        ),
    )
    for name, path in stored.items():
        print(name)
        spark.read.parquet(path).show(50, truncate=False)


if __name__ == "__main__":
    main()
