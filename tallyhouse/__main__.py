"""Rebuild the warehouse from a folder of input files.

    python -m tallyhouse INPUT ROOT [--format csv] [--lenient] [--report]
"""

import argparse
import logging
from collections.abc import Sequence

from pyspark.sql import SparkSession

from tallyhouse.plans.pipeline import run_pipeline
from tallyhouse.plans.report import write_report
from tallyhouse.plans.warehouse import Warehouse
from tallyhouse.sources.specs import folder_manifest


def main(arguments: Sequence[str] | None = None) -> Warehouse:
    parser = argparse.ArgumentParser(prog="tallyhouse", description=__doc__.splitlines()[0])
    parser.add_argument("input", help="folder with one file or folder per staging table")
    parser.add_argument("root", help="folder for the staging, core, marts and report tables")
    parser.add_argument("--format", default="csv", choices=["csv", "json", "parquet", "orc"])
    parser.add_argument("--safe-casts", action="store_true", help="NULL for values of a wrong type")
    parser.add_argument("--lenient", action="store_true", help="only report broken constraints")
    parser.add_argument("--collation", help="order of product descriptions, e.g. UNICODE; default bytes")
    parser.add_argument("--report", action="store_true", help="also store the report sets")
    options = parser.parse_args(arguments)

    logging.basicConfig(level=logging.INFO, format="{asctime} {levelname:<7} {message} ({name})", style="{")
    spark = SparkSession.builder.appName("tallyhouse").getOrCreate()
    warehouse = run_pipeline(
        spark,
        folder_manifest(options.input, options.format),
        options.root,
        on_violation="report" if options.lenient else "fail",
        safe_casts=options.safe_casts,
        collation=options.collation,
    )
    if options.report:
        write_report(warehouse)
    return warehouse


if __name__ == "__main__":
    main()
