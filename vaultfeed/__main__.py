"""The job: ``spark-submit --py-files vaultfeed.zip vaultfeed/__main__.py --root ... --out ...`` or ``python -m vaultfeed``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from vaultfeed.plans.extract import SOURCES, run
from vaultfeed.plans.parts import Parts
from vaultfeed.sources import Warehouse


def arguments(given: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="vaultfeed", description="Write the extracts of a source for the months before a batch date.")
    where = parser.add_mutually_exclusive_group(required=True)
    where.add_argument("--root", help="folder that holds the warehouse, as <root>/<schema>/<table>")
    where.add_argument("--database", help="catalog database that holds the warehouse")
    parser.add_argument("--schema", default="ADV_DB", help="schema below the root")
    parser.add_argument("--format", default="parquet", help="file format of the tables below the root")
    parser.add_argument("--prefix", default="", help="what the installation puts before its own column names")
    parser.add_argument("--out", required=True, help="folder for extracts and audit")
    parser.add_argument("--months", type=int, default=1, help="whole months before the batch date")
    parser.add_argument("--batch-date", default="", help="yyyymmdd; today if left out")
    parser.add_argument("--source", default="All", choices=sorted(SOURCES))
    parser.add_argument("--formats", nargs="*", default=["csv", "json"], choices=["csv", "json", "envelope"])
    return parser.parse_args(given)


def main(given: Sequence[str] | None = None) -> dict[str, str]:
    """Run the job and print the folder of each extract. Session settings come from spark-submit."""
    args = arguments(given)
    spark = SparkSession.builder.appName("vaultfeed").getOrCreate()
    if args.database:
        warehouse = Warehouse.catalog(spark, args.database, prefix=args.prefix)
    else:
        warehouse = Warehouse.load(spark, args.root, args.schema, args.format, prefix=args.prefix)
    written = run(spark, Parts(warehouse), args.out, args.months, args.batch_date, args.source, args.formats)
    for name, folder in written.items():
        print(f"{name}\t{folder}")
    return written


if __name__ == "__main__":
    main()
