"""spark-submit job.py INPUT OUTPUT: clean and enrich an order CSV, store it and its KPIs."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from tillroll.operators.enrich import MARGIN
from tillroll.plans.run import Results, run
from tillroll.sinks.versions import publish
from tillroll.sources.orders import land_csv


def main(argv: list[str]) -> Results:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("input", help="CSV file, folder or pattern, on any filesystem of Spark")
    parser.add_argument("output", help="folder for enriched orders, KPIs and summary")
    parser.add_argument("--margin", type=float, default=MARGIN)
    parser.add_argument(
        "--platform-label", required=True, help="value of fulfilled-by that is the platform itself"
    )
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("order-analytics").getOrCreate()

    def write(folder: str) -> Results:
        orders, bad = land_csv(spark, args.input, f"{folder}/landed_lines")
        results = run(orders, folder, margin=args.margin, platform_label=args.platform_label)
        bad.write.text(f"{folder}/malformed_lines")
        return results

    return publish(spark, args.output, write)


if __name__ == "__main__":
    results = main(sys.argv[1:])
    results.ingest.show()
    results.summary.show()
