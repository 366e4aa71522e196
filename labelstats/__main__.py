"""Print the whole analysis of one or two CSV files.

    spark-submit labelstats/__main__.py small.csv [big.csv] --label CLASS --order FIRST,SECOND
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from labelstats.plans.report import describe, judge, reduce_table
from labelstats.sources.readers import read_csv


def print_rows(table: DataFrame) -> None:
    """Print every row, a partition at a time."""
    print("\t".join(table.columns))
    for row in table.toLocalIterator(prefetchPartitions=True):
        print("\t".join(str(v) for v in row))


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="labelstats")
    parser.add_argument("small", help="CSV with a class column and numeric features")
    parser.add_argument("big", nargs="?", help="CSV for the table-wide figures")
    parser.add_argument("--label", required=True, help="name of the class column")
    parser.add_argument("--order", help="class names by index, comma-separated")
    parser.add_argument("--seed", type=int, default=123)
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("labelstats").getOrCreate()
    small = read_csv(spark, args.small)
    order = args.order.split(",") if args.order else None
    tables = describe(small, args.label)
    tables |= judge(small, args.label, label_order=order, seed=args.seed)
    if args.big:
        tables |= reduce_table(read_csv(spark, args.big), args.label)
    for name, table in tables.items():
        print(name)
        print_rows(table)


if __name__ == "__main__":
    main()
