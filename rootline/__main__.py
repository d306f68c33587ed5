"""The command line: python -m rootline list | query NAME --data DIR --out PATH | stages FOLDER [--only NAME ...] [--again]."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from rootline.plans import catalogue, domain, stages
from rootline.sources import writers

QUERIES = catalogue.QUERIES | domain.QUERIES


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="rootline", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("list", help="the names of all queries and stages")
    one = commands.add_parser("query", help="run a query over a folder of tables")
    one.add_argument("name", choices=sorted(QUERIES))
    one.add_argument("--data", required=True)
    one.add_argument("--out", required=True)
    one.add_argument("--format", choices=["parquet", "tsv"], default="parquet")
    core = commands.add_parser("stages", help="run the core stages over a folder of tables")
    core.add_argument("folder")
    core.add_argument("--only", nargs="*", choices=[s.name for s in stages.STAGES])
    core.add_argument("--again", action="store_true")
    args = parser.parse_args(argv)
    if args.command == "list":
        print("\n".join([*sorted(QUERIES), *(f"stage {s.name}: {', '.join(s.needs)}" for s in stages.STAGES)]))
        return 0
    spark = SparkSession.builder.appName("rootline").getOrCreate()
    if args.command == "stages":
        print("\n".join(stages.run(spark, args.folder, args.only, args.again)))
        return 0
    df = QUERIES[args.name](spark, args.data)
    writers.write_tsv(df, args.out) if args.format == "tsv" else df.write.mode("overwrite").parquet(args.out)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
