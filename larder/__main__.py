"""Command line: ``python -m larder <job> ...`` inside a Spark submission.

The source and reporting database is described by LARDER_JDBC_URL, LARDER_JDBC_USER,
LARDER_JDBC_PASSWORD and LARDER_JDBC_DRIVER; with ``--landing`` raw tables come from dropped CSV files.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession

from larder.plans import jobs
from larder.plans.registry import PRODUCTS
from larder.sources.jdbc import Database, Ranges, hash_buckets, remainder
from larder.sources.lake import read_landing
from larder.streaming.landing import follow_landing
from larder.tables import DIMENSIONS, PUBLISHED, SEEDED, table


def database(splits: dict | None = None) -> Database:
    keys = ("url", "user", "password", "driver")
    given = {k: os.environ.get(f"LARDER_JDBC_{k.upper()}") for k in keys}
    if not given["url"]:
        raise SystemExit("LARDER_JDBC_URL is not set")
    return Database({k: v for k, v in given.items() if v}, splits or {})


def parser() -> argparse.ArgumentParser:
    shared = argparse.ArgumentParser(add_help=False)
    shared.add_argument("--root", required=True, help="lake root folder")
    shared.add_argument("--runtype", choices=("prod", "dev"), default="prod")
    load = argparse.ArgumentParser(add_help=False)
    load.add_argument("--loadtype", choices=("full", "delta"), required=True)
    load.add_argument("--landing", help="root of dropped CSV files, instead of the database")
    load.add_argument("--day", help="drop to read in a delta load, YYYY-MM-DD")
    load.add_argument("--parts", type=int, default=16, help="reads for --hash and --ranges")
    load.add_argument("--ranges", action="store_true", help="read each table in --parts ranges of its key, found by a query")

    top = argparse.ArgumentParser(prog="larder", description=__doc__)
    sub = top.add_subparsers(dest="job", required=True)
    raw = sub.add_parser("raw", parents=[shared, load], help="load one raw table")
    raw.add_argument("--table", choices=SEEDED, required=True)
    parallel = raw.add_mutually_exclusive_group()
    parallel.add_argument("--part", action="append", help="SQL condition of one of several reads, which together cover all rows once")
    parallel.add_argument("--hash", help="SQL of a non-negative number that deals rows to --parts reads")
    follow = sub.add_parser("follow", parents=[shared], help="merge newly dropped CSV files of one raw table")
    follow.add_argument("--table", choices=SEEDED, required=True)
    follow.add_argument("--landing", required=True, help="root of dropped CSV files")
    sub.add_parser("dimensions", parents=[shared, load], help="load all dimensions")
    enrich = sub.add_parser("enrich", parents=[shared], help="derive one product")
    enrich.add_argument("--table", choices=tuple(PRODUCTS), required=True)
    enrich.add_argument("--loadtype", choices=("full", "delta"), default="full", help="delta derives changed rows only, where it can")
    publish = sub.add_parser("publish", parents=[shared], help="write products to the database")
    publish.add_argument("--tables", nargs="+", choices=("all", *PUBLISHED), default=["all"])
    publish.add_argument("--mode", choices=("overwrite", "append"), default="overwrite")
    maintain = sub.add_parser("maintain", parents=[shared], help="compact tables")
    maintain.add_argument("--layer", choices=("raw", "enrich"), required=True)
    maintain.add_argument("--tables", nargs="+")
    seed = sub.add_parser("seed", help="fill the source database from JSON files")
    seed.add_argument("--folder", required=True)
    return top


def splits(args: argparse.Namespace, url: str = "") -> dict[str, Ranges | list[str]]:
    """Parallel reads asked for on the command line."""
    if args.job not in ("raw", "dimensions"):
        return {}
    if args.job == "raw" and (args.part or args.hash):
        return {args.table: args.part or hash_buckets(args.hash, args.parts, remainder(url))}
    names = DIMENSIONS if args.job == "dimensions" else (args.table,)
    return {n: Ranges(table(n).key[0], args.parts) for n in names} if args.ranges else {}


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    # Times without a zone are UTC; dimension loads run side by side in fair pools.
    builder = SparkSession.builder.appName(f"larder {args.job}").config("spark.sql.session.timeZone", "UTC")
    spark = builder.config("spark.scheduler.mode", "FAIR").getOrCreate()
    if args.job == "seed":
        return jobs.seed(spark, args.folder, database())
    target = jobs.Lake(spark, args.root, args.runtype)
    if args.job in ("raw", "dimensions"):
        if args.landing:
            def fetch(name, start=None, end=None):
                loadtype = jobs.effective_loadtype(name, args.loadtype)
                return read_landing(spark, args.landing, name, loadtype, args.day, runtype=args.runtype)
        else:
            fetch = jobs.database_fetch(spark, database(splits(args, os.environ.get("LARDER_JDBC_URL", ""))))
        if args.job == "raw":
            jobs.load_raw(target, args.table, fetch, args.loadtype)
        else:
            jobs.load_dimensions(target, fetch, args.loadtype)
    elif args.job == "follow":
        follow_landing(target, args.landing, args.table)
    elif args.job == "enrich":
        jobs.enrich(target, args.table, args.loadtype)
    elif args.job == "publish":
        jobs.publish(target, database(), args.tables, args.mode)
    else:
        jobs.maintain(target, args.layer, args.tables)
    return None


if __name__ == "__main__":
    main()
