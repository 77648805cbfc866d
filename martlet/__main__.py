"""Command line: the daily load and the two streaming jobs.

    python -m martlet etl --source-dir DIR --warehouse DIR [--as-of TS]
    python -m martlet etl --jdbc-url URL --user U --password P --warehouse DIR
    python -m martlet ingest --kafka HOST:PORT --topic T --reference DIR --out DIR --checkpoint DIR
    python -m martlet ingest --files DIR --reference DIR --out DIR --checkpoint DIR --once
    python -m martlet minutes --kafka HOST:PORT --topic T --checkpoint DIR [--lateness "0 seconds"]

The cluster's spark-submit settings apply; nothing here overrides sizing.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession

from martlet.schemas import SOURCES
from martlet.session import configure


def _session() -> SparkSession:
    return configure(SparkSession.builder.appName("martlet").getOrCreate())


def _sources(spark: SparkSession, args) -> dict:
    from martlet.sources import readers, splits

    if args.source_dir:
        return {t: readers.read_parquet_source(spark, args.source_dir, t) for t in SOURCES}
    return {t: splits.read_jdbc_splits(spark, args.jdbc_url, t, args.rows_per_split, args.user, args.password) for t in SOURCES}


def cmd_etl(args) -> int:
    from martlet.plans.pipeline import run_pipeline

    spark = _session()
    as_of = dt.datetime.fromisoformat(args.as_of) if args.as_of else dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    summary = run_pipeline(spark, _sources(spark, args), args.warehouse, as_of, strict=args.strict, running=args.running)
    for r in summary.collect():
        print(f"{r.table_name}: {r.candidates} candidates, {r.inserted} inserted")
    return 0


def _stream(spark: SparkSession, args):
    from martlet.streaming import ingest

    if args.kafka:
        return ingest.read_kafka(spark, args.kafka, args.topic)
    return ingest.read_json_files(spark, args.files)


def cmd_ingest(args) -> int:
    from martlet.sources import readers
    from martlet.streaming import ingest

    spark = _session()
    customers = readers.read_parquet_source(spark, args.reference, "customers")
    products = readers.read_parquet_source(spark, args.reference, "products")
    trigger = {"availableNow": True} if args.once else {"processingTime": args.every}
    q = ingest.start_ingest(_stream(spark, args), customers, products, args.out, args.checkpoint, trigger)
    q.awaitTermination()
    return 0


def cmd_minutes(args) -> int:
    from martlet.streaming import clock_minutes, ingest, minute_counts

    spark = _session()
    parsed = ingest.parse(_stream(spark, args))
    trigger = {"availableNow": True} if args.once else {"processingTime": args.every}
    if args.close == "clock":
        grace = round(args.grace * 1000)
        q = (clock_minutes.start_to_table(parsed, args.out, args.checkpoint, grace, trigger) if args.out
             else clock_minutes.start_console(parsed, args.checkpoint, grace, trigger))
    elif args.out:
        q = minute_counts.start_to_table(parsed, args.out, args.checkpoint, args.lateness, trigger)
    else:
        q = minute_counts.start_console(parsed, args.checkpoint, args.lateness, trigger)
    q.awaitTermination()
    return 0


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="martlet")
    sub = ap.add_subparsers(dest="cmd", required=True)

    etl = sub.add_parser("etl", help="snapshot sources, clean, load dimensions and fact")
    src = etl.add_mutually_exclusive_group(required=True)
    src.add_argument("--source-dir", help="folder with one Parquet folder per source table")
    src.add_argument("--jdbc-url")
    etl.add_argument("--rows-per-split", type=int, default=1_000_000, help="rows of one parallel read (--jdbc-url)")
    etl.add_argument("--user")
    etl.add_argument("--password")
    etl.add_argument("--warehouse", required=True)
    etl.add_argument("--as-of", help="ISO timestamp; rows after it are held back (default: now, UTC)")
    etl.add_argument("--strict", action="store_true", help="refuse a snapshot that breaks a declared constraint")
    etl.add_argument("--running", action="store_true", help="keep up running totals of each customer's spend")
    etl.set_defaults(fn=cmd_etl)

    for name, fn, text in [("ingest", cmd_ingest, "validate and split sale events"),
                           ("minutes", cmd_minutes, "completed per-minute transaction counts")]:
        p = sub.add_parser(name, help=text)
        s = p.add_mutually_exclusive_group(required=True)
        s.add_argument("--kafka", help="bootstrap servers")
        s.add_argument("--files", help="folder of JSON-lines files")
        p.add_argument("--topic", default="stream.transaction.raw")
        p.add_argument("--checkpoint", required=True)
        p.add_argument("--once", action="store_true", help="process what is available, then stop")
        p.add_argument("--every", default="1 second", help="trigger interval")
        if name == "ingest":
            p.add_argument("--reference", required=True, help="folder with customers/ and products/")
            p.add_argument("--out", required=True)
        else:
            p.add_argument("--out", help="Parquet folder (default: console)")
            p.add_argument("--lateness", default="0 seconds")
            p.add_argument("--close", choices=["event", "clock"], default="event",
                           help="a minute ends with a later event, or when the clock has passed it")
            p.add_argument("--grace", type=float, default=0, help="seconds a minute stays open after its end (--close clock)")
        p.set_defaults(fn=fn)

    args = ap.parse_args(argv)
    return args.fn(args)


if __name__ == "__main__":
    sys.exit(main())
