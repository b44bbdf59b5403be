"""``python -m tripstrata <job>``; start it with spark-submit on a cluster."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from tripstrata.operators.guards import MissingInput
from tripstrata.plans import jobs
from tripstrata.plans.layers import CatalogLayers, Layers
from tripstrata.sources.session import build_session, object_store_settings
from tripstrata.streaming.bronze import run_until_stopped
from tripstrata.streaming.replay import REPORT_EVERY, report_line


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tripstrata")
    kept = parser.add_mutually_exclusive_group(required=True)
    kept.add_argument("--root", help="folder of the layer tables")
    kept.add_argument("--database", help="catalog database of the layer tables: lake.trips")
    parser.add_argument("--checkpoint", help="with --database: folder of the bronze checkpoint")
    parser.add_argument("--table-format", default="iceberg", help="with --database")
    store = parser.add_argument_group("object store", "with --database; needs credentials")
    for option in ("catalog-uri", "warehouse", "endpoint"):
        store.add_argument(f"--{option}")
    job = parser.add_subparsers(dest="job", required=True)

    publish = job.add_parser("publish", help="publish a trip file as events")
    publish.add_argument("--data", required=True)
    replay = job.add_parser("replay", help="publish a trip file at a steady rate")
    replay.add_argument("--data", required=True)
    replay.add_argument("--staging", required=True, help="folder for the cut file and progress")
    replay.add_argument("--rate", type=float, default=5.0, help="events per second")
    runs = replay.add_mutually_exclusive_group()
    runs.add_argument("--passes", type=int, default=1)
    runs.add_argument("--loop", action="store_true", help="pass after pass until interrupted")
    replay.add_argument("--trigger-seconds", type=int, default=10)
    replay.add_argument("--report-every", type=int, default=REPORT_EVERY, help="events")
    bronze = job.add_parser("bronze", help="stream events into bronze")
    bronze.add_argument("--available-now", action="store_true", help="end when all is taken")
    for topic_job in (publish, replay, bronze):
        topic_job.add_argument("--topic", default=jobs.TOPIC)
        topic_job.add_argument("--location", required=True, help="topic folder or Kafka brokers")
        topic_job.add_argument("--format", default="parquet", help="parquet or kafka")
    for topic_job in (publish, bronze):
        topic_job.add_argument("--option", action="append", default=[], metavar="NAME=VALUE")

    refresh = job.add_parser("silver-gold", help="rebuild silver and gold")
    refresh.add_argument("--zones", required=True)
    stats = job.add_parser("stats", help="print statistics")
    report = job.add_parser("report", help="count and sample bronze, also while its stream runs")
    report.add_argument("--sample", type=int, default=10, help="trips to show")
    sql = job.add_parser("sql", help="run SQL over bronze, silver and gold")
    sql.add_argument("text")
    for shown in (stats, report, sql):
        shown.add_argument("--rows", type=int, default=20, help="most rows to print of a result")
    args = parser.parse_args(argv)
    if args.database and not args.checkpoint:
        parser.error("--database needs --checkpoint")
    return args


def _layers(args: argparse.Namespace) -> jobs.AnyLayers:
    if args.root:
        return Layers(args.root)
    return CatalogLayers(args.database, args.checkpoint, args.table_format)


def _settings(args: argparse.Namespace) -> dict[str, str]:
    if not args.catalog_uri:
        return {}
    catalog = args.database.split(".")[0]
    return object_store_settings(catalog, args.catalog_uri, args.warehouse, args.endpoint)


def _run(args: argparse.Namespace, spark: SparkSession) -> None:
    layers = _layers(args)
    options = dict(option.split("=", 1) for option in getattr(args, "option", []))
    if args.job == "publish":
        jobs.publish_trips(spark, args.data, args.location, args.topic, args.format, options)
    elif args.job == "replay":
        replay = jobs.start_paced_replay(
            spark,
            args.data,
            args.staging,
            args.location,
            args.topic,
            args.format,
            args.rate,
            None if args.loop else args.passes,
            args.trigger_seconds,
            tell=lambda report: print(report_line(report), flush=True),
            every=args.report_every,
        )
        replay.run_to_end()
        print(f"sent {replay.report.sent} events in {replay.report.seconds:.0f} seconds")
    elif args.job == "bronze":
        trigger = None if args.available_now else jobs.TRIGGER
        query = jobs.start_bronze_job(
            spark, layers, args.location, args.topic, args.format, options, trigger
        )
        run_until_stopped(query)
    elif args.job == "silver-gold":
        for layer, n in jobs.refresh_silver_and_gold(spark, layers, args.zones).items():
            print(f"{layer}: {n} rows")
    elif args.job == "stats":
        for name, report in jobs.statistics(spark, layers).items():
            print(name)
            report.show(args.rows, truncate=False)
    elif args.job == "report":
        for name, report in jobs.bronze_report(spark, layers, args.sample).items():
            print(name)
            report.show(args.rows, truncate=False)
    else:
        jobs.query_layers(spark, layers, args.text).show(args.rows, truncate=False)


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    spark = build_session(settings=_settings(args))
    try:
        _run(args, spark)
    except MissingInput as problem:
        sys.exit(str(problem))


if __name__ == "__main__":
    main()
