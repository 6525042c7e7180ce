"""Command line: ``python -m eventlode stream|daily|marts|quality|kpi``."""

from __future__ import annotations

import argparse
import json
import sys
from datetime import date

from pyspark.sql import SparkSession

from eventlode.operators import kpis, quality
from eventlode.plans import daily
from eventlode.schemas import MESSAGE
from eventlode.session import build_session
from eventlode.sources import streams
from eventlode.streaming import jobs


def _arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="eventlode")
    parser.add_argument("--root", required=True, help="folder of the lake and the warehouse")
    parser.add_argument("--buckets", type=int, default=1024, help="buckets of the fact table, fixed at its creation")
    commands = parser.add_subparsers(dest="command", required=True)

    stream = commands.add_parser("stream", help="run the streaming queries")
    stream.add_argument("mode", nargs="?", default="both", choices=jobs.MODES)
    stream.add_argument("--servers", help="broker addresses; without them messages are read from --landing")
    stream.add_argument("--topic", default="events_raw")
    stream.add_argument("--feed-topic", default="events.processed.v1")
    stream.add_argument("--landing", help="folder of message files")
    stream.add_argument("--trigger", help="an interval, or available_now to stop at the end of the input")
    stream.add_argument("--files-per-partition", type=int, default=0, help="for a backlog that spans many dates")
    stream.add_argument("--kind", default="tumbling", choices=["tumbling", "gap"])

    load = commands.add_parser("daily", help="load one date into the warehouse")
    load.add_argument("--date", help="YYYY-MM-DD, yesterday unless given")
    load.add_argument("--facts-from", default="bronze", choices=["bronze", "sessions"],
                      help="bronze events with their own amounts, or the sessions' lists at a constant amount")

    marts = commands.add_parser("marts", help="rebuild the marts")
    marts.add_argument("--as-of", default=date.today().isoformat())

    check = commands.add_parser("quality", help="check one date; the exit code is 1 when a check fails")
    check.add_argument("--date", default=date.today().isoformat())
    check.add_argument("--output-json", help="folder for the report")

    kpi = commands.add_parser("kpi", help="print a KPI as JSON lines")
    kpi.add_argument("name", choices=["daily-active-users", "revenue", "churn-risk", "summary"])
    kpi.add_argument("--latest", action="store_true", help="the newest dates instead of the oldest")
    return parser


def _stream(spark: SparkSession, args: argparse.Namespace) -> int:
    messages, feed = None, {}
    if args.servers:
        messages = streams.kafka_messages(spark, args.servers, args.topic)
        feed = {"feed_sink": "kafka",
                "feed_options": {"kafka.bootstrap.servers": args.servers, "topic": args.feed_topic}}
    elif args.mode != "silver":
        messages = streams.file_stream(spark, args.landing, MESSAGE)
    jobs.run_stream(spark, messages, jobs.Lake(args.root), args.mode, args.trigger,
                    args.files_per_partition, kind=args.kind, **feed)
    return 0


def _quality(spark: SparkSession, args: argparse.Namespace) -> int:
    path = jobs.Lake(args.root).table("silver_tumbling")
    report = quality.run_quality(quality.read_tolerant(spark, path), args.date, path=path)
    row = report.first()
    print(json.dumps(row.asDict(recursive=True), default=str))
    if args.output_json:
        quality.write_report(report, args.output_json)
    return 0 if row["overall_status"] == "PASSED" else 1


def _kpi(warehouse: daily.Warehouse, args: argparse.Namespace) -> int:
    rows = {
        "daily-active-users": lambda: kpis.dau_trend(warehouse.mart("daily_active_users"), latest=args.latest),
        "revenue": lambda: kpis.top_revenue(warehouse.mart("revenue_per_user")),
        "churn-risk": lambda: kpis.top_churn(warehouse.mart("churn_risk")),
        "summary": lambda: kpis.summary(warehouse.mart("revenue_per_user"), warehouse.mart("churn_risk")),
    }[args.name]()
    # At most fifty rows, by the KPIs' own limits.
    for row in rows.collect():
        print(json.dumps(row.asDict(), default=str))
    return 0


def main(argv: list[str] | None = None) -> int:
    args = _arguments().parse_args(argv)
    spark = build_session(f"eventlode-{args.command}")
    if args.command == "stream":
        return _stream(spark, args)
    if args.command == "quality":
        return _quality(spark, args)
    warehouse = daily.Warehouse(spark, args.root, args.buckets)
    if args.command == "daily":
        warehouse.seed()
        lake = jobs.Lake(args.root)
        bronze = lake.table("bronze") if args.facts_from == "bronze" else None
        added = daily.run_daily(warehouse, lake.table("silver_tumbling"), args.date, bronze_path=bronze)
        print(json.dumps({"facts_added": added}))
        return 0
    if args.command == "marts":
        daily.build_marts(warehouse, args.as_of)
        return 0
    return _kpi(warehouse, args)


if __name__ == "__main__":
    sys.exit(main())
