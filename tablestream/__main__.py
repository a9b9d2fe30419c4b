"""Command line: ``spark-submit`` or ``python -m tablestream <command>``.

    setup       create the tables
    ingest, products-sold, regional-orders, windowed-sales
                run a job on a Kafka topic, or on a folder of JSON lines
    query       preview and count of a table, or its snapshots
    sql         a query over all tables
    emit        a table's rows as keyed JSON messages
    compact     merge small files
    branches    list, create and merge branches of a table
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from tablestream.functions.codec import encode
from tablestream.functions.times import event_time_text
from tablestream.operators.changelog import MAIN, EventTable, open_table
from tablestream.operators.maintain import TARGET_BYTES, compact
from tablestream.operators.publish import publish
from tablestream.operators.windows import row_count
from tablestream.schemas import COMMIT_INTERVAL, TABLES, rejects_of
from tablestream.session import build_session
from tablestream.sources.dimensions import read_csv_dimension
from tablestream.sources.topics import (
    kafka_messages,
    publish_to_kafka,
    text_messages,
    write_messages,
)
from tablestream.streaming import jobs

JOBS = {
    "ingest": jobs.ingest,
    "products-sold": jobs.products_sold,
    "regional-orders": jobs.regional_orders,
    "windowed-sales": jobs.windowed_sales,
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tablestream")
    top.add_argument("--root", required=True, help="folder of the tables")
    top.add_argument("--master", help="Spark master, unless spark-submit sets it")
    commands = top.add_subparsers(dest="command", required=True)

    commands.add_parser("setup")
    for name in JOBS:
        job = commands.add_parser(name)
        job.add_argument("--checkpoint", required=True)
        job.add_argument("--brokers")
        job.add_argument("--topic", default="order_events")
        job.add_argument("--start", default="latest")
        job.add_argument("--group")
        job.add_argument("--inbox", help="folder of JSON lines instead of a topic")
        job.add_argument("--max-files", type=int, help="files per micro-batch of an inbox")
        job.add_argument("--max-offsets", type=int, help="messages per micro-batch of a topic")
        job.add_argument("--branch", default=MAIN)
        job.add_argument("--interval", default=COMMIT_INTERVAL)
        job.add_argument("--once", action="store_true", help="work off what is there and stop")
        if name == "regional-orders":
            job.add_argument("--regions", required=True, help="CSV of regions")
        if name == "products-sold":
            job.add_argument("--state-partitions", type=int)

    query = commands.add_parser("query")
    query.add_argument("table", nargs="?", default="order_events")
    query.add_argument("--snapshots", action="store_true")
    query.add_argument("-n", "--limit", type=int, default=10)
    query.add_argument("--branch", default=MAIN, help="branch to read")
    query.add_argument("--snapshot", type=int, help="version to read")

    sql = commands.add_parser("sql")
    sql.add_argument("text")
    sql.add_argument("--branch", default=MAIN)

    emit = commands.add_parser("emit")
    emit.add_argument("table", nargs="?", default="order_events")
    emit.add_argument("--key", default="order_id")
    emit.add_argument("--brokers")
    emit.add_argument("--topic", default="order_events")
    emit.add_argument("--outbox", help="folder instead of a topic")

    small = commands.add_parser("compact")
    small.add_argument("table")
    small.add_argument("--branch", default=MAIN)
    small.add_argument("--target-bytes", type=int, default=TARGET_BYTES)

    refs = commands.add_parser("branches")
    refs.add_argument("table", nargs="?", default="order_events")
    refs.add_argument("--create", metavar="BRANCH")
    refs.add_argument("--merge", metavar="BRANCH")
    refs.add_argument("--from", dest="source", default=MAIN)
    refs.add_argument("--into", default=MAIN)
    refs.add_argument("--at", type=int, help="version to fork; the newest if not given")
    return top


def find(spark: SparkSession, root: str, name: str) -> EventTable:
    if name.endswith("_rejects"):
        return open_table(spark, root, rejects_of(name.removesuffix("_rejects")))
    return open_table(spark, root, TABLES[name])


def run(spark: SparkSession, args: argparse.Namespace) -> DataFrame | None:
    """Carry out one command; the result to show, if it has any."""
    if args.command == "setup":
        for spec in TABLES.values():
            made = open_table(spark, args.root, spec).create()
            print(f"{spec.name}: {'created' if made else 'exists'}")
        return None
    if args.command in JOBS:
        queries = start_job(spark, args)
        if not args.once:
            spark.streams.awaitAnyTermination()
        for query in queries:
            query.awaitTermination()
        return None
    if args.command == "sql":
        for spec in TABLES.values():
            table = open_table(spark, args.root, spec)
            for branch in table.branches():
                if branch == args.branch:
                    table.register(branch)
                table.register(branch, view=f"{spec.name}__{branch}")
        return spark.sql(args.text)

    table = find(spark, args.root, args.table)
    if args.command == "query":
        if args.snapshots:
            return table.snapshots(args.branch)
        rows = table.read(args.branch, args.snapshot)
        print(f"total rows: {row_count(rows).first().total_events}")
        return rows.limit(args.limit)
    if args.command == "emit":
        rows = table.read()
        if "event_time" in rows.columns:
            rows = rows.withColumn("event_time", event_time_text("event_time"))
        messages = encode(rows.drop("ingestion_time"), args.key)
        if args.outbox:
            write_messages(messages, args.outbox)
        else:
            publish_to_kafka(messages, args.brokers, args.topic)
        return None
    if args.command == "compact":
        print(compact(table, args.branch, args.target_bytes))
        return None
    if args.create:
        table.create_branch(args.create, args.source, args.at)
    if args.merge:
        publish(table, args.merge, args.into)
    heads = [(b, table.latest_version(b)) for b in table.branches()]
    return spark.createDataFrame(heads, "name string, batch_id long")


def start_job(spark: SparkSession, args: argparse.Namespace):
    if args.inbox:
        messages = text_messages(spark, args.inbox, args.max_files)
    else:
        messages = kafka_messages(
            spark,
            args.brokers,
            args.topic,
            start=args.start,
            group_id=args.group,
            max_offsets=args.max_offsets,
        )
    inputs = [messages]
    more = {}
    if args.command == "regional-orders":
        inputs.append(read_csv_dimension(spark, args.regions))
    if args.command == "products-sold":
        more["state_partitions"] = args.state_partitions
    where = {"branch": args.branch, "interval": None if args.once else args.interval}
    started = [JOBS[args.command](*inputs, args.root, args.checkpoint, **where, **more)]
    if args.command == "products-sold":
        started.append(jobs.undecoded(messages, args.root, args.checkpoint, **where))
    return started


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"tablestream {args.command}", args.master)
    shown = run(spark, args)
    if shown is not None:
        # A partition at a time, so that a result of any size is printed whole.
        print("\t".join(shown.columns))
        for row in shown.toLocalIterator():
            print("\t".join("NULL" if v is None else str(v) for v in row))


if __name__ == "__main__":
    main(sys.argv[1:])
