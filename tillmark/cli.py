"""The jobs as commands, for ``spark-submit run.py <command> ...``.

Gold tables go to Parquet under the lake, or with ``--jdbc-url`` to a database whose user and password are taken from
the environment variables JDBC_USER and JDBC_PASSWORD.
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
from collections.abc import Sequence

from pyspark.sql import SparkSession

from tillmark.plans import backup, daily, ledger, trending
from tillmark.plans.dashboard import dashboard
from tillmark.plans.snapshot import snapshot
from tillmark.plans.warehouse import load_jdbc_warehouse, load_warehouse
from tillmark.session import get_spark
from tillmark.sinks.jdbc import JdbcTarget, has_table, read_jdbc
from tillmark.sinks.layers import write_layer
from tillmark.sources import messages
from tillmark.sources.layers import exists, read_layer, read_quarantine, read_valid_transactions


#: Tables that may lie under the lake's gold folder, and answers under its dashboard folder.
GOLD = ("dim_date", "dim_customers", "dim_products", "dim_geography", "fct_sales", trending.TABLE)
ANSWERS = ("sales_by_day", "top_products", "sales_by_country", "top_customers", trending.TABLE)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="run.py", description=__doc__.splitlines()[0])
    commands = parser.add_subparsers(dest="command", required=True)
    required = {"lake", "raw-transactions", "raw-countries", "raw-products", "destination"}
    jdbc = ("jdbc-url", "jdbc-driver", "jdbc-partitions", "jdbc-batch-size", "jdbc-truncate")
    ingest = ("clean-source", "archive-folder")
    trends = ("stream", "every", "stop-file", "stop-seconds", "incremental", "partitions")
    flags = {"stream", "incremental", "jdbc-truncate", "whole"}
    numbers = {"jdbc-partitions": int, "jdbc-batch-size": int, "partitions": int, "number": int, "stop-seconds": float}

    def command(name: str, text: str, *options: str) -> None:
        sub = commands.add_parser(name, help=text)
        for option in ("lake", *options):
            if option in flags:
                sub.add_argument(f"--{option}", action="store_true")
            elif option == "clean-source":
                sub.add_argument("--clean-source", choices=("archive", "delete", "off"), default="off")
            else:
                sub.add_argument(f"--{option}", type=numbers.get(option, str), required=option in required)

    command("dimensions", "refresh countries and products", "raw-countries", "raw-products")
    command("ingest", "store new transaction files", "raw-transactions", *ingest)
    command("replay", "judge the stored transactions by the countries as they are now")
    command("warehouse", "refresh the star schema and the reports", *jdbc)
    command("daily", "all of the above", "raw-transactions", "raw-countries", "raw-products", *ingest, *jdbc)
    command("trends", "refresh the trend table", "servers", "topic", "archive", *trends, *jdbc)
    command("dashboard", "print the five questions and store the answers", *jdbc)
    command("snapshot", "copy the bronze tables; with --whole also gold, trends, reports and dashboard", "destination", "whole")
    command("backup", "back up the tables of the lake, copying what earlier backups don't have", "destination")
    command("verify", "read a backup again and list damaged folders", "destination", "number")
    command("restore", "put the tables of a backup into a lake that lacks them", "destination", "number")
    return parser


def _target(options: argparse.Namespace) -> JdbcTarget | None:
    if not options.jdbc_url:
        return None
    given = {"num_partitions": options.jdbc_partitions, "batch_size": options.jdbc_batch_size}
    return JdbcTarget(
        options.jdbc_url,
        os.environ["JDBC_USER"],
        os.environ["JDBC_PASSWORD"],
        options.jdbc_driver,
        truncate=options.jdbc_truncate,
        **{name: value for name, value in given.items() if value is not None},
    )


def _source_options(given: dict) -> dict[str, str | int]:
    """Options of the raw file source: what becomes of files once they are stored."""
    options: dict[str, str | int] = {"maxBytesPerTrigger": daily.BATCH_BYTES}
    if given.get("clean_source", "off") != "off":
        options["cleanSource"] = given["clean_source"]
        if given["archive_folder"]:
            options["sourceArchiveDir"] = given["archive_folder"]
    return options


def _trends(spark: SparkSession, options: argparse.Namespace, gold: str) -> dict[str, int]:
    target = _target(options)

    def write(df, name):
        if target:
            load_jdbc_warehouse({name: df}, target)
        else:
            write_layer(df, name, gold)

    archive, topic = options.archive, (options.servers, options.topic)
    if options.incremental:

        def read(offsets):
            if archive:
                return messages.read_archive_from(spark, archive, offsets)
            return messages.read_topic_from(spark, *topic, offsets, options.partitions)

        return ledger.refresh_from_ledger(spark, read, write, f"{options.lake}/trend_ledger")
    if not options.stream:
        log = messages.read_archive(spark, archive) if archive else messages.read_topic(spark, *topic)
        return trending.refresh_trends(log, write)
    log = messages.stream_archive(spark, archive) if archive else messages.stream_topic(spark, *topic)
    stop = trending.stop_when(log, options.stop_file, options.stop_seconds)
    trending.follow_trends(log, write, f"{options.lake}/checkpoints/trends", every=options.every, stop=stop)
    return {} if target else {trending.TABLE: read_layer(spark, trending.TABLE, gold).count()}


def _snapshot(spark: SparkSession, run: daily.DailyRun, destination: str, whole: bool = False) -> dict[str, int]:
    tables = {
        "countries": read_layer(spark, "countries", run.lake),
        "products": read_layer(spark, "products", run.lake),
        "transactions": read_valid_transactions(spark, run.transactions),
        "quarantine": read_quarantine(spark, run.transactions),
    }
    # What other jobs have written so far; gold tables in a database aren't part of the lake.
    layers = [(run.gold, name) for name in GOLD]
    layers += [(run.reports, name) for name in ("outliers", "invalid_countries", "digest", "alert_lines")]
    layers += [(f"{run.lake}/dashboard", name) for name in ANSWERS]
    for root, name in layers if whole else ():
        if exists(lambda root=root, name=name: read_layer(spark, name, root)):
            tables[f"{root.removeprefix(f'{run.lake}/')}/{name}"] = read_layer(spark, name, root)
    for name in ("outliers.txt", "invalid_country.csv") if whole else ():
        if exists(lambda name=name: spark.read.text(f"{run.reports}/{name}")):
            tables[f"reports/{name}"] = spark.read.text(f"{run.reports}/{name}")
    stamp = f"{dt.datetime.now(dt.timezone.utc):%Y-%m-%d-%H%M%S}"
    return {row.table_name: row.row_count for row in snapshot(spark, tables, destination, stamp).collect()}


def _dashboard(spark: SparkSession, lake: str, gold: str, target: JdbcTarget | None) -> dict[str, int]:
    """Store every answer whole under ``<lake>/dashboard`` and print it row by row, as it is read back in order."""
    read = (lambda name: read_jdbc(spark, name, target)) if target else None
    counts = {}
    has = (lambda name: has_table(spark, name, target)) if target else None
    for name, df in dashboard(spark, gold, read, has).items():
        counts.update(load_warehouse({name: df}, lambda counted, name: write_layer(counted, name, f"{lake}/dashboard")))
        stored = read_layer(spark, name, f"{lake}/dashboard")
        if name.startswith("sales_by"):
            stored = stored.orderBy(stored.columns[0])
        else:
            label, amount = sorted(stored.columns, key=lambda column: column in ("total_sales", "count"))
            stored = stored.orderBy(stored[amount].desc_nulls_last(), stored[label].asc_nulls_last())
        print(name)
        print(*stored.columns, sep=" | ")
        for row in stored.toLocalIterator():
            print(*row, sep=" | ")
    return counts


def main(arguments: Sequence[str] | None = None) -> dict[str, int]:
    """Run one command; prints and returns the rows written per table."""
    parser = _parser()
    options = parser.parse_args(arguments)
    given = vars(options)
    if options.command == "trends" and not options.archive and not (options.servers and options.topic):
        parser.error("trends needs --archive, or --servers and --topic")
    if options.command == "trends":
        if options.incremental and (options.stream or not options.archive and not options.partitions):
            parser.error("--incremental excludes --stream, and with --topic needs --partitions")
        if (options.every or options.stop_file or options.stop_seconds) and not options.stream:
            parser.error("--every, --stop-file and --stop-seconds need --stream")
    if given.get("clean_source") == "archive" and not options.archive_folder:
        parser.error("--clean-source archive needs --archive-folder")
    spark = get_spark(f"tillmark-{options.command}")
    run = daily.DailyRun(
        given.get("raw_transactions", ""),
        given.get("raw_countries", ""),
        given.get("raw_products", ""),
        options.lake,
        _source_options(given),
    )
    target = _target(options) if "jdbc_url" in given else None
    load = (lambda tables: load_jdbc_warehouse(tables, target)) if target else None

    counts: dict[str, int] = {}
    if options.command == "dimensions":
        counts = daily.refresh_dimensions(spark, run)
    elif options.command == "ingest":
        counts = daily.ingest_transactions(spark, run)
    elif options.command == "replay":
        counts = daily.replay_quarantine(spark, run)
    elif options.command == "warehouse":
        counts = {**daily.refresh_gold(spark, run, load), **daily.write_reports(spark, run)}
    elif options.command == "daily":
        counts = daily.run_daily(spark, run, load)
    elif options.command == "trends":
        counts = _trends(spark, options, run.gold)
    elif options.command == "snapshot":
        counts = _snapshot(spark, run, options.destination, options.whole)
    elif options.command == "backup":
        manifest = backup.backup(spark, options.lake, options.destination).collect()
        counts = {row.table_name: 0 for row in manifest}
        for row in manifest:
            counts[row.table_name] += row.row_count
    elif options.command == "verify":
        counts = {backup.SOUND: 0, backup.DAMAGED: 0}
        for row in backup.verify(spark, options.destination, options.number).collect():
            counts[row.state] += 1
            if row.state == backup.DAMAGED:
                print(f"damaged: {row.table_name}/{row.folder}")
    elif options.command == "restore":
        counts = backup.restore(spark, options.destination, options.lake, options.number)
    else:
        counts = _dashboard(spark, options.lake, run.gold, target)
    for name, count in counts.items():
        print(f"{name}: {count}")
    return counts
