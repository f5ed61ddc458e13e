"""Command line of the jobs: ``python -m storelens.jobs <job> --help``.

A job reads its feeds, calls one plan or stream and hands the result to one sink. Errors end the
job; nothing is committed after a failure.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import quality
from .operators.enrichment import envelope
from .plans import marketing, operations, quality_job, sales, silver, support
from .schemas import INVENTORY, POS
from .session import build_session, clear_work
from .sinks import folders, jdbc
from .sinks.publish import payload_messages, publish, requests
from .sources import landing, records
from .sources.tables import read_latest_run, read_parquet, read_table
from .streaming import queries as streaming


def _warehouse(args) -> jdbc.Warehouse:
    return jdbc.Warehouse(args.jdbc_url, args.jdbc_user, os.environ[args.jdbc_password_env],
                          args.jdbc_driver)


def _table(spark: SparkSession, args, name: str) -> DataFrame:
    return (read_latest_run if args.latest_run else read_table)(spark, name, args.database)


def run_silver(spark, args) -> None:
    silver.bronze_to_silver(
        spark, {"silver-pos": args.pos_table, "silver-inventory": args.inventory_table},
        args.output, args.database)


def run_sales(spark, args) -> None:
    kpis = sales.sales_kpis(read_parquet(spark, args.pos_path, POS),
                            read_parquet(spark, args.inventory_path, INVENTORY))
    if args.jdbc_url:
        jdbc.replace_table(kpis, _warehouse(args), args.jdbc_table)
    else:
        folders.write_snapshot(kpis, args.output, table_format=args.format)


def run_operations(spark, args) -> None:
    kpis = operations.operations_kpis(_table(spark, args, args.pos_table),
                                      _table(spark, args, args.inventory_table))
    folders.write_snapshot(kpis, args.output, table_format=args.format)


def run_marketing(spark, args) -> None:
    kpis = marketing.marketing_kpis(_table(spark, args, args.web_table),
                                    _table(spark, args, args.crm_table))
    if args.jdbc_url:
        jdbc.append_rows(kpis, _warehouse(args), args.jdbc_table)
    else:
        folders.append_table(kpis, args.output, args.format)


def run_support(spark, args) -> None:
    kpis = support.support_kpis(_table(spark, args, args.crm_table))
    folders.append_table(kpis, args.output, args.format)


def run_quality(spark, args) -> None:
    stamp = folders.run_stamp()
    for table in args.tables:
        rows = quality_job.quality_rows(_table(spark, args, table))
        path = folders.write_run_folder(rows, args.output, table, stamp)
        # The rows just written are clean already; profiling them saves cleaning the table again.
        clean = read_parquet(spark, path).select(*quality_job.cleaned_columns(rows))
        folders.write_run_folder(quality.profile(clean, args.approximate),
                                 args.output, f"{table}-profile", stamp)


# Schema, parser, name pattern and extension of the landing files of each feed.
FEEDS = {"pos": (POS, landing.parse_csv, landing.CSV_GLOB, ".csv"),
         "inventory": (INVENTORY, landing.parse_json, landing.JSON_GLOB, ".json")}


def run_ingest(spark, args) -> None:
    schema, parse, glob, _ = FEEDS[args.feed]
    files = landing.stream_files(spark, args.landing, glob, args.max_files)
    streaming.ingest_files(files, schema, parse, args.output, args.checkpoint,
                           trigger=_trigger(args)).awaitTermination()


def run_announced(spark, args) -> None:
    schema, parse, _, extension = FEEDS[args.feed]
    messages = _open(spark, args).withColumnRenamed(args.body_column, "body")
    streaming.ingest_announced(
        messages.select(F.col("body").cast("string")), (args.bucket, args.prefix, extension), schema,
        parse, args.output, args.checkpoint, args.locate.format,
        trigger=_trigger(args)).awaitTermination()


def _trigger(args) -> dict:
    return {"processingTime": f"{args.every} seconds"} if args.every else streaming.ONCE


def _options(pairs: list[str]) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in pairs)


def _open(spark, args) -> DataFrame:
    return records.open_stream(spark, args.source, args.schema, **_options(args.option))


def _messages(raw: DataFrame, args, encoded: bool) -> DataFrame:
    """Whole payloads as keyed messages, if wanted in an envelope and packed into sends."""
    keyed = payload_messages(records.read_records(raw, encoded=encoded))
    if args.envelope:
        wrapped = envelope(F.parse_json("value"), F.col("key"))
        keyed = keyed.withColumn("value", F.to_json(wrapped))
    return requests(keyed, args.pack) if args.pack else keyed


def run_stream(spark, args) -> None:
    raw = _open(spark, args)
    if args.events:
        raw = records.unpack_events(raw.withColumn("event", F.col(args.data_column).cast("string")))
    else:
        raw = raw.withColumnRenamed(args.data_column, "data")
    trigger, encoded = _trigger(args), not args.plain
    if args.kind == "items":
        query = streaming.store_items(raw, args.output, args.checkpoint, args.key, args.order,
                                      trigger, encoded)
    elif args.kind == "publish":
        query = publish(_messages(raw, args, encoded), args.output, args.checkpoint, args.sink, trigger,
                        **_options(args.sink_option))
    elif args.jdbc_url:
        plans = {"marketing": marketing.marketing_kpis_of_records,
                 "support": support.support_kpis_of_records}
        warehouse = _warehouse(args)
        query = streaming.kpi_rows(
            raw, plans[args.kind],
            lambda row, batch_id, query: jdbc.append_rows(
                jdbc.batch_columns(jdbc.kpi_defaults(row), batch_id, query), warehouse, args.jdbc_table),
            args.checkpoint, trigger, encoded)
    else:
        start = {"marketing": streaming.marketing, "support": streaming.support,
                 "validate": streaming.validate}[args.kind]
        query = start(raw, args.output, args.checkpoint, trigger=trigger, encoded=encoded)
    query.awaitTermination()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="storelens")
    top.add_argument("--shuffle-partitions", type=int)
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, run, *required: str, warehouse: bool = False) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        sub.set_defaults(run=run)
        sub.add_argument("--output")
        sub.add_argument("--format", default="parquet")
        sub.add_argument("--database")
        sub.add_argument("--latest-run", action="store_true",
                         help="read only the last run of tables that are partitioned by run_ts")
        for option in required:
            sub.add_argument(option, required=True)
        if warehouse:
            sub.add_argument("--jdbc-url")
            sub.add_argument("--jdbc-user")
            sub.add_argument("--jdbc-password-env", default="WAREHOUSE_PASSWORD")
            sub.add_argument("--jdbc-driver")
            sub.add_argument("--jdbc-table")
        return sub

    job("silver", run_silver, "--pos-table", "--inventory-table")
    job("sales", run_sales, "--pos-path", "--inventory-path", warehouse=True)
    job("operations", run_operations, "--pos-table", "--inventory-table")
    job("marketing", run_marketing, "--web-table", "--crm-table", warehouse=True)
    job("support", run_support, "--crm-table")
    quality = job("quality", run_quality)
    quality.add_argument("--tables", nargs="+", required=True)
    quality.add_argument("--approximate", action="store_true",
                         help="estimate distinct counts instead of shuffling every value")
    ingest = job("ingest", run_ingest, "--landing", "--checkpoint")
    ingest.add_argument("--feed", choices=["pos", "inventory"], required=True)
    ingest.add_argument("--max-files", type=int)
    stream = job("stream", run_stream, "--checkpoint", warehouse=True)
    stream.add_argument("--kind", required=True,
                        choices=["marketing", "support", "validate", "items", "publish"])
    stream.add_argument("--data-column", default="data")
    stream.add_argument("--plain", action="store_true",
                        help="payloads are plain JSON, as in a topic, not base64")
    stream.add_argument("--events", action="store_true",
                        help="the data column holds function events with records inside")
    stream.add_argument("--envelope", action="store_true",
                        help="publish payloads with arrival time, id and origin around them")
    stream.add_argument("--pack", type=int, help="publish sends of so many records at most")
    stream.add_argument("--key", default="id")
    stream.add_argument("--order", nargs="+", default=["timestamp", "id"])
    stream.add_argument("--sink", default="json")
    stream.add_argument("--sink-option", action="append", default=[], metavar="KEY=VALUE")
    announced = job("announced", run_announced, "--checkpoint", "--bucket", "--prefix")
    announced.add_argument("--feed", choices=["pos", "inventory"], required=True)
    announced.add_argument("--body-column", default="body")
    announced.add_argument("--locate", default="s3a://{}/{}", help="path of a bucket and a key")
    for sub in (stream, announced):
        sub.add_argument("--source", default="parquet")
        sub.add_argument("--schema", help="column list of a file source")
        sub.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
    for sub in (ingest, stream, announced):
        sub.add_argument("--every", type=int, help="seconds between batches; default: run once")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"storelens-{args.job}", shuffle_partitions=args.shuffle_partitions)
    args.run(spark, args)
    clear_work(spark)


if __name__ == "__main__":
    main()
