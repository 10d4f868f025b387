"""The flows as jobs for ``spark-submit submit.py <job> ...``."""

from __future__ import annotations

import argparse
import importlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from millrace import schemas, sinks, sources, streaming
from millrace.functions import content_id, position_id, quoted
from millrace.operators import word_count
from millrace.plans import publish_events, run_batch_ingest, run_csv_etl
from millrace.session import build_session


def _options(pairs: Sequence[str]) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in pairs)


def _orders(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.url is None:
        return sources.read_table(spark, args.source)
    database = sources.JdbcDatabase(args.url, _options(args.jdbc_option))
    column, predicates = args.partition_column, None
    if args.even_partitions:
        predicates = sources.even_predicates(database.quoted(column), args.partitions)
    ranges = {"equal_ranges": True} if args.equal_ranges else {}
    return sources.read_jdbc(spark, database, args.source, column, args.partitions, predicates, **ranges)


def _target(args: argparse.Namespace, load: Callable[..., object]) -> Callable | str | None:
    """What a flow loads: the catalog table, or ``load`` with the database behind --target-url."""
    if args.target_url is None:
        return args.table
    if args.table is None or args.db_module is None:
        raise SystemExit("--target-url needs --table and --db-module")
    database = sources.JdbcDatabase(args.target_url, _options(args.target_option))
    module = importlib.import_module(args.db_module)
    connect = lambda: module.connect(**_options(args.db_option))
    return lambda frame: load(frame, database, args.table, connect)


def count_words(spark: SparkSession, args: argparse.Namespace) -> None:
    counts = word_count(spark.read.text(args.input), "value", not args.drop_trailing_empty)
    if args.output is not None:
        sinks.write_parquet(counts, args.output)
        return
    for row in counts.toLocalIterator():  # every word, one partition at a time
        print(f"{row['word']}: {row['n']}")


def batch_ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    def load(frame, database, table, connect):
        return sinks.load_jdbc_table(frame, database, table, schemas.ORDERS_TRANSFORMED, connect)

    result = run_batch_ingest(
        _orders(spark, args),
        args.raw,
        args.processed,
        _target(args, load),
        args.table_location,
        landing_format=args.landing,
        journal=args.journal,
        source_version=args.source_version,
    )
    print(f"landed {result.landed_rows} rows, transformed {result.transformed_rows}")


def csv_etl(spark: SparkSession, args: argparse.Namespace) -> None:
    result = run_csv_etl(
        spark,
        args.input,
        args.raw,
        args.transformed,
        args.name,
        _target(args, sinks.replace_jdbc_table),
        args.table_location,
        names=_options(args.rename),
        not_null=args.not_null,
        this_run_only=args.this_run_only,
        infer_types=args.infer_types,
        multi_line=args.multi_line,
        mixed_headers=args.mixed_headers,
        journal=args.journal,
        source_version=args.source_version,
    )
    print(f"landed {result.raw_path}, transformed {result.transformed_path}")


def publish(spark: SparkSession, args: argparse.Namespace) -> None:
    events = sources.read_event_files(
        spark, args.input, schemas.SENSOR_EVENT, args.format, args.files_per_batch
    )
    if args.to_files is None and (args.brokers is None or args.topic is None):
        raise SystemExit("publish-events needs --brokers and --topic, or --to-files")
    sink = (
        streaming.kafka_sink(args.brokers, args.topic, args.acks)
        if args.to_files is None
        else streaming.file_sink(args.to_files)
    )
    # Ids that are missing are named, so that a batch that runs again publishes the same ones.
    if args.format == "parquet":
        named = position_id()
    else:
        named = content_id(*[quoted(f.name) for f in schemas.SENSOR_EVENT.fields])
    shaped = streaming.shape_events(events, named)
    publication = publish_events(shaped, sink, args.checkpoint, args.interval)
    print(f"published {streaming.await_published(publication)} messages")


def _add_target(job: argparse.ArgumentParser) -> None:
    job.add_argument("--table", help="table of the catalog, or of the database at --target-url")
    job.add_argument("--table-location", help="folder of a catalog table's files")
    job.add_argument("--target-url", help="JDBC address of the target")
    job.add_argument("--target-option", action="append", default=[], metavar="KEY=VALUE")
    job.add_argument("--db-module", help="Python module whose connect() opens the target")
    job.add_argument("--db-option", action="append", default=[], metavar="KEY=VALUE")


def _add_journal(job: argparse.ArgumentParser) -> None:
    job.add_argument("--journal", help="folder that remembers finished steps, to go on after a failure")
    job.add_argument("--source-version", help="what this state of the source is called, such as a date")


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="millrace")
    jobs = root.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("word-count", help="count the words of text files")
    job.add_argument("input")
    job.add_argument("--output", help="Parquet folder; without it every count is printed")
    job.add_argument("--drop-trailing-empty", action="store_true")
    job.set_defaults(run=count_words)

    job = jobs.add_parser("batch-ingest", help="orders table to landing, Parquet and target table")
    job.add_argument("source", help="table of the catalog, or of the database at --url")
    job.add_argument("--url", help="JDBC address")
    job.add_argument("--jdbc-option", action="append", default=[], metavar="KEY=VALUE")
    job.add_argument("--partition-column", default="order_id")
    job.add_argument("--partitions", type=int, default=64)
    job.add_argument("--even-partitions", action="store_true", help="for ids with large gaps")
    job.add_argument("--equal-ranges", action="store_true", help="the same by ranges of an index")
    job.add_argument("--raw", required=True)
    job.add_argument("--processed", required=True)
    _add_target(job)
    job.add_argument("--landing", choices=("csv", "parquet"), default="csv")
    _add_journal(job)
    job.set_defaults(run=batch_ingest)

    job = jobs.add_parser("csv-etl", help="CSV files to landing, cleaned CSV and table")
    job.add_argument("input")
    job.add_argument("--raw", required=True)
    job.add_argument("--transformed", required=True)
    job.add_argument("--name", required=True)
    _add_target(job)
    job.add_argument("--rename", action="append", default=[], metavar="OLD=NEW")
    job.add_argument("--not-null", action="append", default=[], metavar="COLUMN")
    job.add_argument("--infer-types", action="store_true")
    job.add_argument("--multi-line", action="store_true", help="cells may hold line breaks")
    job.add_argument("--this-run-only", action="store_true", help="leave out older landings")
    job.add_argument("--mixed-headers", action="store_true", help="files may differ in their columns")
    _add_journal(job)
    job.set_defaults(run=csv_etl)

    job = jobs.add_parser("publish-events", help="event files to a topic")
    job.add_argument("input")
    job.add_argument("--format", default="parquet")
    job.add_argument("--files-per-batch", type=int)
    job.add_argument("--brokers")
    job.add_argument("--topic")
    job.add_argument("--to-files", help="folder of text files, in place of a topic")
    job.add_argument("--acks", default="all")
    job.add_argument("--checkpoint", required=True)
    job.add_argument("--interval", help='such as "1 second"; without it the job ends when done')
    job.set_defaults(run=publish)
    return root


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(spark or build_session(f"millrace {args.job}"), args)


if __name__ == "__main__":
    main()
