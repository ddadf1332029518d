"""The jobs and their command line."""

from __future__ import annotations

import argparse
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewflow import catalog, keyed_tables
from reviewflow.operators import customers as people
from reviewflow.operators import records, reviews, words
from reviewflow.schemas import CUSTOMER_FIELDS, ENRICHED
from reviewflow.session import MOST_FILES_PER_BATCH, build_session, shared_folder, sized_shuffles
from reviewflow.sources import files, topics
from reviewflow.streaming import batches, sinks


def word_count(spark: SparkSession, args: argparse.Namespace) -> None:
    """Count the words of text files."""
    lines = files.read_text(spark, args.input)
    counts = catalog.word_count_sql(lines) if args.sql else words.count_words(lines)
    with sized_shuffles(lines):
        if args.output:
            words.rank_words(counts).write.parquet(args.output)
        else:
            words.top_words(counts, args.top).show(args.top, truncate=False)


def word_count_stream(spark: SparkSession, args: argparse.Namespace) -> None:
    """Count the words of a topic; print the top of each batch, or keep the newest counts."""
    counts = words.count_words(topics.values(stream_of(spark, args)))
    work = (
        sinks.snapshot_table(args.output)
        if args.output
        else sinks.show_batch([F.desc("ct"), "word"], args.top)
    )
    query = sinks.each_batch(
        counts, work, args.checkpoint, "complete", trigger_of(args), args.state_partitions
    )
    sinks.wait(query)


def ingest_reviews(spark: SparkSession, args: argparse.Namespace) -> None:
    """Add the JSON reviews of a topic to parquet files; with a table name, name them."""
    parsed = reviews.parse_review_json(topics.values(stream_of(spark, args)))
    stored = reviews.with_processing_time(parsed)
    query = sinks.append_parquet(stored, args.output, args.checkpoint, trigger_of(args))
    if args.table:
        catalog.create_external_table(spark, args.table, args.output)
    sinks.wait(query)
    if args.table:
        catalog.read_external_table(spark, args.table)


def enrich_reviews(spark: SparkSession, args: argparse.Namespace) -> None:
    """Add user name and name to the tab-separated reviews of a topic, batch by batch.

    Customer files are put into a keyed table first: one row per customer, the last. Of a keyed table each batch
    reads the buckets that its customers fall into. With a table name, each batch becomes a partition of that table.
    """
    table = args.customer_table
    if not table:
        rows = files.with_file_order(files.read_customers(spark, args.customers))
        table = f"reviewers_{uuid.uuid4().hex}"
        put_customers(rows, table, shared_folder(spark, "reviewers"))
    parsed = reviews.parse_review_tsv(topics.values(stream_of(spark, args)))
    if args.table:
        catalog.create_batch_table(spark, args.table, args.output, ENRICHED)
    work = batches.enrich_batches(table, args.output, args.table)
    slim = parsed.select(*people.ENRICH_INPUT_FIELDS)
    try:
        sinks.wait(sinks.each_batch(slim, work, args.checkpoint, trigger=trigger_of(args)))
    finally:
        if not args.customer_table:
            spark.sql(f"DROP TABLE {table}")


def load_customers(spark: SparkSession, args: argparse.Namespace) -> None:
    """Put customer files into a keyed table, a later line replacing an earlier of its key."""
    rows = files.with_file_order(files.read_customers(spark, args.input))
    put_customers(rows, args.table, args.location, args.buckets)
    catalog.table_stats(spark, args.table).show(truncate=False)


def put_customers(
    rows: DataFrame, table: str, location: str, buckets: int | None = None
) -> DataFrame:
    return keyed_tables.put_rows(
        table, rows, "customer_id", files.FILE_ORDER, location, CUSTOMER_FIELDS, buckets
    )


def lookup_customer(spark: SparkSession, args: argparse.Namespace) -> None:
    """Print the customer of a key."""
    if keyed_tables.is_keyed(spark, args.table):
        found = keyed_tables.rows_of_key(spark, args.table, args.key)
    else:
        found = people.point_lookup(spark.table(args.table), "customer_id", args.key)
    found.show(truncate=False)


def publish_lines(spark: SparkSession, args: argparse.Namespace) -> None:
    """Publish the lines of text files but blank ones and each file's first, or a known header."""
    lines = (
        records.without_line(files.read_text(spark, args.input), args.header)
        if args.header
        else files.read_text_after_first_line(spark, args.input)
    )
    topic_of(args).publish(records.without_blank_lines(lines))


def publish_users(spark: SparkSession, args: argparse.Namespace) -> None:
    """Publish customer files as CSV records id,name,email keyed by the id."""
    rows = files.read_customers(spark, args.input)
    keyed = records.csv_records(rows, F.col("customer_id"), F.col("name"), F.col("email"))
    topic_of(args).publish(keyed)


def drain_topic(spark: SparkSession, args: argparse.Namespace) -> None:
    """Take what a topic holds now: to parquet files if an output is named, else print the first."""
    held = topics.record_metadata(topic_of(args).read(spark))
    if args.output:
        held.write.parquet(args.output)
    else:
        held.show(args.top, truncate=False)


def run_query(spark: SparkSession, args: argparse.Namespace) -> None:
    """Run SQL from a file over the catalog's tables and keep the result."""
    catalog.run_sql_file(spark, args.sql_file).write.parquet(args.output)


def topic_of(args: argparse.Namespace) -> topics.FileTopic | topics.KafkaTopic:
    if args.topic_path:
        return topics.FileTopic(args.topic, args.topic_path)
    if args.servers:
        return topics.KafkaTopic(args.topic, topics.Connection(args.servers))
    connection = topics.Connection.from_environment(args.environment, truststore=args.truststore)
    return topics.KafkaTopic(args.topic, connection)


def stream_of(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    return topic_of(args).stream(spark, args.max_per_trigger)


def trigger_of(args: argparse.Namespace) -> dict:
    if args.until_done:
        return sinks.ALL_AVAILABLE
    return {"processingTime": f"{args.every} seconds"} if args.every else sinks.AT_ONCE


def parser() -> argparse.ArgumentParser:
    topic = argparse.ArgumentParser(add_help=False)
    topic.add_argument("--topic", required=True)
    where = topic.add_mutually_exclusive_group(required=True)
    where.add_argument("--topic-path", help="folder of a topic kept as files")
    where.add_argument("--servers", help="Kafka brokers, without login")
    where.add_argument("--environment", help="prefix of the variables with brokers and login")
    topic.add_argument("--truststore")

    stream = argparse.ArgumentParser(add_help=False, parents=[topic])
    stream.add_argument("--checkpoint", required=True)
    stream.add_argument(
        "--max-per-trigger",
        type=int,
        help="rate cap: offsets per batch of a Kafka topic (no cap unless given), or files of a "
        f"topic kept as files ({MOST_FILES_PER_BATCH} unless given)",
    )
    pace = stream.add_mutually_exclusive_group()
    pace.add_argument("--until-done", action="store_true", help="stop when all is read")
    pace.add_argument("--every", type=int, help="seconds between batches")

    main_parser = argparse.ArgumentParser(prog="reviewflow")
    jobs = main_parser.add_subparsers(required=True)

    def job(function, *parents: argparse.ArgumentParser) -> argparse.ArgumentParser:
        name = function.__name__.replace("_", "-")
        sub = jobs.add_parser(name, parents=list(parents), help=function.__doc__)
        sub.set_defaults(job=function)
        return sub

    sub = job(word_count)
    sub.add_argument("--input", required=True)
    sub.add_argument("--output")
    sub.add_argument("--sql", action="store_true", help="count with the SQL text")
    sub.add_argument("--top", type=int, default=20)

    sub = job(word_count_stream, stream)
    sub.add_argument("--output")
    sub.add_argument("--top", type=int, default=20)
    sub.add_argument("--state-partitions", type=int, help="parts of the state, for ever")

    sub = job(ingest_reviews, stream)
    sub.add_argument("--output", required=True)
    sub.add_argument("--table")

    sub = job(enrich_reviews, stream)
    sub.add_argument("--output", required=True)
    source = sub.add_mutually_exclusive_group(required=True)
    source.add_argument("--customers", help="tab-separated customer files")
    source.add_argument("--customer-table")
    sub.add_argument("--table", help="name for the output, a partition a batch")

    sub = job(load_customers)
    for name in ("--input", "--table", "--location"):
        sub.add_argument(name, required=True)
    sub.add_argument("--buckets", type=int, help="buckets of a new table, for ever")

    sub = job(lookup_customer)
    sub.add_argument("--table", required=True)
    sub.add_argument("--key", required=True)

    sub = job(publish_lines, topic)
    sub.add_argument("--input", required=True)
    sub.add_argument("--header")

    sub = job(publish_users, topic)
    sub.add_argument("--input", required=True)

    sub = job(drain_topic, topic)
    sub.add_argument("--output")
    sub.add_argument("--top", type=int, default=20)

    sub = job(run_query)
    sub.add_argument("--sql-file", required=True)
    sub.add_argument("--output", required=True)
    return main_parser


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    args.job(build_session(f"reviewflow-{args.job.__name__}"), args)
