"""The registered queries: each takes a session and a folder of tables and gives a DataFrame.

Queries about files, topics and streams first land the tables in the shape they need, in a new
folder under `spark.checkpoint.dir`, and return what the run left behind.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reviewflow import catalog, keyed_tables
from reviewflow.operators import customers as people
from reviewflow.operators import records, reviews, words
from reviewflow.plans import feeds
from reviewflow.schemas import CUSTOMER_FIELDS, ENRICHED, REVIEW
from reviewflow.session import file_count, shared_folder, widen
from reviewflow.sources import files, rows, topics
from reviewflow.streaming import batches, progress, sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

DATABASE = "reviewflow"

# Streams over a topic read it in about this many micro-batches.
BATCHES = 2

# The running count reads its files in this many micro-batches, and has its state in so many parts.
COUNT_BATCHES = 3
STATE_PARTITIONS = 16

# Publications of a topic whose batches are told, and files of each; where malformed records are cut off.
PUBLICATIONS = 6
PUBLISHED_FILES = 4
CUT_AT = 40

# Buckets of keyed tables that streams look up or put into.
BUCKETS = 8


def query(function: Callable[[SparkSession, str], DataFrame]):
    """Register a query under its name."""
    QUERIES[function.__name__] = function
    return function


def new_topic(spark: SparkSession, name: str) -> topics.FileTopic:
    return topics.FileTopic(name, shared_folder(spark, f"topic-{name}"))


def published(spark: SparkSession, name: str, messages: DataFrame) -> topics.FileTopic:
    topic = new_topic(spark, name)
    topic.publish(messages)
    return topic


def streamed(spark: SparkSession, topic: topics.FileTopic) -> DataFrame:
    return topic.stream(spark, topic.files_per_batch(spark, BATCHES))


def work_database(spark: SparkSession) -> str:
    """The database that tables of the queries lie in."""
    if not spark.catalog.databaseExists(DATABASE):
        catalog.create_database(spark, DATABASE, shared_folder(spark, "database"))
    return DATABASE


def without_review_date(stored: DataFrame) -> DataFrame:
    """Review fields with the date as seconds since 1970, which no time zone setting changes."""
    epoch = F.unix_seconds("review_date").alias("review_epoch")
    return stored.select(*[name for name in REVIEW.names if name != "review_date"], epoch)


# Words


@query
def word_count(spark: SparkSession, folder: str) -> DataFrame:
    return words.rank_words(words.count_words(feeds.document_lines(spark, folder)))


@query
def word_count_sql(spark: SparkSession, folder: str) -> DataFrame:
    return catalog.word_count_sql(feeds.document_lines(spark, folder))


@query
def top_words(spark: SparkSession, folder: str) -> DataFrame:
    return words.top_words(words.count_words(feeds.document_lines(spark, folder)))


def streamed_lines(spark: SparkSession, folder: str, source: str | None = None) -> DataFrame:
    """The lines of all documents as a stream over text files, in several batches."""
    source = source or shared_folder(spark, "lines")
    feeds.document_lines(spark, folder).write.text(source)
    return files.stream_text(spark, source, max(1, file_count(spark, source) // COUNT_BATCHES))


@query
def word_count_stream(spark: SparkSession, folder: str) -> DataFrame:
    """A running count over text files, several batches, ranked within the stream; its last snapshot."""
    lines, path = streamed_lines(spark, folder), shared_folder(spark, "word-count")
    sinks.wait(
        sinks.each_batch(
            words.rank_words(words.count_words(lines)),
            sinks.snapshot_table(path),
            checkpoint=shared_folder(spark, "checkpoint"),
            output_mode="complete",
            state_partitions=STATE_PARTITIONS,
        )
    )
    return sinks.read_snapshot(spark, path)


@query
def word_count_updates(spark: SparkSession, folder: str) -> DataFrame:
    """A running count over text files, several batches, of which each puts the words it changed into a keyed table."""
    table, location = f"{work_database(spark)}.word_counts", shared_folder(spark, "word-counts")
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    sinks.wait(
        sinks.each_batch(
            words.count_words(streamed_lines(spark, folder)),
            batches.put_batches(table, "word", location, BUCKETS),
            checkpoint=shared_folder(spark, "checkpoint"),
            output_mode="update",
            state_partitions=STATE_PARTITIONS,
        )
    )
    return keyed_tables.keyed_rows(spark, table)


@query
def top_words_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The top words of a stream that keeps a sketch a batch and no vocabulary."""
    source, path = shared_folder(spark, "lines"), shared_folder(spark, "word-sketches")
    lines = streamed_lines(spark, folder, source)
    sinks.wait(sinks.each_batch(lines, batches.sketch_batches(path), checkpoint=shared_folder(spark, "checkpoint")))
    return words.top_words_of_sketches(spark.read.parquet(path), files.read_text(spark, source))


# Files


@query
def text_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as text files, read back by line without blank lines."""
    path = shared_folder(spark, "text")
    feeds.document_lines(spark, folder).write.text(path)
    return records.without_blank_lines(files.read_text(spark, path))


@query
def tsv_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Review files with a header line: 15 STRING columns named by it."""
    path = shared_folder(spark, "reviews-tsv")
    feeds.order_reviews(spark, folder).write.csv(path, sep="\t", header=True)
    return files.read_tsv(spark, path)


@query
def customer_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Customer files whose columns come in another order than the schema's."""
    path = shared_folder(spark, "customers-tsv")
    shuffled = feeds.customers(spark, folder).select(*reversed(CUSTOMER_FIELDS))
    shuffled.write.csv(path, sep="\t", header=True)
    return files.read_customers(spark, path)


@query
def first_n(spark: SparkSession, folder: str) -> DataFrame:
    table = files.read_table(spark, folder, "customer")
    return feeds.customer_rows(people.first_rows(table, ["c_custkey"], 10))


@query
def rows_to_table(spark: SparkSession, folder: str) -> DataFrame:
    """Literal rows that name the ratings, joined to all reviews."""
    names = rows.rows_to_table(
        spark,
        [(1, "One Star"), (2, "Two Stars"), (3, "Three Stars"), (4, "Four Stars"), (5, "Five Stars")],
        "star_rating INT, rating_name STRING",
    )
    # Spark knows no size of literal rows and would sort all reviews by their few ratings.
    rated = feeds.order_reviews(spark, folder).join(F.broadcast(names), "star_rating")
    return rated.groupBy("star_rating", "rating_name").agg(F.count("*").alias("reviews"))


# Parsing


@query
def parse_tsv(spark: SparkSession, folder: str) -> DataFrame:
    return reviews.parse_review_tsv(feeds.review_tsv_records(spark, folder))


@query
def parse_json(spark: SparkSession, folder: str) -> DataFrame:
    """All fields of a JSON review, typed."""
    parsed = reviews.parse_review_json(feeds.review_json_records(spark, folder))
    return without_review_date(parsed)


@query
def parse_event_json(spark: SparkSession, folder: str) -> DataFrame:
    """The JSON column of the events, with a field that no event has."""
    messages = files.read_table(spark, folder, "events").select(F.col("props").alias("value"))
    return reviews.parse_json(messages, StructType.fromDDL("k INT, absent STRING"))


@query
def avg_rating(spark: SparkSession, folder: str) -> DataFrame:
    messages = feeds.review_json_records(spark, folder)
    return reviews.average_rating(reviews.parse_review_json(messages))


# Customers


@query
def point_lookup(spark: SparkSession, folder: str) -> DataFrame:
    table = files.read_table(spark, folder, "customer")
    return people.lookup_form(feeds.customer_rows(people.point_lookup(table, "c_custkey", 23)))


@query
def batch_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Customers who wrote a review."""
    keys = feeds.order_reviews(spark, folder).select(F.col("customer_id").cast("string"))
    return people.lookup_form(people.batch_lookup(feeds.customers(spark, folder), keys))


@query
def enrich_join(spark: SparkSession, folder: str) -> DataFrame:
    parsed = reviews.parse_review_tsv(feeds.review_tsv_records(spark, folder))
    return people.enrich(parsed, feeds.customers(spark, folder))


def reviewers(spark: SparkSession, folder: str) -> str:
    """A keyed table of the customers."""
    table, location = f"{work_database(spark)}.reviewers", shared_folder(spark, "reviewers")
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    keyed_tables.put_rows(table, feeds.customers(spark, folder), "customer_id", [], location, buckets=BUCKETS)
    return table


def enriched_batches(spark: SparkSession, folder: str, table: str | None = None) -> str:
    """Reviews from a topic, enriched batch by batch from a keyed table; the location of the batch folders."""
    topic = published(spark, "reviews", feeds.review_tsv_records(spark, folder))
    parsed = reviews.parse_review_tsv(topics.values(streamed(spark, topic)))
    path = shared_folder(spark, "enriched")
    if table:
        catalog.create_batch_table(spark, table, path, ENRICHED)
    sinks.wait(
        sinks.each_batch(
            parsed.select(*people.ENRICH_INPUT_FIELDS),
            batches.enrich_batches(reviewers(spark, folder), path, table),
            checkpoint=shared_folder(spark, "checkpoint"),
        )
    )
    return path


@query
def enrich_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Enriched reviews, written batch by batch."""
    return spark.read.parquet(enriched_batches(spark, folder)).drop("batch_id")


@query
def enriched_table(spark: SparkSession, folder: str) -> DataFrame:
    """SQL over enriched reviews by their table's name, each batch a partition."""
    table = f"{work_database(spark)}.enriched"
    enriched_batches(spark, folder, table)
    return spark.sql(f"""
        SELECT customer_id, username, count(*) AS reviews, max(review_id) AS last_review
        FROM {table} WHERE batch_id >= 0
        GROUP BY customer_id, username""")


@query
def latest_per_key(spark: SparkSession, folder: str) -> DataFrame:
    """The last event of each user."""
    events = files.read_table(spark, folder, "events")
    slim = events.select("user_id", "event_id", "event_type", "props")
    return people.latest_per_key(slim, "user_id", ["event_id"])


@query
def key_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """One customer from a keyed table, read from its bucket."""
    return people.lookup_form(keyed_tables.rows_of_key(spark, reviewers(spark, folder), "23"))


@query
def put_rows(spark: SparkSession, folder: str) -> DataFrame:
    """A keyed table after two puts: all customers, then each order's customer."""
    table, location = f"{work_database(spark)}.customers", shared_folder(spark, "customers")
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    first = files.read_table(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_mktsegment").alias("note"),
        F.lit(-1).cast("long").alias("put_id"),
    )
    orders = files.read_table(spark, folder, "orders")
    second = orders.select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("note"),
        F.col("o_orderkey").alias("put_id"),
    )
    keyed_tables.put_rows(table, first, "customer_id", ["put_id"], location)
    return keyed_tables.put_rows(table, second, "customer_id", ["put_id"], location)


# Topics


@query
def publish_keyed_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Conversation turns as keyed CSV records."""
    turns = widen(files.read_table(spark, folder, "conversations"))
    messages = records.csv_records(turns, F.col("conv_id"), F.col("role"), F.col("text"))
    topic = published(spark, "connection-test", messages)
    return topic.read(spark).select("key", "value")


@query
def publish_users(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as CSV records id,name,email, ids from 1."""
    users = feeds.customer_rows(files.read_table(spark, folder, "customer"))
    key = F.col("customer_id").cast("long") + 1
    messages = records.csv_records(users, key, F.col("name"), F.col("email"))
    return published(spark, "connection-test", messages).read(spark).select("key", "value")


@query
def rating_histogram(spark: SparkSession, folder: str) -> DataFrame:
    """All ratings from 1 to 5 with their number of reviews, also those without one."""
    counts = feeds.order_reviews(spark, folder).groupBy("star_rating").agg(F.count("*").alias("ct"))
    ratings = rows.record_ids(spark, 5).withColumnRenamed("id", "star_rating")
    joined = ratings.join(counts, "star_rating", "left")
    return joined.select("star_rating", F.coalesce("ct", F.lit(0)).cast("long").alias("reviews"))


@query
def publish_and_drain(spark: SparkSession, folder: str) -> DataFrame:
    """Review files without their header line, published in two halves at a time, then the topic
    drained to a table."""
    source = shared_folder(spark, "reviews-tsv")
    feeds.order_reviews(spark, folder).write.csv(source, sep="\t", header=True)
    lines = records.without_blank_lines(files.read_text_after_first_line(spark, source))
    topic = new_topic(spark, "reviews")
    half = F.pmod(F.xxhash64("value"), F.lit(2))
    with ThreadPoolExecutor(2) as publishers:
        list(publishers.map(topic.publish, [lines.where(half == 0), lines.where(half == 1)]))
    drained = shared_folder(spark, "drained")
    sinks.wait(
        sinks.append_parquet(
            topics.record_metadata(streamed(spark, topic)),
            drained,
            checkpoint=shared_folder(spark, "checkpoint"),
        )
    )
    return spark.read.parquet(drained).select("topic", "value")


# Stored reviews


def ingest(spark: SparkSession, topic: topics.FileTopic, path: str, checkpoint: str) -> None:
    """Run what a topic has that is new to the checkpoint into parquet."""
    parsed = reviews.parse_review_json(topics.values(streamed(spark, topic)))
    sinks.wait(sinks.append_parquet(reviews.with_processing_time(parsed), path, checkpoint))


def ingested(spark: SparkSession, folder: str) -> str:
    """Run JSON reviews from a topic into parquet; the location of the files."""
    topic = published(spark, "reviews", feeds.review_json_records(spark, folder))
    path = shared_folder(spark, "reviews")
    ingest(spark, topic, path, shared_folder(spark, "checkpoint"))
    return path


def review_table(spark: SparkSession, folder: str, name: str) -> str:
    """An external table over freshly ingested reviews."""
    table = f"{work_database(spark)}.{name}"
    catalog.create_external_table(spark, table, ingested(spark, folder))
    return table


@query
def ingest_parquet_stream(spark: SparkSession, folder: str) -> DataFrame:
    stored = spark.read.parquet(ingested(spark, folder))
    return without_review_date(stored.where("current_tsp IS NOT NULL"))


@query
def ingest_restart(spark: SparkSession, folder: str) -> DataFrame:
    """Reviews published and ingested in two parts, the second run going on at the checkpoint."""
    messages = feeds.review_json_records(spark, folder)
    early = F.pmod(F.xxhash64("value"), F.lit(3)) == 0
    topic, path = new_topic(spark, "reviews"), shared_folder(spark, "reviews")
    checkpoint = shared_folder(spark, "checkpoint")
    for part in (messages.where(early), messages.where(~early)):
        topic.publish(part)
        ingest(spark, topic, path, checkpoint)
    return without_review_date(spark.read.parquet(path))


@query
def external_table(spark: SparkSession, folder: str) -> DataFrame:
    table = review_table(spark, folder, "reviews")
    return spark.sql(f"""
        SELECT product_category, count(*) AS reviews, count(current_tsp) AS stamped,
               CAST(sum(total_votes) AS BIGINT) AS votes
        FROM {table}
        GROUP BY product_category""")


@query
def query_to_location(spark: SparkSession, folder: str) -> DataFrame:
    table = review_table(spark, folder, "reviews_queried")
    sql = f"""
        SELECT product_id, count(*) AS reviews, round(avg(star_rating), 2) AS avg_star_rating
        FROM {table}
        GROUP BY product_id"""
    return catalog.query_to_location(spark, sql, shared_folder(spark, "query-results"))


@query
def table_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and bytes of a table whose rows were counted while a stream wrote them."""
    topic, path = published(spark, "reviews", feeds.review_json_records(spark, folder)), shared_folder(spark, "reviews")
    parsed = reviews.with_processing_time(reviews.parse_review_json(topics.values(streamed(spark, topic))))
    counted = parsed.observe("loaded", F.count(F.lit(1)).alias("rows"))
    with progress.watched(spark) as told:
        stream = sinks.wait(sinks.append_parquet(counted, path, shared_folder(spark, "checkpoint")))
        loaded = told.observed(stream, "loaded", "rows")
    table = f"{work_database(spark)}.reviews_loaded"
    catalog.create_external_table(spark, table, path)
    catalog.record_stats(spark, table, path, loaded)
    stats = catalog.table_stats(spark, table)
    return stats.select("table_name", "row_count", (F.col("size_bytes") > 0).alias("has_bytes"))


@query
def batch_progress(spark: SparkSession, folder: str) -> DataFrame:
    """Batch id and rows of each batch of a topic whose rate cap takes two publications at a time."""
    topic, messages = new_topic(spark, "reviews"), files.read_table(spark, folder, "orders")
    lines = messages.select("o_orderkey", F.to_json(F.struct("o_orderkey", "o_orderstatus")).alias("value"))
    for part in range(PUBLICATIONS):
        topic.publish(lines.where(F.col("o_orderkey") % PUBLICATIONS == part).repartition(PUBLISHED_FILES))
    stream = topics.values(topic.stream(spark, 2 * PUBLISHED_FILES))
    with progress.watched(spark) as told:
        run = sinks.wait(sinks.append_parquet(stream, shared_folder(spark, "drained"), shared_folder(spark, "checkpoint")))
        return told.table(spark, run)


def split_records(spark: SparkSession, folder: str) -> tuple[str, str]:
    """JSON reviews of which every seventh is cut off, sorted into good and malformed records by a stream."""
    cut = F.substring("value", 1, CUT_AT)
    broken = F.get_json_object("value", "$.review_id").substr(2, 20).cast("long") % 7 == 0
    records = feeds.review_json_records(spark, folder).select(F.when(broken, cut).otherwise(F.col("value")).alias("value"))
    topic = published(spark, "reviews", records)
    good, bad = shared_folder(spark, "good"), shared_folder(spark, "malformed")
    parsed = reviews.checked_json(topics.values(streamed(spark, topic)), REVIEW)
    sinks.wait(sinks.each_batch(parsed, batches.split_batches(good, bad), shared_folder(spark, "checkpoint")))
    return good, bad


@query
def good_records(spark: SparkSession, folder: str) -> DataFrame:
    good, _ = split_records(spark, folder)
    return without_review_date(spark.read.parquet(good).drop("batch_id"))


@query
def malformed_records(spark: SparkSession, folder: str) -> DataFrame:
    _, bad = split_records(spark, folder)
    return spark.read.parquet(bad).drop("batch_id")
