"""Tables with one row per key: puts that rewrite only the buckets they touch, and lookups that read only those.

A keyed table is an external parquet table, partitioned by the bucket of the key and bucketed by the key as well.
So each bucket is a partition with a folder of its own, which a put can replace alone and a lookup can prune to,
and a join on the key reads the table bucket by bucket without a shuffle.
"""

from __future__ import annotations

import re
import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewflow.operators.customers import latest_per_key
from reviewflow.session import (
    MOST_SHUFFLE_PARTITIONS,
    claim_file,
    folder_is_empty,
    qualified,
    remove_folder,
    session_settings,
    source_bytes,
)

# Size of a bucket that a table is laid out for, and Spark's own bound on their number.
BUCKET_BYTES = 16 * 1024 * 1024
MOST_BUCKETS = 100_000

# Input of a put that one task sorts by key, before the shuffle and after it.
TASK_BYTES = 16 * 1024 * 1024

# Spark gives rows that do not come from files a size beyond this.
UNKNOWN_BYTES = 1 << 60

# The partition column.
BUCKET = "bucket"

# Table property, per bucket: the folder that its last put replaced.
PREVIOUS = "reviewflow.previous."

# The folders of puts; nothing of another name is ever removed.
PUT_FOLDER = re.compile(r"put-[0-9a-f]{32}")

# A put that finds its buckets changed merges again, this often; one that finds another moving names waits so long.
TRIES = 5
WAIT_SECONDS = 60
SWITCHING = "_switching"
TURN = threading.Lock()


class Conflict(RuntimeError):
    """Other puts kept changing the same buckets, or one never finished moving its names."""


def bucket_count(rows: DataFrame) -> int:
    """Buckets for a table that starts with these rows; the session's shuffle partitions, if nothing
    is known of their size."""
    size = source_bytes(rows)
    if size > UNKNOWN_BYTES:
        return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(MOST_BUCKETS, -(-size // BUCKET_BYTES)))


def put_parts(rows: DataFrame, buckets: int) -> int:
    """Parts that each bucket's share of a put is sorted in, by the size of the put; one, if that is not known."""
    size = source_bytes(rows)
    wanted = 1 if size > UNKNOWN_BYTES else -(-size // (buckets * TASK_BYTES))
    return max(1, min(MOST_SHUFFLE_PARTITIONS // buckets, wanted))


def put_settings(spark: SparkSession, partitions: int) -> dict[str, str]:
    """Shuffle partitions and file splits of a put, so that no task sorts more when the put is larger."""
    splits = "spark.sql.files.maxPartitionBytes"
    now = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return {"spark.sql.shuffle.partitions": str(partitions), splits: str(min(now, TASK_BYTES))}


def described(spark: SparkSession, table: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE EXTENDED {table}").collect()
    return {row.col_name: row.data_type for row in rows}


def properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def bucket_of(key: Column, buckets: int) -> Column:
    """The bucket of a key, as Spark itself assigns it."""
    return F.pmod(F.hash(key), F.lit(buckets)).cast("int")


def layout(spark: SparkSession, table: str) -> tuple[str, int]:
    """Key and number of buckets."""
    told = described(spark, table)
    return re.fullmatch(r"\[`(.+)`\]", told["Bucket Columns"])[1], int(told["Num Buckets"])


def locations(spark: SparkSession, table: str, buckets: list[int]) -> dict[int, str]:
    """The put folder of each of some buckets that has one."""
    there = {int(row.partition.partition("=")[2]) for row in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    found = {}
    for bucket in buckets:
        if bucket in there:
            rows = spark.sql(f"DESCRIBE EXTENDED {table} PARTITION ({BUCKET} = {bucket})").collect()
            place = next(row.data_type for row in rows if row.col_name == "Location")
            found[bucket] = place.rstrip("/").rsplit("/", 2)[1]
    return found


def keyed_rows(spark: SparkSession, table: str) -> DataFrame:
    """The table without its bucket column."""
    return spark.table(table).drop(BUCKET)


def is_keyed(spark: SparkSession, table: str) -> bool:
    told = described(spark, table)
    return told.get(BUCKET) == "int" and "Bucket Columns" in told


def home_of(spark: SparkSession, table: str) -> str:
    """Where the folders of a table's puts lie: beside that of its first, which is the table's own location."""
    return described(spark, table)["Location"].rstrip("/").rpartition("/")[0]


def rows_near(spark: SparkSession, table: str, keys: DataFrame) -> DataFrame:
    """Rows of the buckets that some keys fall into; other buckets are not read.

    The numbers of these buckets, no more than the table has, are brought to the driver. The keys' column has the name
    of the table's key. With keys in all buckets this is the whole table.
    """
    key, buckets = layout(spark, table)
    kind = spark.table(table).schema[key].dataType
    hit = keys.select(bucket_of(F.col(key).cast(kind), buckets).alias(BUCKET)).distinct().collect()
    return spark.table(table).where(F.col(BUCKET).isin([row[BUCKET] for row in hit])).drop(BUCKET)


def rows_of_key(spark: SparkSession, table: str, value) -> DataFrame:
    """Rows of one key, read from its bucket."""
    key, buckets = layout(spark, table)
    kind = spark.table(table).schema[key].dataType
    of = F.lit(value).cast(kind)
    return spark.table(table).where(F.col(BUCKET) == bucket_of(of, buckets)).where(F.col(key) == of).drop(BUCKET)


def with_keys(rows: DataFrame, key: str) -> DataFrame:
    """The rows; one without a key fails the job that reads it."""
    checked = F.when(F.col(key).isNotNull(), F.col(key)).otherwise(F.raise_error(F.lit(f"null {key}")))
    return rows.withColumn(key, checked)


def merged(kept: DataFrame, latest: DataFrame, key: str) -> DataFrame:
    """One row per key: the latest put, or else the kept one. Both sides have one row per key.

    Both are read bucket by bucket and are not shuffled.
    """
    put = latest.select(F.col(key).alias("_key"), F.struct(*latest.columns).alias("_put"))
    both = kept.join(put, kept[key] == put["_key"], "full_outer")
    newer = F.col("_key").isNotNull()
    return both.select(
        *(F.when(newer, F.col("_put")[name]).otherwise(kept[name]).alias(name) for name in kept.columns)
    )


def write_buckets(rows: DataFrame, buckets: int, key: str, table: str, path: str) -> None:
    """Rows that are partitioned by key already, each task's part of a bucket into one file of one partition."""
    placed = rows.withColumn(BUCKET, bucket_of(F.col(key), buckets))
    writer = placed.write.partitionBy(BUCKET).bucketBy(buckets, key).sortBy(key)
    writer.option("path", path).saveAsTable(table)


@contextmanager
def staged(spark: SparkSession, table: str) -> Iterator[str]:
    """The name of a table beside another, dropped at the end; its files stay."""
    name = f"{table}_{uuid.uuid4().hex}"
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def new_folder() -> str:
    return f"put-{uuid.uuid4().hex}"


def put_rows(
    table: str,
    rows: DataFrame,
    key: str,
    order_by: list[str],
    location: str,
    columns: list[str] | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Put rows into a table with one row per key, made if need be; the table's rows after it.

    A later put replaces the earlier row of its key; within `rows`, later is by `order_by`, which may
    use columns that are not kept, and then by the columns kept. Keys not put again keep their row. A
    null key fails the put. The number of buckets is set when the table is made, `buckets` or by the size of the first
    rows, and stays. `bucket` cannot be a column of the rows.

    A put computes `rows` once, shuffles them once, in tasks of about `TASK_BYTES` of input however large a bucket's
    share is, merges the buckets they fall into with the table's, and writes these to a folder of its own. Then it points the names of these buckets there, one by one. Readers of the files
    before may finish: a bucket's files stay until its next put but one.

    Several puts may run at a time. Before it moves names, a put asks whether its buckets still lie where it
    read them; if another put was faster, it merges again with what that left. Only one moves names at a time, which an
    exclusively made file in the table's folder ensures.
    """
    spark = rows.sparkSession
    columns = columns or rows.columns
    if BUCKET in columns:
        raise ValueError(f"{BUCKET} is the name of the partition column")
    exists = spark.catalog.tableExists(table)
    number = layout(spark, table)[1] if exists else buckets or bucket_count(rows)
    home = qualified(spark, location)
    if exists and home_of(spark, table) != home:
        raise ValueError(f"{table} does not lie at {location}")
    own = f"{home}/{new_folder()}"
    with staged(spark, table) as put:
        # A multiple of the buckets: a task's keys still fall into one bucket.
        with session_settings(spark, put_settings(spark, number * put_parts(rows, number))):
            latest = latest_per_key(with_keys(rows, key), key, order_by, columns)
            write_buckets(latest, number, key, put if exists else table, own)
        if not exists:
            return keyed_rows(spark, table)
        with session_settings(spark, {"spark.sql.shuffle.partitions": str(number)}):
            replace_buckets(spark, table, put, key, number, home)
    remove_folder(spark, own)
    spark.catalog.refreshTable(table)
    return keyed_rows(spark, table)


def replace_buckets(spark: SparkSession, table: str, put: str, key: str, number: int, home: str) -> None:
    """Merge a put, itself in buckets, into the buckets of the table it touches."""
    hit = sorted(int(row.partition.partition("=")[2]) for row in spark.sql(f"SHOW PARTITIONS {put}").collect())
    for _ in range(TRIES if hit else 0):
        spark.catalog.refreshTable(table)
        before, folder = locations(spark, table, hit), new_folder()
        kept = spark.table(table).where(F.col(BUCKET).isin(hit)).drop(BUCKET)
        with staged(spark, table) as result:
            latest = spark.table(put).select(*kept.columns)
            write_buckets(merged(kept, latest, key), number, key, result, f"{home}/{folder}")
        with only_one_switches(spark, home):
            if locations(spark, table, hit) == before:
                switch(spark, table, hit, before, folder, home)
                return
        remove_folder(spark, f"{home}/{folder}")
    if hit:
        raise Conflict(f"other puts changed {table} {TRIES} times")


def switch(spark: SparkSession, table: str, hit: list[int], before: dict[int, str], folder: str, home: str) -> None:
    """Point buckets to a put's folder, and remove what they had before the put before."""
    told = properties(spark, table)
    for bucket in hit:
        partition, place = f"PARTITION ({BUCKET} = {bucket})", f"LOCATION '{home}/{folder}/{BUCKET}={bucket}'"
        action = f"{partition} SET {place}" if bucket in before else f"ADD {partition} {place}"
        spark.sql(f"ALTER TABLE {table} {action}")
    listed = ", ".join(f"'{PREVIOUS}{bucket}' = '{name}'" for bucket, name in before.items())
    if listed:
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({listed})")
    for bucket in hit:
        remove_superseded(spark, home, told.get(f"{PREVIOUS}{bucket}"), bucket)


def remove_superseded(spark: SparkSession, home: str, folder: str | None, bucket: int) -> None:
    """Remove a bucket from a put's folder under the table's home, and the folder with its last bucket."""
    if folder and PUT_FOLDER.fullmatch(folder):
        remove_folder(spark, f"{home}/{folder}/{BUCKET}={bucket}")
        if folder_is_empty(spark, f"{home}/{folder}", besides=r"[_.].*"):
            remove_folder(spark, f"{home}/{folder}")


@contextmanager
def only_one_switches(spark: SparkSession, home: str) -> Iterator[None]:
    """Hold the file that says that a put moves names. Threads of one driver take turns before they try."""
    path = f"{home}/{SWITCHING}"
    with TURN:
        until = time.monotonic() + WAIT_SECONDS
        while not claim_file(spark, path):
            if time.monotonic() > until:
                raise Conflict(f"{path} stays: another put moves names, or ended while it did; remove it in that case")
            time.sleep(0.05)
        try:
            yield
        finally:
            remove_folder(spark, path)
