"""Session settings, the shared work folder, and the width of small inputs."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

# Timestamps without an offset are read in the session time zone, so it is pinned. The skew settings
# let one hot join key be split over several tasks.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# A running count keeps one state row per key for ever: hold it on local disk, not on the heap, and
# ship changes instead of whole snapshots with every micro-batch.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Inputs up to this size come from one or two scan splits; moving them over all cores is cheap.
SMALL_INPUT_BYTES = 256 * 1024 * 1024

# Input per shuffle partition. Shuffles carry selected columns and partial sums, so a partition ends
# up smaller. The upper bound keeps the number of shuffle blocks, tasks times partitions, in hand.
SHUFFLE_INPUT_BYTES = 512 * 1024 * 1024
MOST_SHUFFLE_PARTITIONS = 25_000

# Files a stream takes up in one micro-batch unless its rate cap says otherwise (`--max-per-trigger` of
# the jobs): about a terabyte of full-size files, so that a lost batch is not the whole backlog.
MOST_FILES_PER_BATCH = 10_000


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with this package's settings; `settings` are added on top."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **STATE_STORE, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


@contextmanager
def session_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Apply settings for the duration of a block. A streaming query keeps those it started with."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder path that every executor can reach, under `spark.checkpoint.dir`.

    Only a local session may go without that setting; it then uses the warehouse folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
        root = spark.conf.get("spark.sql.warehouse.dir", "spark-warehouse")
    return f"{root.rstrip('/')}/reviewflow/{purpose}-{uuid.uuid4().hex}"


def source_bytes(df: DataFrame) -> int:
    """Bytes of the tables a plan reads, by their file listings; nothing is run.

    A source of unknown size counts as very large.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def widen(rows: DataFrame) -> DataFrame:
    """Spread a small bounded input evenly over all cores.

    A small table is often one file with one row group, which is one task. Larger inputs already
    arrive in many splits and are returned as they are, so nothing big is shuffled. Streams, whose
    size changes from batch to batch, are never widened.
    """
    if source_bytes(rows) > SMALL_INPUT_BYTES:
        return rows
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism)


@contextmanager
def sized_shuffles(table: DataFrame) -> Iterator[None]:
    """Within a block, raise the shuffle partitions to the size of a table that is shuffled there.

    They are never lowered: adaptive execution merges those that stay small.
    """
    spark = table.sparkSession
    wanted = min(MOST_SHUFFLE_PARTITIONS, source_bytes(table) // SHUFFLE_INPUT_BYTES)
    partitions = max(wanted, int(spark.conf.get("spark.sql.shuffle.partitions")))
    with session_settings(spark, {"spark.sql.shuffle.partitions": str(partitions)}):
        yield


def hadoop_path(spark: SparkSession, path: str):
    """The file system and path object of a location, on whatever storage it lies."""
    java_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return java_path.getFileSystem(spark._jsc.hadoopConfiguration()), java_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, java_path = hadoop_path(spark, path)
    return fs.exists(java_path)


def qualified(spark: SparkSession, path: str) -> str:
    """A location with the scheme and authority of its file system."""
    fs, java_path = hadoop_path(spark, path)
    return fs.makeQualified(java_path).toString()


def same_path(spark: SparkSession, one: str, other: str) -> bool:
    """Two spellings of one location."""
    return qualified(spark, one) == qualified(spark, other)


def claim_file(spark: SparkSession, path: str) -> bool:
    """Make an empty file; false if it is there already. On storage that makes files atomically, one of several
    sessions that try at once succeeds."""
    fs, java_path = hadoop_path(spark, path)
    try:
        fs.create(java_path, False).close()
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    return True


def folder_is_empty(spark: SparkSession, path: str, besides: str) -> bool:
    """Whether a folder holds nothing but names that match a pattern."""
    fs, java_path = hadoop_path(spark, path)
    names = [status.getPath().getName() for status in fs.listStatus(java_path)] if fs.exists(java_path) else []
    return all(re.fullmatch(besides, name) for name in names)


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, java_path = hadoop_path(spark, path)
    fs.delete(java_path, True)


def file_count(spark: SparkSession, path: str) -> int:
    fs, java_path = hadoop_path(spark, path)
    return fs.getContentSummary(java_path).getFileCount()


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the data files of a folder; names that begin with `_` or `.` are none."""
    fs, java_path = hadoop_path(spark, path)
    total, walk = 0, fs.listFiles(java_path, True)
    while walk.hasNext():
        status = walk.next()
        if not re.match(r"[_.]", status.getPath().getName()):
            total += status.getLen()
    return total
