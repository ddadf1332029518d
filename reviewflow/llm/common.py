"""What the operators share: table access, small text helpers, work tables in the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewflow.session import remove_folder, shared_folder, source_bytes

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

# Rows of an Arrow batch that are looked at together; batches themselves are cut by Spark.
SLICE_ROWS = 512

# Rows that Spark hands to Python at a time, and how many these are if nobody says.
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
SPARKS_BATCH_ROWS = "10000"

# Rows that Spark reads from Parquet at a time, and how many these are if nobody says.
READER_ROWS = "spark.sql.parquet.columnarReaderBatchSize"
SPARKS_READER_ROWS = "4096"

# Tables up to this size are dealt over all cores where the work on a row is long.
SMALL_BYTES = 16 << 20


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else, as `bytes.lower` has it."""
    return F.translate(text, UPPER, LOWER)


def small_batches(spark: SparkSession) -> None:
    """Let Spark hand few texts at a time to Python, unless the session says how many.

    At Spark's own ten thousand rows a batch of texts takes tens of megabytes in the JVM, in Arrow and in Python, for
    each task. The setting is the session's, since a plan is made when its caller runs it.
    """
    if spark.conf.get(BATCH_ROWS) == SPARKS_BATCH_ROWS:
        spark.conf.set(BATCH_ROWS, str(SLICE_ROWS))


def small_reads(spark: SparkSession) -> None:
    """Let Spark read few texts at a time, unless the session says how many.

    At Spark's own four thousand rows the vectors of a column of texts are arrays of many megabytes in each task, for
    which the JVM grows its heap. As with `small_batches`, the setting is the session's.
    """
    if spark.conf.get(READER_ROWS) == SPARKS_READER_ROWS:
        spark.conf.set(READER_ROWS, str(SLICE_ROWS))


def documents(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns only, so that further columns of any name cannot clash with results."""
    small_batches(docs.sparkSession)
    return docs.select(*(F.col(f"`{name}`") for name in columns))


def over_all_cores(rows: DataFrame) -> DataFrame:
    """A table of a few megabytes, often one row group and so one task, dealt over all cores; larger ones as they are."""
    if source_bytes(rows) > SMALL_BYTES:
        return rows
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism)


def held_out() -> Column:
    """True for the fold that no label is learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def stored(rows: DataFrame, purpose: str) -> DataFrame:
    """Write rows to the shared folder and read them again: cuts the lineage, survives executors."""
    path = shared_folder(rows.sparkSession, purpose)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


@contextmanager
def stored_for(rows: DataFrame, purpose: str) -> Iterator[DataFrame]:
    """Rows `stored` for a block of code; their folder goes with the block, so whatever outlives it must be written too."""
    path = shared_folder(rows.sparkSession, purpose)
    rows.write.parquet(path)
    try:
        yield rows.sparkSession.read.schema(rows.schema).parquet(path)
    finally:
        remove_folder(rows.sparkSession, path)


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Arrow batches in small cuts, so that Python objects of few texts live at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def utf8(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes; a null is empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def per_batch(
    work: Callable[[pa.RecordBatch], pa.RecordBatch | None],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function of one cut as a function for `mapInArrow`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            out = work(part)
            if out is not None and out.num_rows:
                yield out

    return run
