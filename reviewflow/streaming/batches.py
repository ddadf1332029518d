"""Micro-batch work that looks at a batch more than once or keeps a table by key."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from reviewflow import catalog, keyed_tables
from reviewflow.operators import customers as people
from reviewflow.operators import reviews, words

Work = Callable[[DataFrame, int], None]


@contextmanager
def held(batch: DataFrame) -> Iterator[DataFrame]:
    """A batch that is read from its source once, however often it is used. What a lost executor held is read again."""
    batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield batch
    finally:
        batch.unpersist()


def put_batches(table: str, key: str, location: str, buckets: int) -> Work:
    """Put the rows of a batch, one per key, into a keyed table; a batch that runs again puts the same rows.

    With a running count in update mode a batch holds the words it changed, and only their buckets are rewritten.
    """

    def work(batch: DataFrame, _: int) -> None:
        keyed_tables.put_rows(table, batch, key, [], location, buckets=buckets)

    return work


def sketch_batches(path: str, tracked: int = words.TRACKED) -> Work:
    """Write the sketch of a batch of lines, one small row, to its own folder; a batch that runs again replaces it."""

    def work(batch: DataFrame, batch_id: int) -> None:
        words.sketch_words(batch, tracked).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return work


def enrich_batches(customer_table: str, path: str, table: str | None = None) -> Work:
    """Enrich a batch of reviews from a customer table and write it to its own folder, replacing what a failed try
    left there. Of a keyed table only the buckets of the batch's customers are read. `table` gets the folder as a
    partition."""

    def work(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with held(batch):
            keyed = keyed_tables.is_keyed(spark, customer_table)
            near = keyed_tables.rows_near(spark, customer_table, batch) if keyed else spark.table(customer_table)
            people.enrich(batch, near).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        if table:
            catalog.add_batch(spark, table, path, batch_id)

    return work


def split_batches(good: str, bad: str) -> Work:
    """Write the good records of a batch to one table and the text of the malformed ones to another.

    Both folders of the batch are replaced, so a batch that failed between them can run again.
    """

    def work(batch: DataFrame, batch_id: int) -> None:
        with held(batch):
            reviews.good_records(batch).write.mode("overwrite").parquet(f"{good}/batch_id={batch_id}")
            reviews.malformed_records(batch).write.mode("overwrite").parquet(f"{bad}/batch_id={batch_id}")

    return work
