"""Streaming sinks. Each starts a query with a checkpoint, so a restart goes on where it stopped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from reviewflow.session import STATE_STORE, path_exists, session_settings

# Triggers: all there is and then stop, every ten seconds, or as soon as the last batch is done.
ALL_AVAILABLE = {"availableNow": True}
EVERY_TEN_SECONDS = {"processingTime": "10 seconds"}
AT_ONCE: dict = {}


def _started(writer: DataStreamWriter, checkpoint: str, trigger: dict) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def wait(query: StreamingQuery, seconds: int | None = None) -> StreamingQuery:
    """Block until the stream ends, or for some seconds. A failed stream raises its error here."""
    if seconds is None:
        query.awaitTermination()
    else:
        query.awaitTermination(seconds)
    return query


def append_parquet(
    rows: DataFrame, path: str, checkpoint: str, trigger: dict = ALL_AVAILABLE
) -> StreamingQuery:
    """Add the rows of a stateless stream to parquet files; each batch is committed once."""
    writer = rows.writeStream.format("parquet").option("path", path).outputMode("append")
    return _started(writer, checkpoint, trigger)


def each_batch(
    rows: DataFrame,
    work: Callable[[DataFrame, int], None],
    checkpoint: str,
    output_mode: str = "append",
    trigger: dict = ALL_AVAILABLE,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Call a function with each micro-batch, as a bounded table, and its id.

    A batch may be handed over again after a failure: `work` must give the same result twice.
    `state_partitions` is the number of parts of a stateful stream's state. It holds for the life of
    the checkpoint, so it is chosen for the state to come; without it, the session's shuffle
    partitions at the first start are taken.
    """
    settings = dict(STATE_STORE)
    if state_partitions:
        settings["spark.sql.shuffle.partitions"] = str(state_partitions)
    with session_settings(rows.sparkSession, settings):
        writer = rows.writeStream.outputMode(output_mode).foreachBatch(work)
        return _started(writer, checkpoint, trigger)


def batch_table(path: str, transform: Callable[[DataFrame], DataFrame]) -> Callable:
    """Micro-batch work: write the transformed batch to its own folder, replacing what a failed try
    left there."""

    def write(batch: DataFrame, batch_id: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def snapshot_table(path: str) -> Callable:
    """Micro-batch work for complete mode: keep the whole result, which supersedes the last one.

    Two folders take turns, so the last whole snapshot can be read while the next is written.
    """

    def write(snapshot: DataFrame, batch_id: int) -> None:
        stamped = snapshot.withColumn("batch_id", F.lit(batch_id).cast("long"))
        stamped.write.mode("overwrite").parquet(f"{path}/slot={batch_id % 2}")

    return write


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest whole snapshot. A slot whose write was cut off has no success marker."""
    slots = [f"{path}/slot={slot}" for slot in (0, 1)]
    whole = [slot for slot in slots if path_exists(spark, f"{slot}/_SUCCESS")]
    snapshots = spark.read.parquet(*whole)
    newest = snapshots.agg(F.max("batch_id")).first()[0]
    # Without rows there is no batch id, and nothing to choose.
    chosen = snapshots if newest is None else snapshots.where(F.col("batch_id") == newest)
    return chosen.drop("batch_id")


def show_batch(order_by: list, n: int = 20) -> Callable:
    """Micro-batch work: print the first n rows. Only they reach the driver, whereas the console
    sink would bring all of them."""

    def show(batch: DataFrame, batch_id: int) -> None:
        print(f"Batch: {batch_id}")
        batch.orderBy(*order_by).limit(n).show(n, truncate=False)

    return show
