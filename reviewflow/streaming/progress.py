"""What the batches of streams did, told by Spark's progress events."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from reviewflow.sources.rows import rows_to_table

PROGRESS = "batch_id BIGINT, input_rows BIGINT"

# Events are delivered after the fact; the end of a query comes behind its progress.
WAIT_SECONDS = 60


class Progress(StreamingQueryListener):
    """Keeps batch id, input rows and observed metrics of every batch with input, one small entry a batch."""

    def __init__(self):
        self.batches: dict[tuple[str, int], tuple[int, dict]] = {}
        self.ended: set[str] = set()
        self.changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        told = event.progress
        with self.changed:
            if told.numInputRows:
                self.batches[str(told.id), told.batchId] = told.numInputRows, dict(told.observedMetrics)

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def of(self, query: StreamingQuery) -> dict[int, tuple[int, dict]]:
        """The batches of a stream that has ended, by their id."""
        with self.changed:
            if not self.changed.wait_for(lambda: str(query.runId) in self.ended, WAIT_SECONDS):
                raise TimeoutError(f"no event told the end of {query.runId}")
            return {batch: told for (stream, batch), told in self.batches.items() if stream == str(query.id)}

    def table(self, spark: SparkSession, query: StreamingQuery) -> DataFrame:
        """batch_id and input_rows of a stream that has ended."""
        rows = [(batch, told[0]) for batch, told in sorted(self.of(query).items())]
        return rows_to_table(spark, rows, PROGRESS)

    def observed(self, query: StreamingQuery, name: str, field: str) -> int:
        """The sum of an observed count over the batches of a stream that has ended."""
        return sum(told[name][field] for _, told in self.of(query).values() if name in told)


@contextmanager
def watched(spark: SparkSession) -> Iterator[Progress]:
    """Listen to the session's streams for the duration of a block."""
    progress = Progress()
    spark.streams.addListener(progress)
    try:
        yield progress
    finally:
        spark.streams.removeListener(progress)
