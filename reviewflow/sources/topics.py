"""Topics: a Kafka topic, or a folder of parquet files with keyed records.

Both kinds offer `read` (the records there are now), `stream` and `publish`. A publisher gives
columns `value` and, if records are keyed, `key`. Where a record lies is told by partition and offset
in Kafka, and by file and row in a folder.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewflow.schemas import FILE_RECORD
from reviewflow.session import MOST_FILES_PER_BATCH, file_count

METADATA_FIELDS = ["topic", "partition", "offset", "timestamp"]
FILE_METADATA_FIELDS = ["topic", "file", "row", "timestamp"]


@dataclass(frozen=True)
class Connection:
    """Where the brokers are and who connects. Without a user name the connection is plain."""

    servers: str
    username: str | None = None
    password: str | None = field(default=None, repr=False)
    truststore: str | None = None

    @classmethod
    def from_environment(
        cls,
        prefix: str,
        environment: Mapping[str, str] = os.environ,
        truststore: str | None = None,
    ) -> Connection:
        """Read `<prefix>BOOTSTRAP`, `<prefix>USERNAME` and `<prefix>PASSWORD`; all are required."""
        names = [prefix + part for part in ("BOOTSTRAP", "USERNAME", "PASSWORD")]
        missing = [name for name in names if not environment.get(name)]
        if missing:
            raise KeyError(f"not set: {', '.join(missing)}")
        return cls(*(environment[name] for name in names), truststore=truststore)

    def options(self) -> dict[str, str]:
        """Options that the Kafka source and sink share."""
        options = {"kafka.bootstrap.servers": self.servers}
        if self.username is None:
            return options
        # Fixed values of the authenticated protocol.
        options["kafka.security.protocol"] = "SASL_SSL"
        options["kafka.sasl.mechanism"] = "SCRAM-SHA-512"
        options["kafka.sasl.jaas.config"] = jaas_line(self.username, self.password or "")
        if self.truststore:
            options["kafka.ssl.truststore.location"] = self.truststore
        return options


def jaas_line(username: str, password: str) -> str:
    """The login line of a SCRAM client. It holds the password: pass it on, never log it."""

    def quoted(text: str) -> str:
        return '"' + text.replace("\\", "\\\\").replace('"', '\\"') + '"'

    module = "org.apache.kafka.common.security.scram.ScramLoginModule"
    return f"{module} required username={quoted(username)} password={quoted(password)};"


@dataclass(frozen=True)
class KafkaTopic:
    name: str
    connection: Connection

    def source_options(self, max_per_trigger: int | None = None) -> dict[str, str]:
        options = {
            **self.connection.options(),
            "subscribe": self.name,
            "startingOffsets": "earliest",
        }
        if max_per_trigger:
            options["maxOffsetsPerTrigger"] = str(max_per_trigger)
        return options

    def drain_options(self) -> dict[str, str]:
        return {**self.source_options(), "endingOffsets": "latest"}

    def sink_options(self) -> dict[str, str]:
        return {**self.connection.options(), "kafka.acks": "1", "topic": self.name}

    def read(self, spark: SparkSession) -> DataFrame:
        return decoded(spark.read.format("kafka").options(**self.drain_options()).load())

    def stream(self, spark: SparkSession, max_per_trigger: int | None = None) -> DataFrame:
        options = self.source_options(max_per_trigger)
        return decoded(spark.readStream.format("kafka").options(**options).load())

    def publish(self, records: DataFrame) -> None:
        keyed_records(records).write.format("kafka").options(**self.sink_options()).save()


@dataclass(frozen=True)
class FileTopic:
    """A topic kept as files, for work without a broker. The rate cap counts files."""

    name: str
    path: str

    def read(self, spark: SparkSession) -> DataFrame:
        return positioned(self._source(spark.read))

    def stream(self, spark: SparkSession, max_per_trigger: int | None = None) -> DataFrame:
        cap = max_per_trigger or MOST_FILES_PER_BATCH
        return positioned(self._source(spark.readStream.option("maxFilesPerTrigger", cap)))

    def _source(self, reader) -> DataFrame:
        return reader.schema(FILE_RECORD).option("recursiveFileLookup", "true").parquet(self.path)

    def files_per_batch(self, spark: SparkSession, batches: int) -> int:
        """A rate cap that reads the topic in about that many micro-batches, or more if it is big."""
        return max(1, min(MOST_FILES_PER_BATCH, -(-file_count(spark, self.path) // batches)))

    def publish(self, records: DataFrame) -> None:
        """Add records. Each publication has a folder of its own, so several may run at a time."""
        rows = keyed_records(records).select("key", "value", F.lit(self.name).alias("topic"))
        rows.write.parquet(f"{self.path}/{uuid.uuid4().hex}")


def positioned(records: DataFrame) -> DataFrame:
    """Records of a folder with the file and row where each lies, and when its file was written."""
    return records.select(
        "key",
        "value",
        "topic",
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.row_index").alias("row"),
        F.col("_metadata.file_modification_time").alias("timestamp"),
    )


def keyed_records(records: DataFrame) -> DataFrame:
    """Columns `key` and `value` as strings; the key is null where the publisher gives none."""
    key = F.col("key") if "key" in records.columns else F.lit(None)
    return records.select(key.cast("string").alias("key"), F.col("value").cast("string"))


def decoded(records: DataFrame) -> DataFrame:
    """Key and value of a broker's records as strings, beside the record's metadata."""
    return records.select(
        F.col("key").cast("string"), F.col("value").cast("string"), *METADATA_FIELDS
    )


def values(records: DataFrame) -> DataFrame:
    """Only the record values, as strings."""
    return records.select(F.col("value").cast("string"))


def record_metadata(records: DataFrame) -> DataFrame:
    """Where each value lies: topic, partition, offset, timestamp, or file and row in a folder."""
    fields = METADATA_FIELDS if "offset" in records.columns else FILE_METADATA_FIELDS
    return records.select(*fields, F.col("value").cast("string"))
