"""Tables from files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reviewflow.schemas import CUSTOMER_FIELDS
from reviewflow.session import MOST_FILES_PER_BATCH, hadoop_path

FILE_ORDER = ["file", "block_start", "line_id"]


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column `value`."""
    return spark.read.text(path)


def read_text_after_first_line(spark: SparkSession, path: str) -> DataFrame:
    """Lines of each file but its first, whatever that line holds.

    A file's first line is the first row of the scan partition that holds the file's start. Row ids
    ascend within a scan partition and differ over the scan, so it is the lowest id per file, found
    with one small aggregate over a scan that decodes no text. Both scans list the same files under
    the same settings and so cut them alike. One number per file is broadcast, less than the listing
    of the files that the driver holds for any scan; no text is shuffled. If the header is known,
    `records.without_line` needs a single scan.
    """
    lines = with_file_order(spark.read.text(path))
    starts = lines.where("block_start = 0").groupBy("file").agg(F.min("line_id").alias("line_id"))
    return lines.join(F.broadcast(starts.select("line_id")), "line_id", "left_anti").select("value")


def read_tsv(
    spark: SparkSession, path: str, schema: StructType | None = None, quote: str = '"'
) -> DataFrame:
    """Tab-separated files with a header line; every column is a STRING unless a schema says else."""
    reader = spark.read.option("sep", "\t").option("header", "true").option("quote", quote)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_customers(spark: SparkSession, path: str) -> DataFrame:
    """Customer files, columns bound by the names in the header; all are STRING.

    A file without one of the columns fails with its name, as does one whose header differs from
    that of the others.
    """
    reader = spark.read.option("sep", "\t").option("header", "true").option("enforceSchema", "false")
    return reader.csv(path).select(*CUSTOMER_FIELDS)


def with_file_order(rows: DataFrame) -> DataFrame:
    """Add FILE_ORDER, columns that sort the rows of a file scan as the files have them.

    Row ids ascend within a block of a file, but not from block to block.
    """
    return rows.select(
        "*",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("line_id"),
    )


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stream_table(
    spark: SparkSession, folder: str, name: str, max_files_per_trigger: int = MOST_FILES_PER_BATCH
) -> DataFrame:
    """A parquet table as a stream, be it one file or a folder of files.

    A file stream lists folders only, so a single file is picked out of its folder by name.
    """
    path = f"{folder}/{name}.parquet"
    reader = spark.readStream.schema(read_table(spark, folder, name).schema)
    reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    fs, java_path = hadoop_path(spark, path)
    if fs.getFileStatus(java_path).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def stream_text(spark: SparkSession, path: str, max_files_per_trigger: int) -> DataFrame:
    """Lines of the text files of a folder as a stream, column `value`."""
    return spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger).text(path)
