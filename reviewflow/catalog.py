"""Named tables: databases, external tables, SQL over them, statistics."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reviewflow.functions.text import NOT_LETTER_OR_BLANK
from reviewflow.schemas import STORED_REVIEW, ddl
from reviewflow.session import folder_bytes, path_exists, same_path
from reviewflow.sources.rows import rows_to_table

# Table properties with what was counted while a table was loaded.
COUNTED_ROWS = "reviewflow.rows"
COUNTED_BYTES = "reviewflow.bytes"
STATS = "table_name STRING, size_bytes BIGINT, row_count BIGINT"

WORD_COUNT_SQL = Path(__file__).parent / "plans" / "word_count.sql"


def create_database(spark: SparkSession, name: str, location: str) -> None:
    """Make a database at a location; one of that name somewhere else is an error."""
    if spark.catalog.databaseExists(name):
        held = spark.catalog.getDatabase(name).locationUri
        if not same_path(spark, held, location):
            raise ValueError(f"database {name} exists at {held}")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{location}'")


def create_external_table(
    spark: SparkSession, table: str, location: str, schema: StructType = STORED_REVIEW
) -> DataFrame:
    """Name the parquet files at a location; dropping the table leaves them there.

    An external table of that name is replaced. A managed one, whose files would go, is an error.
    """
    if spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType != "EXTERNAL":
        raise ValueError(f"{table} exists and is not external")
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} ({ddl(schema)}) USING PARQUET LOCATION '{location}'")
    return spark.table(table)


def read_external_table(spark: SparkSession, table: str) -> DataFrame:
    """The table with the files that lie at its location now."""
    spark.catalog.refreshTable(table)
    return spark.table(table)


def run_sql_file(spark: SparkSession, path: str | Path, **arguments) -> DataFrame:
    """Run the one statement in a local text file against the session's tables and views.

    Arguments fill the statement's named parameters.
    """
    return spark.sql(Path(path).read_text(), args=arguments)


def word_count_sql(lines: DataFrame) -> DataFrame:
    """The word count as SQL over a view named book."""
    lines.createOrReplaceTempView("book")
    return run_sql_file(lines.sparkSession, WORD_COUNT_SQL, dropped=NOT_LETTER_OR_BLANK)


def query_to_location(spark: SparkSession, sql: str, location: str) -> DataFrame:
    """Run a query, keep its result as parquet at a location, and read it from there."""
    spark.sql(sql).write.parquet(location)
    return spark.read.parquet(location)


def create_batch_table(spark: SparkSession, table: str, location: str, schema: StructType) -> DataFrame:
    """An external table over folders `batch_id=N` at a location, with `batch_id` as its partition.

    Folders that are there already become partitions at once; later ones by `add_batch`.
    """
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    columns = f"{ddl(schema)}, batch_id BIGINT"
    spark.sql(f"CREATE TABLE {table} ({columns}) USING PARQUET PARTITIONED BY (batch_id) LOCATION '{location}'")
    if path_exists(spark, location):
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    return spark.table(table)


def add_batch(spark: SparkSession, table: str, location: str, batch_id: int) -> None:
    """Make a batch's folder a partition; once is enough, and again does no harm."""
    place = f"PARTITION (batch_id = {batch_id}) LOCATION '{location.rstrip('/')}/batch_id={batch_id}'"
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {place}")
    spark.catalog.refreshTable(table)


def record_stats(spark: SparkSession, table: str, location: str, rows: int) -> None:
    """Keep the rows that were counted while a table's files were written, beside the bytes of these files."""
    listed = {COUNTED_ROWS: rows, COUNTED_BYTES: folder_bytes(spark, location)}
    told = ", ".join(f"'{name}' = '{value}'" for name, value in listed.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({told})")


def table_stats(spark: SparkSession, table: str) -> DataFrame:
    """Size in bytes and rows of a table: as recorded when it was loaded, if its files still have that size, which
    takes a listing; else taken anew by a scan."""
    name = table.rpartition(".")[2]
    told = {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    if COUNTED_ROWS in told:
        place = next(row.data_type for row in spark.sql(f"DESCRIBE EXTENDED {table}").collect() if row.col_name == "Location")
        size = folder_bytes(spark, place)
        if str(size) == told[COUNTED_BYTES]:
            return rows_to_table(spark, [(name, size, int(told[COUNTED_ROWS]))], STATS)
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")
    described = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Statistics'")
    return described.select(
        F.lit(name).alias("table_name"),
        F.regexp_extract("data_type", r"(\d+) bytes", 1).cast("long").alias("size_bytes"),
        F.regexp_extract("data_type", r"(\d+) rows", 1).cast("long").alias("row_count"),
    )


def table_columns(spark: SparkSession, table: str) -> DataFrame:
    """Column names and types."""
    return spark.sql(f"DESCRIBE TABLE {table}").select("col_name", "data_type")
