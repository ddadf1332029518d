"""Tables from values at hand."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def rows_to_table(
    spark: SparkSession, rows: Iterable[tuple], schema: StructType | list[str] | str
) -> DataFrame:
    """A table of literal rows. They pass through the driver: for short lists only."""
    return spark.createDataFrame(list(rows), schema)


def record_ids(spark: SparkSession, count: int) -> DataFrame:
    """Ids 1 to count, both included, and each as the string key of a record."""
    ids = spark.range(1, count + 1)
    return ids.select("id", ids.id.cast("string").alias("key"))
