"""Lines and records on their way into a topic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewflow.functions.records import csv_record
from reviewflow.functions.text import has_text


def without_blank_lines(lines: DataFrame) -> DataFrame:
    """Lines with something on them, kept untrimmed."""
    return lines.where(has_text("value"))


def without_line(lines: DataFrame, header: str) -> DataFrame:
    """All lines but those equal to a known header."""
    return lines.where(F.col("value") != header)


def csv_records(rows: DataFrame, key: Column, *fields: Column) -> DataFrame:
    """Keyed records: `key` and the CSV `value` that starts with it."""
    return rows.select(
        key.cast("string").alias("key"), csv_record(key, *fields).alias("value")
    )
