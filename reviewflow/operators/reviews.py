"""Parsing and averaging of reviews. Input is a table or stream with the record in `value`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from reviewflow.schemas import REVIEW, REVIEW_STRINGS, ddl

# The column that holds the text of a malformed record.
MALFORMED = "malformed"


def parse_json(records: DataFrame, schema: StructType) -> DataFrame:
    """JSON records to columns. A malformed record stays as a row of nulls, a malformed field as a
    null. Only the fields that are used later are parsed."""
    return records.select(F.from_json("value", schema).alias("raw")).select("raw.*")


def checked_json(records: DataFrame, schema: StructType) -> DataFrame:
    """JSON records to columns, and `malformed`: the text of a record that is not one JSON object of the schema's types,
    empty for a missing record, else null. A record parses once, whichever columns are used."""
    checked = StructType([*schema.fields, StructField(MALFORMED, StringType())])
    parsed = F.from_json("value", checked, {"columnNameOfCorruptRecord": MALFORMED})
    # Opened by a generator, which keeps later filters from parsing again.
    rows = records.select("value", F.inline(F.array(F.struct(parsed.alias("raw")))))
    told = F.when(F.col("raw").isNull(), F.coalesce("value", F.lit(""))).otherwise(F.col("raw")[MALFORMED])
    return rows.select(*(F.col("raw")[name].alias(name) for name in schema.names), told.alias(MALFORMED))


def good_records(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(MALFORMED).isNull()).drop(MALFORMED)


def malformed_records(parsed: DataFrame) -> DataFrame:
    """The text of the malformed records, as `value`."""
    return parsed.where(F.col(MALFORMED).isNotNull()).select(F.col(MALFORMED).alias("value"))


def parse_tsv(records: DataFrame, schema: StructType, quote: str = '"') -> DataFrame:
    """Tab-separated records to columns. Short records end in nulls, surplus fields are dropped.

    With quoting on, a lone quote at the start of a field takes in the tabs after it; `quote=""`
    reads such data field by field.

    The struct is opened by a generator. A filter on a parsed column, such as the one a join adds on
    its key, then runs on the result; below a plain projection it would parse every record again.
    """
    options = {"delimiter": "\t", "quote": quote}
    return records.select(F.inline(F.array(F.from_csv("value", ddl(schema), options))))


def parse_review_json(records: DataFrame) -> DataFrame:
    return parse_json(records, REVIEW)


def parse_review_tsv(records: DataFrame, quote: str = '"') -> DataFrame:
    return parse_tsv(records, REVIEW_STRINGS, quote)


def with_processing_time(rows: DataFrame) -> DataFrame:
    """Add `current_tsp`, one value per run or micro-batch."""
    return rows.withColumn("current_tsp", F.current_timestamp())


def average_rating(reviews: DataFrame) -> DataFrame:
    """One row: the mean star rating to two decimals, missing ratings left out."""
    return reviews.agg(F.round(F.avg("star_rating"), 2).alias("avg_star_rating"))
