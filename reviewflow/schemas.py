"""Record schemas. Field names and types are fixed values: stored data and topics carry them."""

from __future__ import annotations

from pyspark.sql.types import (
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# A review as JSON carries types; all fields may be missing.
REVIEW_TYPES = {
    "marketplace": StringType(),
    "customer_id": LongType(),
    "review_id": StringType(),
    "product_id": StringType(),
    "product_parent": IntegerType(),
    "product_title": StringType(),
    "product_category": StringType(),
    "star_rating": IntegerType(),
    "helpful_votes": IntegerType(),
    "total_votes": IntegerType(),
    "vine": StringType(),
    "verified_purchase": StringType(),
    "review_headline": StringType(),
    "review_body": StringType(),
    "review_date": TimestampType(),
}
REVIEW_FIELDS = list(REVIEW_TYPES)
CUSTOMER_FIELDS = ["customer_id", "username", "name", "sex", "email", "birthdate"]

# What a lookup of customers gives back, and what an enriched review holds.
CUSTOMER_LOOKUP_FIELDS = ["customer_id", "username", "name", "email", "birthdate"]
ENRICHED_FIELDS = ["customer_id", "review_id", "product_title", "username", "name"]


def all_strings(names: list[str]) -> StructType:
    """Nullable STRING columns. Nothing is inferred, so keys keep their leading zeros."""
    return StructType([StructField(name, StringType()) for name in names])


REVIEW = StructType([StructField(name, kind) for name, kind in REVIEW_TYPES.items()])
REVIEW_STRINGS = all_strings(REVIEW_FIELDS)
CUSTOMER = all_strings(CUSTOMER_FIELDS)
STORED_REVIEW = StructType([*REVIEW.fields, StructField("current_tsp", TimestampType())])

# One record of a topic, with the columns a Kafka source gives.
TOPIC_RECORD = StructType(
    [
        StructField("key", StringType()),
        StructField("value", StringType()),
        StructField("topic", StringType()),
        StructField("partition", IntegerType()),
        StructField("offset", LongType()),
        StructField("timestamp", TimestampType()),
    ]
)

# One record of a topic that is kept as files.
FILE_RECORD = all_strings(["key", "value", "topic"])


def ddl(schema: StructType) -> str:
    """Column list for CREATE TABLE and for parsers that take a DDL string."""
    return ", ".join(f"{field.name} {field.dataType.simpleString().upper()}" for field in schema.fields)

ENRICHED = StructType([StructField(name, StringType()) for name in ENRICHED_FIELDS])
