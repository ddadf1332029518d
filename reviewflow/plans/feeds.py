"""Reviews, customers and records told from the star-schema tables, as input for the queries.

An order stands for a review, its customer for the reviewer. All are plain projections.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewflow.functions.records import tsv_record
from reviewflow.operators.words import split_lines
from reviewflow.schemas import REVIEW_FIELDS
from reviewflow.session import widen
from reviewflow.sources.files import read_table

# Review dates are written with this zone, six hours behind UTC.
DATE_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'-06:00'"


def document_lines(spark: SparkSession, folder: str) -> DataFrame:
    """All lines of all documents."""
    return split_lines(widen(read_table(spark, folder, "documents").select("text")))


def order_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """One review per order, all fields; `review_date` is still text.

    Every tenth review is by someone who is no customer.
    """
    orders = widen(read_table(spark, folder, "orders"))
    product = F.col("o_orderkey") % 1000
    fields: dict[str, Column] = {
        "marketplace": F.lit("US"),
        "customer_id": F.when(F.col("o_orderkey") % 10 == 0, -F.col("o_custkey") - 1).otherwise(F.col("o_custkey")),
        "review_id": F.concat(F.lit("R"), "o_orderkey"),
        "product_id": F.concat(F.lit("B"), product),
        "product_parent": product.cast("int"),
        "product_title": F.concat(F.lit("Product "), product),
        "product_category": F.col("o_orderstatus"),
        "star_rating": F.substring("o_orderpriority", 1, 1).cast("int"),
        "helpful_votes": (F.col("o_orderkey") % 5).cast("int"),
        "total_votes": (F.col("o_orderkey") % 5 + F.col("o_orderkey") % 3).cast("int"),
        "vine": F.lit("N"),
        "verified_purchase": F.when(F.col("o_orderstatus") == "F", "Y").otherwise("N"),
        "review_headline": F.col("o_orderpriority"),
        "review_body": F.concat_ws(" ", "o_orderpriority", "o_orderstatus", "o_custkey"),
        "review_date": F.date_format("o_orderdate", DATE_FORMAT),
    }
    return orders.select(*(fields[name].alias(name) for name in REVIEW_FIELDS))


def review_json_records(spark: SparkSession, folder: str) -> DataFrame:
    return order_reviews(spark, folder).select(F.to_json(F.struct(*REVIEW_FIELDS)).alias("value"))


def review_tsv_records(spark: SparkSession, folder: str) -> DataFrame:
    fields = [F.col(name) for name in REVIEW_FIELDS]
    return order_reviews(spark, folder).select(tsv_record(*fields).alias("value"))


def customer_rows(table: DataFrame) -> DataFrame:
    """Rows of the customer table with the fields of a customer file."""
    username = F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit(".")))
    born = F.date_add(F.lit("1930-01-01").cast("date"), (F.col("c_custkey") % 20000).cast("int"))
    return table.select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        username.alias("username"),
        F.concat_ws(" ", "c_mktsegment", "c_custkey").alias("name"),
        F.when(F.col("c_nationkey") % 2 == 0, "F").otherwise("M").alias("sex"),
        F.concat(username, F.lit("@example.com")).alias("email"),
        F.date_format(born, "yyyy-MM-dd").alias("birthdate"),
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    return customer_rows(read_table(spark, folder, "customer"))
