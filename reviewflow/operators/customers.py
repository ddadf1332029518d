"""Customer lookups and the enrichment of reviews."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewflow.schemas import CUSTOMER_LOOKUP_FIELDS, ENRICHED_FIELDS

# The review fields that enrichment reads. A stream selects them ahead of its micro-batches, which
# are cut off from the optimizer's column pruning.
ENRICH_INPUT_FIELDS = ["customer_id", "review_id", "product_title"]


def first_rows(rows: DataFrame, order_by: list[str], n: int = 10) -> DataFrame:
    """The first n rows in the order of some columns."""
    return rows.orderBy(*order_by).limit(n)


def point_lookup(rows: DataFrame, key: str, value: Any) -> DataFrame:
    """Rows of one key. The comparison is on the stored column, so the file scan can use it."""
    return rows.where(F.col(key) == F.lit(value))


def lookup_form(customers: DataFrame) -> DataFrame:
    """Customers with the columns a lookup gives back."""
    return customers.select(*CUSTOMER_LOOKUP_FIELDS)


def batch_lookup(customers: DataFrame, keys: DataFrame, key: str = "customer_id") -> DataFrame:
    """Customers whose key occurs among `keys`; a key without a customer adds nothing.

    The keys are made distinct first, which sums repeats up before the shuffle: a key that fills a
    third of the rows arrives once per task. Spark broadcasts them if they turn out small.
    """
    wanted = keys.select(key).distinct()
    return customers.join(wanted, key, "left_semi")


def enrich(reviews: DataFrame, customers: DataFrame) -> DataFrame:
    """Reviews with the user name and name of their customer; reviews without one are dropped.

    Customer keys are unique: a keyed table's are, and files are put into one first. No side is forced to be broadcast: adaptive execution does it when
    the customers that reach the join are small, and otherwise splits the tasks of a hot customer.
    """
    slim_reviews = reviews.select(*ENRICH_INPUT_FIELDS).withColumn(
        "customer_id", F.col("customer_id").cast("string")
    )
    people = customers.select(F.col("customer_id").cast("string"), "username", "name")
    return slim_reviews.join(people, "customer_id").select(*ENRICHED_FIELDS)


def latest_per_key(
    rows: DataFrame, key: str, order_by: list[str], columns: list[str] | None = None
) -> DataFrame:
    """The last row of each key in the order of some columns, with all columns or those named.

    Ties are settled by the named columns, so the result does not depend on the order of the rows.
    Each task keeps one row per key before the shuffle, so a key with very many rows is not sorted in
    one place. Structs with strings are aggregated by sorting: a task sorts its rows by key, with the
    columns named, and spills if need be. Name no more columns than are used.
    """
    kept = columns or rows.columns
    slim = rows.select(F.col(key).alias("_of"), F.struct(*kept).alias("_row"), F.struct(F.lit(0), *order_by).alias("_at"))
    last = F.max(F.struct("_at", "_row")).alias("_last")
    found = slim.groupBy("_of").agg(last)
    # The key comes from the grouping, whose partitioning a later join on it can use.
    return found.select(
        *(F.col("_of").alias(name) if name == key else F.col("_last._row")[name].alias(name) for name in kept)
    )
