from __future__ import annotations

import pytest
from helpers import final_plan, plan, tuples
from pyspark.sql import functions as F

from reviewflow.operators import customers as people
from reviewflow.session import session_settings

CUSTOMERS = [
    ("1", "ann", "Ann A", "F", "ann@x", "1990-01-01"),
    ("2", "bob", "Bob B", "M", "bob@x", "1991-01-01"),
    ("3", "cy", "Cy C", "M", "cy@x", "1992-01-01"),
]
CUSTOMER_DDL = (
    "customer_id STRING, username STRING, name STRING, sex STRING, email STRING, birthdate STRING"
)


@pytest.fixture
def customers(spark):
    return spark.createDataFrame(CUSTOMERS, CUSTOMER_DDL)


@pytest.fixture
def reviews(spark):
    rows = [("2", "R1", "ball"), ("9", "R2", "cup"), ("2", "R3", "kite"), (None, "R4", "top")]
    return spark.createDataFrame(rows, "customer_id STRING, review_id STRING, product_title STRING")


def test_point_lookup(customers):
    assert tuples(people.point_lookup(customers, "customer_id", "3")) == [CUSTOMERS[2]]
    assert tuples(people.point_lookup(customers, "customer_id", "03")) == []


def test_point_lookup_reaches_the_file_scan(spark, tables):
    found = people.point_lookup(spark.read.parquet(f"{tables}/customer.parquet"), "c_custkey", 23)
    assert "EqualTo(c_custkey,23)" in plan(found)


def test_lookup_form_drops_sex(customers):
    form = people.lookup_form(customers)
    assert form.columns == ["customer_id", "username", "name", "email", "birthdate"]


def test_batch_lookup_takes_repeats_and_unknown_keys(customers, reviews):
    assert tuples(people.batch_lookup(customers, reviews)) == [CUSTOMERS[1]]


def test_batch_lookup_sums_keys_up_before_the_shuffle(customers, reviews):
    shape = plan(people.batch_lookup(customers, reviews))
    assert "LeftSemi" in shape
    assert shape.count("HashAggregate(keys=[customer_id") >= 2


def test_enrich_drops_reviews_without_customer(customers, reviews):
    enriched = people.enrich(reviews, customers)
    assert enriched.columns == ["customer_id", "review_id", "product_title", "username", "name"]
    assert sorted(tuples(enriched)) == [
        ("2", "R1", "ball", "bob", "Bob B"),
        ("2", "R3", "kite", "bob", "Bob B"),
    ]


def test_enrich_joins_numeric_keys_as_text(spark, customers):
    typed = spark.createDataFrame(
        [(2, "R1", "ball")], "customer_id BIGINT, review_id STRING, product_title STRING"
    )
    assert tuples(people.enrich(typed, customers)) == [("2", "R1", "ball", "bob", "Bob B")]


def test_enrich_splits_a_hot_customer(spark):
    """A third of the reviews are one customer's; the join must split that customer's tasks."""
    total = 60_000
    hot = spark.range(total, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("customer_id"),
        F.concat(F.lit("R"), "id").alias("review_id"),
        F.repeat(F.lit("title "), 20).alias("product_title"),
    )
    lookup = spark.range(0, total, 2).select(
        F.col("id").cast("string").alias("customer_id"),
        F.concat(F.lit("u"), "id").alias("username"),
        F.lit("n").alias("name"),
    )
    tight = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    with session_settings(spark, tight):
        enriched = people.enrich(hot, lookup)
        assert "skew=true" in final_plan(enriched)
        got = {row.review_id: row.username for row in enriched.collect()}
    owner = {f"R{i}": 0 if i % 3 == 0 else i for i in range(total)}
    assert got == {review: f"u{key}" for review, key in owner.items() if key % 2 == 0}


def test_latest_per_key_with_a_hot_key(spark):
    rows = [(0 if i % 3 == 0 else i % 50, i * 7919 % 10_007, f"v{i}") for i in range(9_000)]
    table = spark.createDataFrame(rows, "key INT, at INT, note STRING").repartition(6)
    latest = people.latest_per_key(table, "key", ["at"])
    expected = {}
    for key, at, note in rows:
        expected[key] = max(expected.get(key, (-1, "")), (at, note))
    assert {key: (at, note) for key, at, note in tuples(latest)} == expected
    assert "partial_max" in plan(latest)


def test_ties_do_not_depend_on_the_order_of_the_rows(spark):
    rows = [("1", "a", 5), ("1", "c", 5), ("1", "b", 5)]
    for order in (rows, rows[::-1]):
        table = spark.createDataFrame(order, "key STRING, note STRING, at INT")
        assert tuples(people.latest_per_key(table, "key", ["at"])) == [("1", "c", 5)]


def test_first_rows(customers):
    assert [row.customer_id for row in people.first_rows(customers, ["customer_id"], 2).collect()] == [
        "1",
        "2",
    ]
