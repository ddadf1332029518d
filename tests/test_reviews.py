from __future__ import annotations

import datetime
import json

import pytest
from helpers import plan, tuples, values
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reviewflow.operators import reviews
from reviewflow.schemas import REVIEW, REVIEW_FIELDS, REVIEW_STRINGS, all_strings
from reviewflow.sources import files

JSON_SCHEMA = (
    StructType().add("a", "string").add("id", "long").add("r", "integer").add("ts", "timestamp")
)
TSV_SCHEMA = all_strings(["m", "id", "t"])
MIDNIGHT = datetime.datetime(2015, 8, 31)


@pytest.mark.parametrize(
    ("record", "expected"),
    [
        ("bad", (None, None, None, None)),
        (None, (None, None, None, None)),
        ('{"a":"y","id":"7","r":"x","ts":"2015-08-31"}', ("y", None, None, MIDNIGHT)),
        ('{"a":"z"}', ("z", None, None, None)),
        ('{"a":"q","id":1.5,"r":99999999999,"extra":1}', ("q", None, None, None)),
        (
            '{"ts":"2015-01-12T00:00:00.000-06:00"}',
            (None, None, None, datetime.datetime(2015, 1, 12, 6)),
        ),
    ],
)
def test_json_record(spark, record, expected):
    # The collected timestamps are in the zone of this process: compare them as UTC text.
    parsed = reviews.parse_json(values(spark, record), JSON_SCHEMA)
    got = tuples(parsed.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))
    text = expected[3].strftime("%Y-%m-%d %H:%M:%S") if expected[3] else None
    assert got == [(*expected[:3], text)]


@pytest.mark.parametrize(
    ("record", "expected"),
    [
        ("US\t2", ("US", "2", None)),
        ("US\t3\ty\textra", ("US", "3", "y")),
        ("US\t\tz", ("US", None, "z")),
        ("", (None, None, None)),
        (None, (None, None, None)),
        ('US\t"q\tz', ("US", "q\tz", None)),
        ('US\tmid"q"\tz', ("US", 'mid"q"', "z")),
        ("marketplace\tid\tt", ("marketplace", "id", "t")),
        ("US\t007\t z ", ("US", "007", " z ")),
    ],
)
def test_tsv_record(spark, record, expected):
    assert tuples(reviews.parse_tsv(values(spark, record), TSV_SCHEMA)) == [expected]


def test_tsv_without_quoting(spark):
    records = values(spark, 'US\t"q\tz')
    assert tuples(reviews.parse_tsv(records, TSV_SCHEMA, quote="")) == [("US", '"q', "z")]


def review(number, rating):
    return {
        "marketplace": "US",
        "customer_id": number,
        "review_id": f"R{number}",
        "product_id": "B1",
        "product_parent": 12,
        "product_title": "A ball",
        "product_category": "Toys",
        "star_rating": rating,
        "helpful_votes": 1,
        "total_votes": 2,
        "vine": "N",
        "verified_purchase": "Y",
        "review_headline": "Short",
        "review_body": "Round.",
        "review_date": "2015-01-12T00:00:00.000-06:00",
    }


def test_average_of_parsed_json_reviews(spark):
    records = values(spark, *(json.dumps(review(i, r)) for i, r in enumerate([5, 1, 5])))
    parsed = reviews.parse_review_json(records)
    assert parsed.schema == REVIEW
    assert tuples(reviews.average_rating(parsed)) == [(3.67,)]


def test_average_skips_missing_ratings(spark):
    records = values(spark, json.dumps(review(1, 4)), "broken", json.dumps(review(2, None)))
    assert tuples(reviews.average_rating(reviews.parse_review_json(records))) == [(4.0,)]
    none = values(spark, "broken")
    assert tuples(reviews.average_rating(reviews.parse_review_json(none))) == [(None,)]


def test_average_parses_only_the_rating(spark):
    records = values(spark, json.dumps(review(1, 4)))
    shape = plan(reviews.average_rating(reviews.parse_review_json(records)))
    assert "star_rating" in shape
    assert "StructField(review_body" not in shape


def test_review_tsv_has_all_fields_as_strings(spark):
    record = "\t".join(str(value) for value in review(7, 5).values())
    parsed = reviews.parse_review_tsv(values(spark, record))
    assert parsed.schema == REVIEW_STRINGS
    assert tuples(parsed) == [tuple(str(value) for value in review(7, 5).values())]


def test_processing_time_is_one_value(spark):
    stamped = reviews.with_processing_time(spark.range(1000).repartition(4))
    assert stamped.select("current_tsp").distinct().count() == 1


def test_tsv_files_with_header(spark, tmp_path):
    header = "\t".join(REVIEW_FIELDS)
    row = "\t".join(["US", "00042", *("x" * i for i in range(1, 14))])
    for number in (1, 2):
        (tmp_path / f"{number}.tsv").write_text(f"{header}\n{row}\n")
    table = files.read_tsv(spark, str(tmp_path))
    assert table.columns == REVIEW_FIELDS
    assert {kind for _, kind in table.dtypes} == {"string"}
    assert [row.customer_id for row in table.collect()] == ["00042", "00042"]


def test_customer_files_keep_leading_zeros(spark, tmp_path):
    lines = ["customer_id\tusername\tname\tsex\temail\tbirthdate", "00001\tu\tN\tF\te@x\t2000-01-01"]
    (tmp_path / "customers.txt").write_text("\n".join(lines))
    assert tuples(files.read_customers(spark, str(tmp_path))) == [
        ("00001", "u", "N", "F", "e@x", "2000-01-01")
    ]
