"""The jobs by their command line, on topics kept as files."""

from __future__ import annotations

import json

import pytest
from helpers import tuples

from reviewflow.plans import jobs
from reviewflow.schemas import REVIEW_FIELDS
from reviewflow.sources import topics
from reviewflow.streaming import sinks

BOOK = ["A title", "The cat and the dog", "", "the end"]
CUSTOMERS = [
    "customer_id\tusername\tname\tsex\temail\tbirthdate",
    "01\told\tOld A\tF\ta@x\t1990-01-01",
    "02\tbob\tBob, B\tM\tb@x\t1991-01-01",
    "01\tann\tAnn A\tF\ta@x\t1990-01-01",
]


@pytest.fixture
def run(spark):
    return lambda *arguments: jobs.main([str(argument) for argument in arguments])


@pytest.fixture
def book(tmp_path):
    path = tmp_path / "book.txt"
    path.write_text("\n".join(BOOK) + "\n")
    return path


@pytest.fixture
def customers(tmp_path):
    path = tmp_path / "customers.txt"
    path.write_text("\n".join(CUSTOMERS) + "\n")
    return path


def on_topic(name, tmp_path):
    return ["--topic", name, "--topic-path", tmp_path / "topic"]


def as_stream(name, tmp_path):
    return [*on_topic(name, tmp_path), "--checkpoint", tmp_path / "checkpoint", "--until-done"]


@pytest.mark.parametrize("extra", [[], ["--sql"]])
def test_word_count(spark, run, book, tmp_path, capsys, extra):
    run("word-count", "--input", book, "--output", tmp_path / "counts", *extra)
    counts = dict(tuples(spark.read.parquet(str(tmp_path / "counts"))))
    assert counts == {"the": 3, "a": 1, "title": 1, "cat": 1, "and": 1, "dog": 1, "end": 1}
    run("word-count", "--input", book, "--top", 1, *extra)
    assert "|the |3  |" in capsys.readouterr().out


def test_book_to_topic_to_running_count(spark, run, book, tmp_path, capsys):
    run("publish-lines", "--input", book, *on_topic("word-count", tmp_path))
    run("drain-topic", *on_topic("word-count", tmp_path), "--output", tmp_path / "drained")
    drained = spark.read.parquet(str(tmp_path / "drained"))
    assert drained.columns == ["topic", "file", "row", "timestamp", "value"]
    assert sorted(row.value for row in drained.collect()) == ["The cat and the dog", "the end"]
    capsys.readouterr()
    run("word-count-stream", *as_stream("word-count", tmp_path), "--top", 1)
    assert "|the |3  |" in capsys.readouterr().out
    other = [*on_topic("word-count", tmp_path), "--checkpoint", tmp_path / "c2", "--until-done"]
    run("word-count-stream", *other, "--output", tmp_path / "counts")
    counts = dict(tuples(sinks.read_snapshot(spark, str(tmp_path / "counts"))))
    assert counts == {"the": 3, "cat": 1, "and": 1, "dog": 1, "end": 1}


def test_publish_users(spark, run, customers, tmp_path):
    run("publish-users", "--input", customers, *on_topic("connection-test", tmp_path))
    topic = topics.FileTopic("connection-test", str(tmp_path / "topic"))
    got = sorted(tuples(topic.read(spark).select("key", "value")))
    assert got == [("01", "01,Ann A,a@x"), ("01", "01,Old A,a@x"), ("02", "02,Bob B,b@x")]


def test_customers_and_enrichment(spark, run, customers, tmp_path, capsys):
    spark.sql(f"CREATE DATABASE job_shop LOCATION '{tmp_path}/db'")
    try:
        table = ["--table", "job_shop.customers"]
        run("load-customers", "--input", customers, *table, "--location", tmp_path / "loaded")
        assert spark.table("job_shop.customers").columns == [*CUSTOMERS[0].split("\t"), "bucket"]
        capsys.readouterr()
        run("lookup-customer", *table, "--key", "01")
        printed = capsys.readouterr().out
        assert "Ann A" in printed
        assert "Old A" not in printed

        header = "\t".join(REVIEW_FIELDS)
        rows = [dict.fromkeys(REVIEW_FIELDS, "x") | {"customer_id": key} for key in ("01", "77")]
        lines = [header, *("\t".join(row.values()) for row in rows)]
        (tmp_path / "reviews.tsv").write_text("\n".join(lines) + "\n")
        source = ["--input", tmp_path / "reviews.tsv", "--header", header]
        run("publish-lines", *source, *on_topic("reviews", tmp_path))
        expected = [("01", "x", "x", "ann", "Ann A")]
        enrich = ["enrich-reviews", *as_stream("reviews", tmp_path)]
        named = ["--output", tmp_path / "enriched", "--table", "job_shop.enriched"]
        run(*enrich, "--customer-table", "job_shop.customers", *named)
        enriched = spark.read.parquet(str(tmp_path / "enriched")).drop("batch_id")
        assert tuples(enriched) == expected
        assert tuples(spark.table("job_shop.enriched").drop("batch_id")) == expected
        again = ["enrich-reviews", *on_topic("reviews", tmp_path), "--until-done"]
        run(
            *again,
            *("--checkpoint", tmp_path / "c2", "--customers", customers, "--output", tmp_path / "e2"),
        )
        assert tuples(spark.read.parquet(str(tmp_path / "e2")).drop("batch_id")) == expected
        assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("reviewers_")]
    finally:
        spark.sql("DROP DATABASE job_shop CASCADE")


def test_ingest_and_query(spark, run, tmp_path):
    spark.sql(f"CREATE DATABASE job_lake LOCATION '{tmp_path}/db'")
    try:
        lines = ["not a review", *(json.dumps({"star_rating": rating}) for rating in (5, 1, 5))]
        (tmp_path / "reviews.json").write_text("\n".join(lines))
        run("publish-lines", "--input", tmp_path / "reviews.json", *on_topic("reviews", tmp_path))
        run(
            "ingest-reviews",
            *as_stream("reviews", tmp_path),
            *("--output", tmp_path / "stored", "--table", "job_lake.reviews"),
        )
        (tmp_path / "q.sql").write_text(
            "SELECT round(avg(star_rating), 2) AS avg_star_rating FROM job_lake.reviews"
        )
        run("run-query", "--sql-file", tmp_path / "q.sql", "--output", tmp_path / "result")
        assert tuples(spark.read.parquet(str(tmp_path / "result"))) == [(3.67,)]
    finally:
        spark.sql("DROP DATABASE job_lake CASCADE")


@pytest.mark.parametrize(
    ("arguments", "trigger"),
    [
        (["--until-done"], {"availableNow": True}),
        (["--every", "10"], {"processingTime": "10 seconds"}),
        ([], {}),
    ],
)
def test_stream_arguments(arguments, trigger):
    base = ["word-count-stream", "--topic", "t", "--servers", "b:9092", "--checkpoint", "c"]
    args = jobs.parser().parse_args([*base, *arguments])
    assert jobs.trigger_of(args) == trigger
    assert jobs.topic_of(args) == topics.KafkaTopic("t", topics.Connection("b:9092"))


def test_login_from_environment(monkeypatch):
    for name in ("BOOTSTRAP", "USERNAME", "PASSWORD"):
        monkeypatch.setenv(f"SHOP_{name}", name.lower())
    base = ["drain-topic", "--topic", "t", "--environment", "SHOP_", "--truststore", "t.jks"]
    topic = jobs.topic_of(jobs.parser().parse_args(base))
    assert topic.connection == topics.Connection("bootstrap", "username", "password", "t.jks")
