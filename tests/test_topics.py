from __future__ import annotations

import datetime
from concurrent.futures import ThreadPoolExecutor

import pytest
from helpers import plan, tuples, values
from pyspark.sql import functions as F

from reviewflow.operators import records
from reviewflow.schemas import TOPIC_RECORD
from reviewflow.session import session_settings
from reviewflow.sources import files, rows, topics

ENVIRONMENT = {"SHOP_BOOTSTRAP": "b1:9092", "SHOP_USERNAME": "ann", "SHOP_PASSWORD": "s3c\"ret"}


def test_connection_from_environment():
    connection = topics.Connection.from_environment("SHOP_", ENVIRONMENT, truststore="t.jks")
    assert connection == topics.Connection("b1:9092", "ann", 's3c"ret', "t.jks")
    assert "s3c" not in repr(connection)


@pytest.mark.parametrize("name", sorted(ENVIRONMENT))
def test_connection_needs_all_settings(name):
    environment = {key: value for key, value in ENVIRONMENT.items() if key != name}
    with pytest.raises(KeyError, match=name):
        topics.Connection.from_environment("SHOP_", environment)


def test_options_of_a_login_connection():
    connection = topics.Connection("b1:9092", "ann", 's3c"ret', "t.jks")
    topic = topics.KafkaTopic("reviews", connection)
    assert topic.source_options(10) == {
        "kafka.bootstrap.servers": "b1:9092",
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "SCRAM-SHA-512",
        "kafka.ssl.truststore.location": "t.jks",
        "kafka.sasl.jaas.config": (
            "org.apache.kafka.common.security.scram.ScramLoginModule required "
            'username="ann" password="s3c\\"ret";'
        ),
        "subscribe": "reviews",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "10",
    }


def test_options_of_a_plain_connection():
    topic = topics.KafkaTopic("word-count", topics.Connection("localhost:9092"))
    assert topic.source_options() == {
        "kafka.bootstrap.servers": "localhost:9092",
        "subscribe": "word-count",
        "startingOffsets": "earliest",
    }
    assert topic.drain_options() == {**topic.source_options(), "endingOffsets": "latest"}
    assert topic.sink_options() == {
        "kafka.bootstrap.servers": "localhost:9092",
        "kafka.acks": "1",
        "topic": "word-count",
    }


def test_broker_records_are_decoded(spark):
    raw = spark.createDataFrame(
        [(None, "é".encode(), "t", 0, 5, datetime.datetime(2024, 1, 1))],
        "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP",
    )
    decoded = topics.decoded(raw)
    assert decoded.schema == TOPIC_RECORD
    assert tuples(topics.values(raw)) == [("é",)]
    assert topics.record_metadata(raw).columns == [*topics.METADATA_FIELDS, "value"]


@pytest.fixture
def topic(tmp_path):
    return topics.FileTopic("lines", str(tmp_path / "topic"))


def test_records_have_positions_also_when_published_at_a_time(spark, topic, tmp_path):
    first = spark.range(100).select(F.col("id").alias("key"), F.lit("a").alias("value"))
    second = values(spark, *"bcd").repartition(2)
    with ThreadPoolExecutor(2) as publishers:
        list(publishers.map(topic.publish, [first, second]))
    held = topic.read(spark)
    assert held.columns == ["key", "value", *topics.FILE_METADATA_FIELDS]
    assert held.count() == held.select("file", "row").distinct().count() == 103
    assert held.where("key IS NULL").count() == 3
    assert held.where("timestamp IS NULL OR topic <> 'lines'").count() == 0
    assert topics.record_metadata(held).columns == [*topics.FILE_METADATA_FIELDS, "value"]

    path = str(tmp_path / "positions")
    query = topic.stream(spark).writeStream.format("parquet").option("path", path)
    query = query.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.read.parquet(path).select("file", "row").distinct().count() == 103


def test_capped_stream_reads_the_topic_in_several_batches(spark, topic, tmp_path):
    topic.publish(values(spark, *"abcdefgh").repartition(4))
    cap = topic.files_per_batch(spark, 2)
    path = str(tmp_path / "out")
    query = (
        topics.values(topic.stream(spark, cap))
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert query.lastProgress["batchId"] >= 1
    assert sorted(row.value for row in spark.read.parquet(path).collect()) == list("abcdefgh")


@pytest.mark.parametrize(
    ("line", "kept"),
    [("a", True), (" a ", True), ("", False), (" \t", False), ("\x01\x1f", False), ("\xa0", True)],
)
def test_blank_lines(spark, line, kept):
    left = tuples(records.without_blank_lines(values(spark, line)))
    assert left == ([(line,)] if kept else [])


def test_known_header_is_dropped(spark):
    lines = values(spark, "id\tname", "1\ta", "id\tname", "2\tb")
    assert tuples(records.without_line(lines, "id\tname")) == [("1\ta",), ("2\tb",)]


@pytest.mark.parametrize("block", ["128m", "64"])
def test_first_line_of_each_file_is_dropped(spark, tmp_path, block):
    contents = {
        "title.txt": ["title", "line 1", "title"] + [f"more {i}" for i in range(40)],
        "blank.txt": ["", "kept", "", "x" * 300] + [f"tail {i}" for i in range(40)],
        "single.txt": ["only a header"],
    }
    for name, lines in contents.items():
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    settings = {
        "spark.sql.files.maxPartitionBytes": block,
        "spark.sql.files.openCostInBytes": "0" if block == "64" else "4m",
    }
    with session_settings(spark, settings):
        got = files.read_text_after_first_line(spark, str(tmp_path))
        assert sorted(row.value for row in got.collect()) == sorted(
            line for lines in contents.values() for line in lines[1:]
        )


def test_no_text_is_shuffled_to_drop_first_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text("title\nline\n")
    shape = plan(files.read_text_after_first_line(spark, str(tmp_path)))
    exchanges = [line for line in shape.splitlines() if "Exchange" in line]
    assert any("Broadcast" in line for line in exchanges)
    assert not [line for line in exchanges if "value" in line]
    assert "SortMergeJoin" not in shape


def test_customer_columns_are_bound_by_name(spark, tmp_path):
    (tmp_path / "a.txt").write_text("username\tcustomer_id\tname\tsex\temail\tbirthdate\nann\t007\tA\tF\te\tb\n")
    assert tuples(files.read_customers(spark, str(tmp_path))) == [("007", "ann", "A", "F", "e", "b")]
    (tmp_path / "a.txt").write_text("username\tcustomer_id\tname\tsex\tbirthdate\nann\t007\tA\tF\tb\n")
    with pytest.raises(Exception, match="email"):
        files.read_customers(spark, str(tmp_path))


def test_customer_files_of_another_header_fail(spark, tmp_path):
    names = ["customer_id", "username", "name", "sex", "email", "birthdate"]
    for file, header in (("a", names), ("b", names[::-1])):
        (tmp_path / file).write_text("\t".join(header) + "\n" + "\t".join("123456") + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_customers(spark, str(tmp_path)).collect()


def test_file_order_of_split_files(spark, tmp_path):
    lines = [f"line {i}" for i in range(200)]
    (tmp_path / "a.txt").write_text("\n".join(lines))
    with session_settings(
        spark, {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "0"}
    ):
        ordered = files.with_file_order(spark.read.text(str(tmp_path))).orderBy(*files.FILE_ORDER)
        assert [row.value for row in ordered.collect()] == lines


def test_csv_records(spark):
    users = spark.createDataFrame(
        [(1, "Ann, A", "a,n,n@x"), (2, None, "bob@x")], "id INT, name STRING, email STRING"
    )
    made = records.csv_records(users, F.col("id"), F.col("name"), F.col("email"))
    assert tuples(made) == [("1", "1,Ann A,ann@x"), ("2", "2,,bob@x")]


def test_record_ids(spark):
    assert tuples(rows.record_ids(spark, 3)) == [(1, "1"), (2, "2"), (3, "3")]
    assert rows.record_ids(spark, 0).count() == 0


def test_rows_to_table(spark):
    table = rows.rows_to_table(spark, [("1", "ann"), ("2", None)], ["customer_id", "username"])
    assert tuples(table) == [("1", "ann"), ("2", None)]
    assert table.columns == ["customer_id", "username"]
