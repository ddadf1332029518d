from __future__ import annotations

import types

import pytest
from helpers import tuples, values
from pyspark.sql import functions as F

from reviewflow import catalog, keyed_tables, session
from reviewflow.operators import reviews
from reviewflow.schemas import STORED_REVIEW


@pytest.fixture
def database(spark, tmp_path):
    catalog.create_database(spark, "lake", str(tmp_path / "lake"))
    yield "lake"
    spark.sql("DROP DATABASE lake CASCADE")


def write_reviews(spark, path, *records):
    parsed = reviews.parse_review_json(values(spark, *records))
    reviews.with_processing_time(parsed).write.mode("append").parquet(path)


def test_external_table(spark, database, tmp_path):
    path, table = str(tmp_path / "reviews"), f"{database}.reviews"
    write_reviews(spark, path, '{"star_rating": 5}', '{"star_rating": 2}')
    created = catalog.create_external_table(spark, table, path)
    assert created.schema == STORED_REVIEW
    assert tuples(catalog.table_columns(spark, table)) == [
        (field.name, field.dataType.simpleString()) for field in STORED_REVIEW
    ]
    assert catalog.read_external_table(spark, table).count() == 2
    write_reviews(spark, path, '{"star_rating": 1}')
    assert catalog.read_external_table(spark, table).count() == 3
    spark.sql(f"DROP TABLE {table}")
    assert spark.read.parquet(path).count() == 3


def test_query_to_location(spark, database, tmp_path):
    path, table = str(tmp_path / "reviews"), f"{database}.reviews"
    write_reviews(spark, path, '{"star_rating": 5}', '{"star_rating": 2}')
    catalog.create_external_table(spark, table, path)
    kept = catalog.query_to_location(
        spark, f"SELECT max(star_rating) AS best FROM {table}", str(tmp_path / "results")
    )
    assert tuples(kept) == [(5,)]
    assert tuples(spark.read.parquet(str(tmp_path / "results"))) == [(5,)]


def test_table_stats(spark, database, tmp_path):
    path, table = str(tmp_path / "reviews"), f"{database}.reviews"
    write_reviews(spark, path, '{"star_rating": 5}', '{"star_rating": 2}')
    catalog.create_external_table(spark, table, path)
    ((name, size, count),) = tuples(catalog.table_stats(spark, table))
    assert (name, count) == ("reviews", 2)
    assert size > 0


def test_recorded_stats_need_no_scan(spark, database, tmp_path, monkeypatch):
    path, table = str(tmp_path / "reviews"), f"{database}.reviews"
    write_reviews(spark, path, '{"star_rating": 5}', '{"star_rating": 2}')
    catalog.create_external_table(spark, table, path)
    size = catalog.folder_bytes(spark, path)
    catalog.record_stats(spark, table, path, 2)
    assert tuples(catalog.table_stats(spark, table)) == [("reviews", size, 2)]
    assert "Statistics" not in keyed_tables.described(spark, table)
    # Files that came later are not in the record.
    write_reviews(spark, path, '{"star_rating": 1}')
    catalog.read_external_table(spark, table)
    ((_, larger, count),) = tuples(catalog.table_stats(spark, table))
    assert count == 3 and larger > size


def test_sql_file_over_views(spark, tmp_path):
    spark.range(4).createOrReplaceTempView("numbers")
    (tmp_path / "sum.sql").write_text("SELECT sum(id) AS total\nFROM numbers")
    assert tuples(catalog.run_sql_file(spark, tmp_path / "sum.sql")) == [(6,)]
    spark.catalog.dropTempView("numbers")


def test_settings_are_put_back(spark):
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    with session.session_settings(spark, {name: "17", "spark.reviewflow.unset": "x"}):
        assert spark.conf.get(name) == "17"
    assert spark.conf.get(name) == before
    assert spark.conf.get("spark.reviewflow.unset", None) is None


def fake_session(master, root):
    settings = {"spark.checkpoint.dir": root, "spark.sql.warehouse.dir": "/warehouse"}
    conf = types.SimpleNamespace(get=lambda name, default: settings.get(name, default))
    return types.SimpleNamespace(conf=conf, sparkContext=types.SimpleNamespace(master=master))


def test_shared_folder_is_under_the_checkpoint_folder():
    one, two = (session.shared_folder(fake_session("yarn", "hdfs://c/x/"), "out") for _ in "ab")
    assert one.startswith("hdfs://c/x/reviewflow/out-")
    assert one != two


def test_a_cluster_needs_a_checkpoint_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(fake_session("yarn", None), "out")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(fake_session("local-cluster[2,1,1024]", None), "out")
    for master in ("local", "local[2]", "local[*]"):
        local = session.shared_folder(fake_session(master, None), "out")
        assert local.startswith("/warehouse/reviewflow/out-")


def test_a_database_elsewhere_is_an_error(spark, database, tmp_path):
    catalog.create_database(spark, database, str(tmp_path / "lake"))
    with pytest.raises(ValueError, match="exists at"):
        catalog.create_database(spark, database, str(tmp_path / "other"))


def test_a_managed_table_is_not_replaced(spark, database, tmp_path):
    table = f"{database}.managed"
    spark.range(3).write.saveAsTable(table)
    with pytest.raises(ValueError, match="not external"):
        catalog.create_external_table(spark, table, str(tmp_path / "reviews"))
    assert spark.table(table).count() == 3


def test_only_small_inputs_are_widened(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    spark.range(1000).select(F.col("id")).coalesce(1).write.parquet(path)
    table = spark.read.parquet(path)
    assert session.widen(table).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(session, "SMALL_INPUT_BYTES", 10)
    assert session.widen(table) is table


def test_shuffles_grow_with_the_input_within_a_block(spark, tables, monkeypatch):
    name = "spark.sql.shuffle.partitions"
    table = spark.read.parquet(f"{tables}/orders.parquet")

    def partitions():
        with session.sized_shuffles(table):
            return spark.conf.get(name)

    with session.session_settings(spark, {name: "4"}):
        assert partitions() == "4"
        monkeypatch.setattr(session, "SHUFFLE_INPUT_BYTES", session.source_bytes(table) // 9)
        assert partitions() == "9"
        monkeypatch.setattr(session, "SHUFFLE_INPUT_BYTES", 1)
        monkeypatch.setattr(session, "MOST_SHUFFLE_PARTITIONS", 12)
        assert partitions() == "12"
        assert spark.conf.get(name) == "4"
