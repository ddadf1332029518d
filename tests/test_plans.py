"""The plans of the registered queries keep to what scales."""

from __future__ import annotations

import re

import pytest
from helpers import plan
from pyspark.sql.classic.dataframe import DataFrame

from reviewflow.operators import customers as people
from reviewflow.operators import reviews
from reviewflow.plans import feeds
from reviewflow.plans.queries import QUERIES
from reviewflow.streaming import sinks

NOT_SCALABLE = re.compile(
    "CartesianProduct|BroadcastNestedLoopJoin|PythonUDF|EvalPython|InPandas|InArrow|MapPartitions"
)

# Queries that do their work before they return what it left behind.
STREAMING = {
    "word_count_stream", "word_count_updates", "enrich_stream", "enriched_table", "batch_progress", "top_words_stream",
    "good_records", "malformed_records", "publish_and_drain", "ingest_parquet_stream", "ingest_restart",
    "external_table", "query_to_location", "table_stats",
}
LANDING = STREAMING | {"text_lines", "tsv_scan", "customer_scan", "put_rows", "publish_keyed_csv", "publish_users"}

# Queries that only plan, and what the file scan must read.
SCANNED = {
    "word_count": "struct<text:string>",
    "word_count_sql": "struct<text:string>",
    "top_words": "struct<text:string>",
    "batch_lookup": "struct<o_orderkey:bigint,o_custkey:bigint>",
    "latest_per_key": "struct<event_id:bigint,user_id:bigint,event_type:string,props:string>",
    "parse_event_json": "struct<props:string>",
}


# Settings that no query may leave changed.
SETTINGS = ["spark.sql.shuffle.partitions", "spark.sql.streaming.stateStore.providerClass"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_plan_multiplies_rows_or_leaves_the_jvm(spark, tables, name, monkeypatch):
    """The last read, and the plans of the work that the query does before: streams by what Spark
    tells of them, batch work by the plan of every DataFrame that is written."""
    plans, streams = [], []
    write, wait = DataFrame.write.fget, sinks.wait

    def written(df):
        if not df.isStreaming:
            plans.append(plan(df))
        return write(df)

    def waited(query, seconds=None):
        wait(query, seconds)
        streams.append(query._jsq.explainInternal(False))
        return query

    monkeypatch.setattr(type(spark.range(0)), "write", property(written))
    monkeypatch.setattr(sinks, "wait", waited)
    before = [spark.conf.get(setting, None) for setting in SETTINGS]
    plans.append(plan(QUERIES[name](spark, tables)))
    assert [spark.conf.get(setting, None) for setting in SETTINGS] == before
    for shape in plans + streams:
        assert not NOT_SCALABLE.search(shape)
    assert len(plans) > 1 or name not in LANDING
    assert bool(streams) == (name in STREAMING)


@pytest.mark.parametrize("name", sorted(SCANNED))
def test_only_used_columns_are_read(spark, tables, name):
    assert f"ReadSchema: {SCANNED[name]}" in plan(QUERIES[name](spark, tables))


def test_join_parses_each_record_once(spark, tables):
    parsed = reviews.parse_review_tsv(feeds.review_tsv_records(spark, tables))
    shape = plan(people.enrich(parsed, feeds.customers(spark, tables)))
    assert shape.count("from_csv(") == 1


def test_customers_are_broadcast_by_their_size_only(spark, tables):
    joined = QUERIES["enrich_join"](spark, tables)
    assert "BroadcastHashJoin" in plan(joined)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan(QUERIES["enrich_join"](spark, tables))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_running_count_takes_several_batches(spark, tables, monkeypatch):
    seen = []
    wait = sinks.wait
    monkeypatch.setattr(sinks, "wait", lambda query: seen.append(wait(query)))
    QUERIES["word_count_stream"](spark, tables)
    (query,) = seen
    assert query.lastProgress["batchId"] >= 2
    assert "Sort" in query._jsq.explainInternal(False)


def test_literal_rows_are_joined_without_sorting_the_reviews(spark, tables):
    shape = plan(QUERIES["rows_to_table"](spark, tables))
    assert "BroadcastHashJoin" in shape and "SortMergeJoin" not in shape
