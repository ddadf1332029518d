from __future__ import annotations

import collections
import re

import pytest
from helpers import plan, tuples, values
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reviewflow import catalog
from reviewflow.operators import words
from reviewflow.sources import files
from reviewflow.streaming import sinks


def brute_force(lines):
    counts = collections.Counter()
    for line in lines:
        letters = re.sub("[^a-zA-Z ]", "", line or "").lower()
        counts.update(word for word in letters.split(" ") if word)
    return counts


@pytest.mark.parametrize(
    ("line", "expected"),
    [
        ("Don't stop--now", ["dont", "stopnow"]),
        ("a  b\tc", ["a", "bc"]),
        ("  ", []),
        ("", []),
        (None, []),
        ("été x1y K K", ["t", "xy", "k"]),
    ],
)
def test_tokenize(spark, line, expected):
    assert [row.word for row in words.tokenize(values(spark, line)).collect()] == expected


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="aAbZz é'-\t1İ\U0001d400", max_size=30), max_size=20))
def test_counts_equal_brute_force(spark, lines):
    counts = dict(tuples(words.count_words(values(spark, *lines))))
    assert counts == brute_force(lines)


def test_rank_breaks_ties_by_word(spark):
    ranked = words.rank_words(words.count_words(values(spark, "b a c a c", "d")))
    assert tuples(ranked) == [("a", 2), ("c", 2), ("b", 1), ("d", 1)]
    assert tuples(words.top_words(words.count_words(values(spark, "b a c a c")), 2)) == [
        ("a", 2),
        ("c", 2),
    ]


def test_sql_equals_dataframe(spark, tables):
    lines = words.split_lines(files.read_table(spark, tables, "documents"))
    assert tuples(catalog.word_count_sql(lines)) == tuples(
        words.rank_words(words.count_words(lines))
    )


def test_lines_are_cut_like_the_reader_cuts_them(spark, tmp_path):
    text = "one\r\ntwo\rthree\n\nfour"
    (tmp_path / "book.txt").write_bytes(text.encode())
    read = tuples(files.read_text(spark, str(tmp_path)))
    split = tuples(words.split_lines(spark.createDataFrame([(text,)], "text STRING")))
    assert read == split == [("one",), ("two",), ("three",), ("",), ("four",)]


def test_hot_word_is_summed_before_the_shuffle(spark):
    lines = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("w "), F.col("id"))).alias("value")
    )
    counts = words.count_words(lines)
    assert dict(tuples(counts)) == {"hot": 10_000, "w": 20_000}
    assert "partial_count" in plan(counts)


def test_top_k_does_not_sort_everything(spark):
    shape = plan(words.top_words(words.count_words(values(spark, "a b"))))
    assert "TakeOrderedAndProject" in shape
    assert "rangepartitioning" not in shape


@pytest.fixture(scope="module")
def split_documents(spark, tables, tmp_path_factory):
    """The documents as five files."""
    path = str(tmp_path_factory.mktemp("documents") / "documents.parquet")
    files.read_table(spark, tables, "documents").repartition(5).write.parquet(path)
    return path.rpartition("/")[0]


def test_stream_equals_batch_after_several_batches(spark, split_documents, tmp_path):
    texts = files.stream_table(spark, split_documents, "documents", max_files_per_trigger=1)
    query = sinks.each_batch(
        words.count_words(words.split_lines(texts)),
        sinks.snapshot_table(str(tmp_path / "counts")),
        str(tmp_path / "checkpoint"),
        output_mode="complete",
    )
    sinks.wait(query)
    assert query.lastProgress["batchId"] >= 4
    batch = words.count_words(
        words.split_lines(files.read_table(spark, split_documents, "documents"))
    )
    snapshot = sinks.read_snapshot(spark, str(tmp_path / "counts"))
    assert sorted(tuples(snapshot)) == sorted(tuples(batch))


def test_running_count_can_be_sorted_in_complete_mode_only(spark, split_documents, tmp_path):
    texts = files.stream_table(spark, split_documents, "documents", max_files_per_trigger=2)
    ranked = words.rank_words(words.count_words(words.split_lines(texts)))
    query = (
        ranked.writeStream.format("memory")
        .queryName("ranked_words")
        .outputMode("complete")
        .trigger(availableNow=True)
        .start()
    )
    sinks.wait(query)
    got = tuples(spark.table("ranked_words"))
    assert got == sorted(got, key=lambda row: (-row[1], row[0]))
    with pytest.raises(Exception, match="(?i)sort"):
        sinks.each_batch(ranked, lambda batch, _: None, str(tmp_path / "update"), "update")


def test_console_shows_the_top_of_each_batch(spark, split_documents, tmp_path, capsys):
    texts = files.stream_table(spark, split_documents, "documents")
    counts = words.count_words(words.split_lines(texts))
    work = sinks.show_batch([F.desc("ct"), "word"], 3)
    sinks.wait(sinks.each_batch(counts, work, str(tmp_path / "checkpoint"), "complete"))
    printed = capsys.readouterr().out
    assert "Batch: 0" in printed
    batch = words.count_words(
        words.split_lines(files.read_table(spark, split_documents, "documents"))
    )
    for word, count in tuples(words.top_words(batch, 3)):
        assert re.search(rf"\|{word} *\|{count} *\|", printed)


@pytest.mark.parametrize("tracked", [2, 64, 10_000])
def test_top_words_of_sketches_are_exact(spark, tracked):
    """Also where the sketches are too small for the vocabulary and have to be made anew."""
    rows = [" ".join(f"w{chr(97 + i % 26)}{chr(97 + (i * j) % 26)}" for i in range(60)) for j in range(80)] + ["top top top"] * 50
    lines = values(spark, *rows).repartition(4)
    parts = [lines.where(F.pmod(F.xxhash64("value"), F.lit(3)) == i) for i in range(3)]
    sketches = words.sketch_words(parts[0], tracked)
    for part in parts[1:]:
        sketches = sketches.unionAll(words.sketch_words(part, tracked))
    for k in (1, 7, 2000):
        found = words.top_words_of_sketches(sketches, lines, k, tracked)
        assert tuples(found) == tuples(words.top_words(words.count_words(lines), k))


def test_top_words_of_no_lines(spark):
    lines = values(spark).limit(0)
    assert tuples(words.top_words_of_sketches(words.sketch_words(lines), lines)) == []
