from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from reviewflow.llm import suffix_dedup as op
from reviewflow.session import session_settings


def brute_force(rows):
    """The contract by a dictionary of all strings of 100 bytes."""
    earliest = {}
    for doc_id, text in rows:
        data = (text or "").encode()
        for start in range(len(data) - op.LENGTH + 1):
            string, place = data[start : start + op.LENGTH], (op.NULL_ID if doc_id is None else doc_id, start)
            earliest[string] = min(earliest.get(string, place), place)
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for start in range(len(data) - op.LENGTH + 1):
            if earliest[data[start : start + op.LENGTH]] < (op.NULL_ID if doc_id is None else doc_id, start):
                gone[start : start + op.LENGTH] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = bytes(b for b, g in zip(data, gone, strict=False) if not g)
        out.append((doc_id, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    return sorted((tuple(row)[:5] for row in op.dedup_spans(docs).collect()), key=str)


def prose(seed, words):
    source = random.Random(seed)
    return " ".join("".join(source.choice(["th", "er", "on", "é", "an", "re"]) for _ in range(source.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="module")
def rows():
    passage, base = prose(1, 60), prose(2, 200)
    source = random.Random(3)
    rows = [
        (1, None), (2, ""), (3, "short"), (None, passage), (5, base), (6, base), (7, base + passage), (8, passage + base),
        (9, "be " * 300), (10, "a" * 1000), (11, "a" * 99), (12, "a" * 100), (13, "a" * 101), (14, prose(4, 30_000)),
        (15, prose(4, 30_000)[5000:9000] + "é" * 300), (16, passage[:99]), (17, passage[:100]), (18, passage), (18, passage),
        (18, "x" + passage), (19, prose(5, 40) + passage + prose(6, 40) + passage + prose(5, 40)),
    ]
    for i in range(40):
        words = base.split()
        for _ in range(i % 7):
            words[source.randrange(len(words))] = "Changed" + str(i)
        rows.append((100 + i, " ".join(words)))
        rows.append((200 + i, prose(300 + i, 10) + " a line that many documents share, of some eighty bytes or so, no more. " + prose(500 + i, 10)))
    return rows


def test_equals_brute_force(spark, rows):
    assert got(spark, rows) == brute_force(rows)


@pytest.mark.parametrize("most", [0, 3])
def test_hashed_windows_equal_brute_force(spark, rows, monkeypatch, most):
    monkeypatch.setattr(op, "MOST_SEGMENTS", most)
    assert got(spark, rows) == brute_force(rows)


@pytest.mark.parametrize("most", [0, 192])
def test_rows_that_share_an_id(spark, monkeypatch, most):
    """Two texts of one document begin alike, and a smaller document holds a part of that."""
    monkeypatch.setattr(op, "MOST_SEGMENTS", most)
    start = prose(21, 60)
    cases = [(5, start + prose(22, 40)), (5, start + prose(23, 40)), (2, prose(24, 9) + start[35:]), (5, start), (5, start), (None, start[60:]), (None, start[60:])]
    for rows in (cases[:3], cases):
        assert got(spark, rows) == brute_force(rows)


@pytest.mark.parametrize("slots", [1, 3])
def test_slots_do_not_change_the_result(spark, rows, monkeypatch, slots):
    monkeypatch.setattr(op, "SLOT_BYTES", 1)
    monkeypatch.setattr(op, "MOST_SLOTS", slots)
    monkeypatch.setattr(op, "CHUNK_SEGMENTS", 50)
    assert got(spark, rows) == brute_force(rows)


def test_documents_of_the_tables_equal_brute_force(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    rows = [(row.doc_id, row.text) for row in docs.collect()]
    assert got(spark, rows) == brute_force(rows)


def test_cut_texts_and_odd_columns(spark):
    text = prose(9, 80)
    odd = spark.createDataFrame([(1, text, "w", 1), (2, "x " + text, None, 2)], "doc_id BIGINT, text STRING, runs STRING, text_hash INT")
    out = op.dedup_text(odd)
    assert out.columns == odd.columns
    assert sorted(tuple(row) for row in out.collect()) == [(1, text, "w", 1), (2, "x ", None, 2)]
    assert op.dedup_spans(odd.limit(0)).count() == 0
    assert op.dedup_text(odd.limit(0)).count() == 0


def test_blind_trie_sorts():
    source = random.Random(1)
    strings = [bytes(source.choice(b"ab") for _ in range(8)) for _ in range(300)]
    order = op.blind_trie(strings)
    assert [strings[leaf[0]] for leaf in order] == sorted(set(strings))
    assert all(strings[i] == strings[leaf[0]] for leaf in order for i in leaf)
    assert sorted(i for leaf in order for i in leaf) == list(range(300))
    assert op.blind_trie([]) == []


def test_sorted_suffixes():
    data = (prose(1, 60) * 4 + prose(2, 50)).encode()
    start = np.arange(len(data) - op.LENGTH + 1)
    order, value = op.equal_windows(np.zeros(len(start), np.int64), start, data)
    strings = [data[s : s + op.LENGTH] for s in start[order]]
    assert strings == sorted(strings)
    assert [a == b for a, b in zip(value, value[1:])] == [a == b for a, b in zip(strings, strings[1:])]


def test_anchors_are_spread_over_the_slots():
    """No slot gets much more than its share of what a task sends: least hashes alone crowd at the low end."""
    texts = [prose(seed, 2000).encode() for seed in range(8)]
    number, start, windows, anchor = op.segments(texts)
    rows = op.keyed(np.arange(8), op.text_hashes(texts), number, start, windows, anchor, np.arange(len(number), dtype=np.uint64))
    sent = [batch for batch in op.send(rows, 20) if batch.column("blob")[0].is_valid]
    sizes = [len(op.unpacked(batch.column("blob")[0].as_py())) for batch in sent]
    assert len(sizes) == 20
    assert max(sizes) < 3 * sum(sizes) / 20


def test_texts_are_hashed_in_spark_as_in_python(spark):
    """No round of all texts through Python before a join, and the hashes still meet."""
    texts = [None, "", "é", *(prose(seed, 3)[:seed] for seed in range(70)), prose(1, 400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    hashes = [row.text_hash for row in docs.orderBy("doc_id").select(op.hash_of_text()).collect()]
    assert hashes == op.text_hashes([(text or "").encode() for text in texts]).tolist()
    plan = op.marked(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan
    assert "EvalPython" not in plan


@pytest.mark.parametrize(("said", "used"), [(None, "512"), ("1000", "1000")])
def test_few_texts_are_read_at_a_time(spark, said, used):
    docs = spark.createDataFrame([(1, prose(1, 60)), (2, prose(1, 60))], "doc_id BIGINT, text STRING")
    rows = "spark.sql.parquet.columnarReaderBatchSize"
    with session_settings(spark, {rows: said or "4096"}):
        assert [row.n_removed > 0 for row in op.dedup_spans(docs).orderBy("doc_id").collect()] == [False, True]
        assert spark.conf.get(rows) == used


def test_a_shuffle_partition_is_one_bucket(spark, tables):
    """Each bucket is a task with a sort of its own and a file; slots, not buckets, bound what a task holds."""
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    with session_settings(spark, {"spark.sql.shuffle.partitions": "20"}):
        assert op.spread(docs) == op.Spread(20, 20)


def test_shuffles_of_written_tables_are_released(spark, monkeypatch):
    """Disk holds what one written table was shuffled for, whenever the driver collects its garbage."""
    setting, seen, stored = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", [], op.stored
    before = spark.conf.get(setting)
    monkeypatch.setattr(op, "stored", lambda *of: seen.append(spark.conf.get(setting)) or stored(*of))
    assert len(got(spark, [(1, prose(1, 60)), (2, prose(1, 60))])) == 2
    assert seen == ["true", "true"]
    assert spark.conf.get(setting) == before
