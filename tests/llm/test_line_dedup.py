from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from reviewflow.llm import line_dedup as op
from reviewflow.session import session_settings


def key_of(line):
    return line.encode().strip(op.BLANKS).lower().decode()


def brute_force(rows):
    holders = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= op.LEAST_LENGTH:
                holders.setdefault(key_of(line), set()).add(doc_id)
    largest = {
        k: max(ids, key=lambda i: (i is not None, i or 0)) for k, ids in holders.items() if len(ids) >= op.LEAST_DOCUMENTS
    }
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [line for line in lines if key_of(line) not in largest or largest[key_of(line)] == doc_id]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def digests(rows):
    return sorted(((d, n, m, hashlib.sha256(t.encode()).hexdigest()) for d, n, m, t in rows), key=str)


@pytest.fixture(scope="module")
def rows():
    source = random.Random(4)
    pool = [f"Line {i} " + "of some length that is é enough " * (1 + i % 3) for i in range(30)]
    rows = [(1, None), (2, ""), (3, "\n\n"), (None, pool[0]), (7, "\n".join(pool) * 3), (7, pool[1]), (7, pool[1]), (7, "x\n" + pool[1])]
    for i in range(10, 150):
        lines = [source.choice([str.upper, str.lower, lambda x: "\t" + x + " \r"])(source.choice(pool)) for _ in range(source.randint(0, 4))]
        rows.append((i, "\n".join([f"own line {i}", pool[0], *lines])))
    return rows


@pytest.mark.parametrize("partitions", ["2", "40"])
def test_equals_brute_force(spark, rows, partitions):
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    with session_settings(spark, {"spark.sql.shuffle.partitions": partitions}):
        got = sorted((tuple(row) for row in op.line_digests(docs).collect()), key=str)
    assert got == digests(brute_force(rows))


def test_texts_and_odd_columns(spark, rows):
    odd = spark.createDataFrame(
        [(d, t, "k", i) for i, (d, t) in enumerate(rows)], "doc_id BIGINT, text STRING, keep_bitmap STRING, lines INT"
    )
    out = op.dedup_lines(odd)
    assert out.columns == odd.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    wanted = [(d, None if t is None else kept) for (d, t), (_, _, _, kept) in zip(rows, brute_force(rows), strict=True)]
    assert got == sorted(wanted, key=str)
    assert op.dedup_lines(odd.limit(0)).count() == 0
    assert op.line_digests(odd.limit(0)).count() == 0


def test_bitmaps():
    numbers = [np.array([0, 9], "<u4").tobytes(), np.array([9, 3], "<u4").tobytes()]
    keep = op.unpack(op.pack(numbers), 20)
    assert [i for i, k in enumerate(keep) if not k] == [0, 3, 9]
    assert op.unpack(None, 3).all()
    assert op.kept_text(b"a\nb\nc\n", op.pack([np.array([1], "<u4").tobytes()])) == (b"a\nc\n", 4, 1)
