from __future__ import annotations

import math
import random
from collections import Counter
from hashlib import md5

import pytest

from reviewflow.llm import source_mix as op

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


def brute_copies(doc_id, mean, seed=op.SEED):
    parts = max(1, math.ceil(mean / op.LARGEST_PART))
    total = 0
    for part in range(1, parts + 1):
        u = int(md5(f"{seed}/{doc_id}/{part}".encode()).hexdigest()[:13], 16) / 16**13
        p = reached = math.exp(-mean / parts)
        k = 0
        while reached <= u:
            k += 1
            p *= mean / parts / k
            reached += p
        total += k
    return total


def corpus(spark, sizes):
    rows = [(i, f"t{i}", "en", source, 2) for i, source in enumerate(s for s, n in sizes.items() for _ in range(n))]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA), rows


def test_equals_brute_force_and_meets_the_weights(spark):
    sizes = {"big": 3000, "small": 200, None: 400, "tiny": 1}
    docs, rows = corpus(spark, sizes)
    weights = {"big": 1.0, "small": 1.0, None: 2.0}
    got = op.mix(docs, weights).collect()
    copies = Counter(row.doc_id for row in got)
    for doc_id, _, _, source, _ in rows:
        mean = weights.get(source, 0) / 4 * len(rows) / sizes[source]
        assert copies[doc_id] == (brute_copies(doc_id, mean) if mean else 0)
    shares = Counter(row.source for row in got)
    assert shares["tiny"] == 0
    assert abs(shares["big"] / len(got) - 0.25) < 0.03
    assert abs(shares[None] / len(got) - 0.5) < 0.03
    assert {(row.doc_id, row.copy) for row in got} == {(d, c) for d, n in copies.items() for c in range(1, n + 1)}


def test_large_means(spark):
    docs, rows = corpus(spark, {"a": 3000, "b": 1})
    copies = Counter(row.doc_id for row in op.mix(docs, {"a": 1.0, "b": 1.0}).where("source = 'b'").collect())
    (doc_id,) = [row[0] for row in rows if row[3] == "b"]
    assert copies[doc_id] == brute_copies(doc_id, 1500.5)
    assert abs(copies[doc_id] - 1500) < 200


def test_same_for_any_order_and_sorted_within_tasks(spark):
    docs, _ = corpus(spark, {"a": 300, "b": 100})
    first = op.mix(docs)
    assert sorted(map(str, first.collect())) == sorted(map(str, op.mix(docs.orderBy("text").repartition(7)).collect()))
    assert str(sorted(first.collect())) != str(sorted(op.mix(docs, seed="other").collect()))
    for keys in first.select("shuffle_key").rdd.glom().collect():
        assert [k[0] for k in keys] == sorted(k[0] for k in keys)


def test_odd_tables(spark):
    odd = spark.createDataFrame(
        [(1, None, None, "a", None, 5, 6), (1, None, None, "a", None, 5, 6), (None, "", "x", None, 0, None, 1)],
        SCHEMA + ", copies INT, sums INT",
    )
    got = op.mix(odd).collect()
    pairs = Counter((row.doc_id, row.copy) for row in got if row.doc_id == 1)
    assert set(pairs.values()) <= {2}
    assert op.mix(odd.limit(0)).count() == 0
    assert op.mix(odd, {}).count() == 0


def test_no_python_in_the_plan(spark, tables):
    plan = op.mix(spark.read.parquet(f"{tables}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("mean", [0.01, 1.0, 37.5])
def test_drawn_means(mean):
    drawn = [brute_copies(i, mean) for i in range(4000)]
    assert abs(sum(drawn) / 4000 - mean) < 5 * math.sqrt(mean / 4000)
