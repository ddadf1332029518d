"""Ranked search against scores of all documents, worked out one by one."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from reviewflow.llm import lexical_search as lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_force(docs, items):
    held = [(doc_id, Counter(terms(text))) for doc_id, text in docs if terms(text)]
    n = len(held)
    length = sum(one.total() for _, one in held)
    df = Counter(term for _, one in held for term in one)
    out = []
    for item_id, text in dict.fromkeys(items):
        scores = []
        for doc_id, one in held:
            m = 100 - 75 + (75 * one.total() * n) // length
            score = 0
            for term in terms(text):
                if one[term]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[term] + 1)))
                    score += w * ((1_000_000_000 * one[term]) // (1000 * one[term] + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, none, doc_id) in enumerate(sorted(scores)[:10], 1):
            out.append((item_id, rank, None if none else doc_id, -score))
    return sorted(out, key=str)


def found(spark, docs, items):
    documents = spark.createDataFrame([(a, b, 1, "x") for a, b in docs], "doc_id BIGINT, text STRING, score INT, item_id STRING")
    benchmark = spark.createDataFrame([(a, b, 1) for a, b in items], "item_id BIGINT, text STRING, doc_id INT")
    result = lexical.search(documents.repartition(3), benchmark)
    assert result.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, result.collect()), key=str)


def corpus(seed, size):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(120)]
    weights = [1 / (i + 1) for i in range(120)]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.randint(0, 40)))) for i in range(size)]
    docs += [(size + i, docs[3][1]) for i in range(40)]  # a group of copies
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 12)))) for i in range(12)]
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_scoring_all(spark, monkeypatch, seed):
    monkeypatch.setattr(lexical, "BLOCK_DOCUMENTS", 4)
    monkeypatch.setattr(lexical, "SEED_DOCUMENTS", 50)
    monkeypatch.setattr(lexical, "CHUNK_DOCUMENTS", 64)
    docs, items = corpus(seed, 400)
    assert found(spark, docs, items) == brute_force(docs, items)


def test_items_in_parts(spark, monkeypatch):
    monkeypatch.setattr(lexical, "PART_ITEMS", 5)
    docs, items = corpus(3, 60)
    assert found(spark, docs, items) == brute_force(docs, items)


def test_defined_cases(spark, monkeypatch):
    monkeypatch.setattr(lexical, "TEXT_PART", 64)
    long = "Lorem ipsum dolor " * 400
    docs = [(5, "The cat"), (5, "The cat"), (None, "the CAT"), (1, None), (2, ""), (3, "--- !"), (4, long), (6, "ÄPFEL äpfel É9")]
    docs += [(7, "x" * 500), (8, "don't_stop")]
    items = [(1, "the cat cat"), (1, "the cat cat"), (1, "dolor lorem"), (2, None), (3, "zebra"), (None, "äpfel ÄPFEL don t")]
    assert found(spark, docs, items) == brute_force(docs, items)


def test_empty_tables(spark):
    docs, items = corpus(4, 10)
    assert found(spark, [], items) == []
    assert found(spark, docs, []) == []


def test_blocks_bound_their_documents(monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK_DOCUMENTS", 8)
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 9, 300)
    begins = np.append(0, np.cumsum(sizes))
    held = np.concatenate([np.sort(rng.choice(40, size, replace=False)) for size in sizes])
    queries = lexical.Queries([], rng.integers(0, 5000, 40), 300, 5000)
    chunk = lexical.Chunk(begins, held, rng.integers(1, 5, len(held)), rng.integers(5, 50, 300), queries)
    asked, repeats = np.array([0, 3, 17, 39]), np.array([1, 2, 1, 3])
    for term in range(40):
        blocks = chunk.blocks_of(term)
        bounds = blocks.bounds(asked, repeats)
        assert sorted(blocks.order) == sorted(chunk.posted[chunk.lists[term] : chunk.lists[term + 1]])
        for i, bound in enumerate(bounds):
            rows = blocks.order[blocks.begins[i] : blocks.begins[i + 1]]
            scores = [
                sum(r * chunk.values[begins[row] : begins[row + 1]][held[begins[row] : begins[row + 1]] == t].sum() for t, r in zip(asked, repeats, strict=True))
                for row in rows
            ]
            assert not scores or max(scores) <= bound


def test_most_blocks_are_skipped(monkeypatch):
    """A good least score leaves few documents to score."""
    docs, items = corpus(5, 3000)
    numbers = {f"w{i}": i for i in range(120)}
    counted = [Counter(terms(text)) for _, text in docs]
    counted = [one for one in counted if one]
    begins = np.append(0, np.cumsum([len(one) for one in counted]))
    held = np.array([numbers[t] for one in counted for t in sorted(one, key=numbers.get)])
    times = np.array([one[t] for one in counted for t in sorted(one, key=numbers.get)])
    df = Counter(held.tolist())
    weights = np.array([lexical.weight(len(counted), df[i]) for i in range(120)])
    n = np.array([one.total() for one in counted])
    queries = lexical.Queries([], weights, len(counted), int(n.sum()))
    chunk = lexical.Chunk(begins, held, times, n, queries)
    scored = 0
    for _, text in items:
        asked = Counter(terms(text))
        item = lexical.Item(np.array([numbers[t] for t in asked]), np.array(list(asked.values())))
        full = lexical.Best(0)
        chunk.search(item, 0, lambda rows, scores, full=full: full.keep(rows.tolist(), scores))
        again = lexical.Best(full.least)

        def keep(rows, scores, again=again):
            nonlocal scored
            scored += len(rows)
            return again.keep(rows.tolist(), scores)

        chunk.search(item, full.least, keep)
        assert again.hits == full.hits
    assert scored < len(items) * len(counted) / 4
