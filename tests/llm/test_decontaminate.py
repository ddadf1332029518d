from __future__ import annotations

import math
import random

import pytest
from reviewflow.llm import decontaminate as op


def brute_force(docs, items):
    """Every passage against every item, by verification alone."""
    kept = [(i, *op.question_and_answer((t or "").encode())) for i, t in items]
    kept = [k for k in kept if len(k[1]) + len(k[2]) >= op.LEAST_WORDS]
    cell = math.ceil(op.CELL * max((len(q) + len(a) for _, q, a in kept), default=1))
    found = set()
    for doc_id, text in docs:
        words = op.words_of((text or "").encode())
        for at in range(0, len(words), cell):
            passage = words[at : at + 2 * cell]
            for item, question, answer in kept:
                length = min(op.SHINGLE, len(question))
                there = {tuple(passage[i : i + length]) for i in range(len(passage) - length + 1)}
                wanted = op.shingles(question)
                held = sum(min(answer.count(w), passage.count(w)) for w in set(answer))
                if len(question) + len(answer) < op.LOOSE_WORDS:
                    if f" {' '.join(w.decode() for w in question + answer)} " in f" {' '.join(w.decode() for w in passage)} ":
                        found.add((doc_id, item))
                    continue
                if len(wanted & there) >= op.LEAST_OVERLAP * len(wanted) and held >= op.LEAST_OVERLAP * len(answer):
                    found.add((doc_id, item))
    return found


@pytest.fixture(scope="module")
def corpus():
    source = random.Random(6)

    def sentence(n):
        return " ".join(f"w{int(source.paretovariate(0.6)) % 500}" for _ in range(n)).capitalize() + "."

    items = [(i, " ".join(sentence(source.randint(4, 20)) for _ in range(source.randint(1, 4)))) for i in range(120)]
    items += [(500, None), (501, ""), (502, "too short."), (503, items[3][1]), (504, "no sentence end but eight words here now")]
    docs = [(1, None), (2, ""), (3, "word"), (4, items[0][1]), (5, items[1][1].upper()), (5, items[1][1])]
    docs.append((6, " ".join(sentence(12) for _ in range(3000)) + " " + items[7][1]))
    docs.append((7, " ".join(text for _, text in items if text)))
    for i in range(250):
        _, text = items[source.randrange(120)]
        words = text.split()
        for _ in range(i % 5):
            words[source.randrange(len(words))] = source.choice(["other.", "w1", "else"])
        if i % 7 == 0:
            words = words[: len(words) * 2 // 3]
        docs.append((10 + i, f"{sentence(source.randint(1, 90))} {' '.join(words)}, {sentence(source.randint(1, 60))}"))
    docs += [(1000 + i, " ".join(sentence(15) for _ in range(6))) for i in range(60)]
    return docs, items


@pytest.mark.parametrize("part", [1024, 17])
def test_equals_brute_force(spark, corpus, monkeypatch, part):
    monkeypatch.setattr(op, "PART_ITEMS", part)
    docs, items = corpus
    found = op.find_leaks(
        spark.createDataFrame(docs, "doc_id BIGINT, text STRING"), spark.createDataFrame(items, "item_id BIGINT, text STRING")
    ).collect()
    got = {(row.doc_id, row.item_id) for row in found}
    wanted = brute_force(docs, items)
    assert got == wanted and len(wanted) > 100
    assert all(row.score >= 1 - op.SLACK for row in found)


def test_parts_change_no_result(spark, corpus, monkeypatch):
    docs, items = corpus
    # The answer is far from the question, but within two cells of the longest item.
    filler = " ".join(["filler"] * 90)
    items = [*items, (600, "What was the name of the seventh lamp keeper? Jorunn Aldersea."), (601, " ".join(f"long{i}" for i in range(200)))]
    docs = [*docs, (5000, f"What was the name of the seventh lamp keeper? {filler} Jorunn Aldersea."), (None, items[5][1])]
    tables = (
        spark.createDataFrame(docs, "doc_id BIGINT, text STRING").repartition(4),
        spark.createDataFrame(items, "item_id BIGINT, text STRING"),
    )
    whole = sorted(map(repr, op.find_leaks(*tables).collect()))
    assert {(5000, 600)} <= brute_force(docs, items)
    for part in (64, 17):
        monkeypatch.setattr(op, "PART_ITEMS", part)
        found = op.find_leaks(*tables).collect()
        assert sorted(map(repr, found)) == whole
        assert {(row.doc_id, row.item_id) for row in found} == brute_force(docs, items)


@pytest.mark.parametrize("inserted", [4, 12])
def test_inserted_words_at_all_offsets(spark, inserted):
    """A copy with words inserted is found wherever the borders of the cells fall."""
    source = random.Random(8)
    words = [f"q{source.randrange(10_000)}" for _ in range(50)]
    item = " ".join(words[:40]) + "? " + " ".join(words[40:])
    copy = [*words[:20], *(f"more{i}" for i in range(inserted)), *words[20:]]
    docs = [(at, " ".join([*(f"x{at}y{i}" for i in range(at)), *copy, *(f"z{i}" for i in range(60))])) for at in range(220)]
    found = op.find_leaks(
        spark.createDataFrame(docs, "doc_id BIGINT, text STRING"), spark.createDataFrame([(1, item)], "item_id BIGINT, text STRING")
    )
    assert sorted(row.doc_id for row in found.collect()) == list(range(220))


def test_short_items_must_stand_word_for_word(spark):
    items = [(1, "Capital of Elbonia? Mudville city."), (2, "two words"), (3, "Who sang the blue song?")]
    docs = [
        (1, "It asked: capital of ELBONIA - mudville, city! And more."),
        (2, "The city of Mudville, capital of Elbonia, is old."),
        (3, "two words and who sang the red blue song"),
        (4, "who sang the blue song " + "x " * 300 + "capital of elbonia mudville city"),
    ]
    found = op.find_leaks(
        spark.createDataFrame(docs, "doc_id BIGINT, text STRING"), spark.createDataFrame(items, "item_id BIGINT, text STRING")
    )
    assert sorted((row.doc_id, row.item_id) for row in found.collect()) == [(1, 1), (4, 1), (4, 3)] == sorted(brute_force(docs, items))


def test_retrieval_scores_are_bm25(corpus):
    _, items = corpus
    index = op.Index(items)
    for number in range(len(index.ids)):
        assert index.block_max[list(index.impacts[number]), number // op.BLOCK_ITEMS].min() > 0
        assert sum(index.impacts[number].values()) >= 1 - op.SLACK


def test_documents_without_leaks_stay(spark, corpus):
    docs, items = corpus
    odd = spark.createDataFrame([(d, t, 1, "s") for d, t in docs], "doc_id BIGINT, text STRING, item_id INT, score STRING")
    benchmark = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    leaky = {doc_id for doc_id, _ in brute_force(docs, items)}
    stay = op.without_leaks(odd, benchmark)
    assert stay.columns == odd.columns
    assert sorted(row.doc_id for row in stay.collect()) == sorted(d for d, _ in docs if d not in leaky)
    assert op.without_leaks(odd, benchmark.limit(0)).count() == len(docs)
    assert op.find_leaks(odd.limit(0), benchmark).count() == 0


def test_question_and_answer():
    assert op.question_and_answer(b"What is it? A thing. ") == ([b"what", b"is", b"it"], [b"a", b"thing"])
    question, answer = op.question_and_answer(b"one two three four five six seven eight")
    assert (len(question), len(answer)) == (6, 2)
    assert op.question_and_answer(b"") == ([], [])
