from __future__ import annotations

import random

import numpy as np
import pytest
from reviewflow.llm import quality_classifier as quality
from reviewflow.llm import toxicity
from reviewflow.llm.common import held_out

INSULTS = ["grobnik", "zwakkert", "lompen", "vodden", "smeerlap"]


def corpus(n):
    source = random.Random(8)
    docs, labels = [], []
    for i in range(n):
        good, toxic = source.random() < 0.7, source.random() < 0.25
        words = [f"{source.choice(['an', 'to', 'be', 'ster', 'con'])}{source.choice(['ling', 'den', 'ra', 'mo'])}" for _ in range(source.randint(20, 80))]
        if not good:
            words = [w for w in words[:6] for _ in range(8)] if i % 2 else [w + "###" for w in words]
        if toxic:
            for _ in range(3):
                words.insert(source.randrange(len(words)), source.choice(INSULTS))
        docs.append((i, " ".join(words)))
        labels.append((i, int(good), int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def tables_of(spark):
    docs, labels = corpus(900)
    docs += [(5000, None), (5001, ""), (None, "no id"), (5002, "long " * 100_000), (1, docs[1][1])]
    return (
        spark.createDataFrame([(d, t, 7) for d, t in docs], "doc_id BIGINT, text STRING, score INT"),
        spark.createDataFrame([*labels, (5000, None, None), (None, 1, 1), (99_999, 0, 1)], "doc_id BIGINT, quality INT, toxic INT"),
    )


@pytest.mark.parametrize(
    ("score", "mark", "threshold"),
    [(quality.score_documents, "quality", quality.THRESHOLD), (toxicity.score_documents, "toxic", toxicity.THRESHOLD)],
)
def test_held_out_accuracy_and_odd_rows(spark, tables_of, score, mark, threshold):
    docs, labels = tables_of
    rows = score(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(0 <= row.score <= 1 and row.predicted == (row.score >= threshold) for row in rows)
    by_id = {row.doc_id: row for row in rows}
    assert {5000, 5001, 5002, None} <= set(by_id)
    marks = {row.doc_id: row[mark] for row in labels.collect()}
    late = [row for row in rows if row.held_out and marks.get(row.doc_id) is not None]
    assert len(late) > 100
    assert np.mean([row.predicted == marks[row.doc_id] for row in late]) > 0.97


@pytest.mark.parametrize(("score", "share"), [(quality.score_documents, 0.5), (toxicity.score_documents, 0.0)])
def test_no_labels_and_empty_tables(spark, tables_of, score, share):
    docs, labels = tables_of
    assert {round(row.score, 6) for row in score(docs.limit(5), labels.limit(0)).collect()} == {share}
    assert score(docs.limit(0), labels).count() == 0
    one = labels.where("quality = 1 AND toxic = 1")
    assert {round(row.score, 6) for row in score(docs, one).collect()} == {1.0}


def test_held_out_labels_are_not_used(spark, tables_of):
    docs, labels = tables_of
    flipped = labels.selectExpr(
        "doc_id", *(f"CASE WHEN crc32(string(doc_id)) % 5 = 0 THEN 1 - {c} ELSE {c} END AS {c}" for c in ("quality", "toxic"))
    )
    assert flipped.where(held_out()).exceptAll(labels).count() > 50
    for score in (quality.score_documents, toxicity.score_documents):
        a = {row.doc_id: round(row.score, 6) for row in score(docs, labels).collect()}
        assert a == {row.doc_id: round(row.score, 6) for row in score(docs, flipped).collect()}


def test_rejection_agrees_with_the_scores(spark, tables_of):
    docs, labels = tables_of
    toxic = {row.doc_id for row in toxicity.score_documents(docs, labels).where("predicted = 1").collect()}
    stay = toxicity.without_toxic(docs, labels)
    assert stay.columns == docs.columns
    assert {row.doc_id for row in stay.collect()} == {row.doc_id for row in docs.collect()} - toxic


def test_sampled_labels_give_the_scores_of_all_labels(spark, monkeypatch):
    source = random.Random(3)
    docs, labels, odd = [], [], set()
    for i in range(6000):
        words = [f"{source.choice(['an', 'to', 'be', 'ster', 'con'])}{source.choice(['ling', 'den', 'ra', 'mo'])}" for _ in range(20)]
        toxic = source.random() < 0.03
        # Of the texts with an insult, about two in five are toxic.
        if toxic or source.random() < 0.05:
            odd.add(i)
            words.insert(source.randrange(len(words)), source.choice(INSULTS))
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(docs, "doc_id BIGINT, text STRING")
    labels = spark.createDataFrame(labels, "doc_id BIGINT, toxic INT")

    def means():
        scores = {row.doc_id: row.score for row in toxicity.score_documents(docs, labels).collect()}
        return np.mean([scores[i] for i in odd]), np.mean(list(scores.values()))

    # Given dictionaries, so that the calibration alone can differ.
    apart = toxicity.spaced([word.encode() for word in INSULTS])
    filler = np.random.default_rng(0).integers(1, 32, len(apart), dtype=np.uint8).tobytes()
    with monkeypatch.context() as given:
        given.setattr(toxicity, "dictionaries", lambda sample: (filler, apart))
        whole = means()
        monkeypatch.setattr(toxicity, "SAMPLE_TOXIC", 100)
        monkeypatch.setattr(toxicity, "SAMPLE_ORDINARY", 600)
        sampled = means()
    assert 0.25 < whole[0] < 0.5 and abs(whole[0] - sampled[0]) < 0.12
    assert 0.02 < whole[1] < 0.04 and abs(whole[1] - sampled[1]) < 0.015
    # Without text to learn from, the share of all toxic labels is left.
    bare = docs.selectExpr("doc_id", "'' AS text")
    share = {row.score for row in toxicity.score_documents(bare, labels).collect()}
    assert len(share) == 1 and 0.02 < share.pop() < 0.04


def test_isotonic():
    steps = np.arange(5.0)
    shares = quality.isotonic(steps, np.array([0, 2, 1, 3, 4]), np.array([4, 4, 4, 4, 4]))
    assert shares.tolist() == [0, 0.375, 0.375, 0.75, 1.0]


def test_fourier_features_approximate_the_kernel():
    x = np.random.default_rng(1).normal(size=(40, quality.STATISTICS))
    z = quality.fourier(x, np.zeros(quality.STATISTICS), np.ones(quality.STATISTICS))[:, :-1]
    distance = ((x[:, None] - x[None]) ** 2).sum(-1)
    assert np.abs(z @ z.T - np.exp(-distance / (2 * quality.STATISTICS))).max() < 0.25


def test_statistics_of_odd_texts():
    for text in (b"", b" \n", b"a", b"\xff\xfe", b"x" * 300_000):
        row = quality.statistics(text)
        assert len(row) == quality.STATISTICS and np.isfinite(row).all()
    assert not any(quality.statistics(b" "))
