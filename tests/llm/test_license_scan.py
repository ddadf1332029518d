from __future__ import annotations

import random
import re

from reviewflow.llm import license_scan as op

WORD = re.compile(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute_force(text, templates=op.TEMPLATES):
    """The contract and the method, position by position."""
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    starts, base = [], set()
    for phrase, label in op.BASE_PHRASES.items():
        wanted = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(wanted)] == wanted:
                starts.append(i)
                base.add(label)
    index = op.rare_index(templates)
    best, own = 0.0, set()
    for number, ((label, sentence, _), needed) in enumerate(zip(templates, op.mandatory(templates), strict=True)):
        asked = {p for places in index.postings.values() for t, p in places if t == number}
        for start in range(-len(sentence.split()), len(words)):
            stands = {p: w for p, word, w in index.rare[number] if 0 <= start + p < len(words) and words[start + p] == word}
            share = min(1.0, sum(stands.values()) / index.weight(number))
            # A place with enough weight always has one of the words that are looked up.
            assert share < op.LEAST_SHARE or asked & set(stands)
            if asked & set(stands):
                best = max(best, share)
            there = all(0 <= start + p < len(words) and words[start + p] == w for p, w in needed)
            if share >= op.LEAST_SHARE - 1e-12 and there:
                own.add(label)
    return (
        len(words), len(starts), min(starts, default=None), max(starts, default=None),
        ",".join(sorted(base)), ",".join(sorted(base | own)), round(best, 9),
    )


TEXTS = [
    None, "", " \t\n", "no words of that kind", "MIT License", "cc BY", "cc, by-nc 4.0 and CC by",
    "Released under the MIT License.\nLicensed under the Apache License, Version 2.0.",
    "This work is licensed under the GNU General Public License, version 3. " * 3,
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the Software)",
    "permission is hereby given, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files",
    "hereby granted " * 500 + " mit license", "x" * 100_000 + " apache license " + "word " * 20_000,
    "gnu general public", "licensed under cc by-nc 4.0. licensed under cc by 4.0",
    "apache licenſe K apache license café", "license mit", "granted charge obtaining",
]


def test_equals_brute_force(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id BIGINT, text STRING")
    got = {row.doc_id: row for row in op.scan(docs).collect()}
    for number, text in enumerate(TEXTS):
        row = got[number]
        found = (*tuple(row)[1:7], round(row.score, 9))
        assert found == brute_force(text), number


def test_documents_of_the_tables_equal_brute_force(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    texts = {row.doc_id: row.text for row in docs.collect()}
    for row in op.scan(docs).collect():
        assert (*tuple(row)[1:7], round(row.score, 9)) == brute_force(texts[row.doc_id])


def test_several_licences_in_one_text(spark):
    full = {number: ". ".join(sentence for _, sentence, _ in templates) for number, templates in enumerate([
        op.TEMPLATES, op.TEMPLATES[::-1], [t for t in op.TEMPLATES if t[0] in ("mit-grant", "bsd", "apache-2.0", "gpl-grant")],
    ])}
    # The ordinary words of the index before a short licence of common words.
    idf = {word: weight for places in op.rare_index().rare for _, word, weight in places}
    full[3] = " ".join(sorted(idf, key=lambda word: -idf[word])) + ". Licensed under the GNU General Public License, version 3."
    labels = {row.doc_id: (set(row.labels.split(",")), row.score) for row in op.scan(
        spark.createDataFrame(list(full.items()), "doc_id BIGINT, text STRING")
    ).collect()}
    every = {label for label, _, _ in op.TEMPLATES}
    assert every <= labels[0][0] and every <= labels[1][0]
    assert {"mit-grant", "bsd", "apache-2.0", "gpl-grant"} <= labels[2][0]
    assert "gpl-3.0" in labels[3][0]
    assert all(round(score, 9) == 1 for _, score in labels.values())


def test_templates_are_a_parameter(spark):
    """Whole licence texts as templates, as many as a list of them has."""
    source = random.Random(4)
    vocabulary = [f"term{i}" for i in range(400)] + sorted(op.COMMON)
    sentences = [" ".join(source.choices(vocabulary, k=source.randint(6, 60))) for _ in range(120)]
    templates = tuple((f"own-{i}", s, (" ".join(s.split()[1:3]),)) for i, s in enumerate(sentences) if set(s.split()) - op.COMMON)
    assert all(len(op.rare_index(templates).rare[t]) for t in range(len(templates)))
    texts = [f"before {templates[i][1]} after {templates[i + 1][1]}" for i in range(0, 100, 9)]
    texts += [" ".join(w if source.random() < 0.8 else "other" for w in templates[i][1].split()) for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    for row in op.scan(docs, templates).collect():
        assert (*tuple(row)[1:7], round(row.score, 9)) == brute_force(texts[row.doc_id], templates)


def test_odd_tables(spark):
    schema = "doc_id BIGINT, text STRING, words STRING, labels INT"
    odd = spark.createDataFrame([(None, "mit license", "w", 1), (1, None, None, None), (1, "a", "b", 2), (1, "a", "b", 2)], schema)
    assert sorted((row.n_words, row.labels) for row in op.scan(odd).collect()) == [
        (0, ""), (1, ""), (1, ""), (2, "mit,mit-notice"),
    ]
    assert op.scan(odd.limit(0)).count() == 0


def test_no_python_in_the_plan(spark, tables):
    plan = op.scan(spark.read.parquet(f"{tables}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
