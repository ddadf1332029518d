"""License scans: a positional index of rare licence words, with DataFrame functions only.

Templates are the telling sentences of well-known licences. Words that occur in few templates are
rare; a word's weight is its IDF among the templates. A place of a file is a template's if the words that stand there as the
template has them carry `LEAST_SHARE` of its weight, and its mandatory phrases stand there, word by word.

Such a place misses less than the rest of the weight, so it has at least one of the template's
highest-IDF words, as many as carry more than that rest, in its position. The index lists at which positions of which
templates these words stand; a file's occurrences of them are looked up, and each tells places where a template would have
to begin. Only these places are weighed and verified, and no place of a licence is lost. Postings, weights and phrases are
literals, one for each word of a template. Everything happens within the row of a file, in time that grows with its words in
the index, and nothing is shuffled.

The base labels of the contract are phrases whose words follow one another.

Defined cases: a null or empty text has no words, no labels, score 0 and null positions; repeated
rows are judged one by one; an empty table gives an empty result; places with equal votes all count;
only doc_id and text are read. Texts are scanned whole.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewflow.llm.common import LOWER, UPPER, documents

# Fixed values of the query's contract.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Label, telling sentence, and the phrases of it that must be there.
TEMPLATES = (
    ("mit-grant",
     "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
     ("permission is hereby granted", "free of charge")),
    ("mit-notice", "released under the mit license", ("mit license",)),
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2",)),
    ("apache-2.0",
     "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis",
     ("required by applicable law", "as is basis")),
    ("gpl-3.0", "licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    ("gpl-2.0", "licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    ("gpl-grant",
     "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
     ("gnu general public license", "free software foundation")),
    ("lgpl", "licensed under the gnu lesser general public license", ("lesser general public license",)),
    ("bsd",
     "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
     ("redistribution and use in source and binary forms", "are permitted provided")),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    ("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0",)),
    ("isc",
     "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
     ("permission to use copy modify", "is hereby granted")),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software",)),
)

# Words too common in any text to be looked up, and bare numbers.
COMMON = frozenset(
    "a an and any are as at be by can for forms free in into is it law met of on or person that the this to under use "
    "v version with without writing you 0 2 3 4".split()
)

LEAST_SHARE = 0.6


class Index(NamedTuple):
    """Per template its rare words as (position, word, weight); postings (template, position) of the words looked up."""

    rare: list[list[tuple[int, str, float]]]
    postings: dict[str, list[tuple[int, int]]]

    def weight(self, template: int) -> float:
        return sum(weight for _, _, weight in self.rare[template])


def rare_index(templates: tuple = TEMPLATES) -> Index:
    sentences = [sentence.split() for _, sentence, _ in templates]
    held = Counter(word for words in sentences for word in set(words) - COMMON)
    idf = {word: math.log(1 + len(sentences) / n) for word, n in held.items()}
    rare = [[(i, word, idf[word]) for i, word in enumerate(words) if word in idf] for words in sentences]
    postings: dict[str, list[tuple[int, int]]] = defaultdict(list)
    for number, places in enumerate(rare):
        rest = (1 - LEAST_SHARE) * sum(weight for _, _, weight in places) + 1e-9
        for position, word, weight in sorted(places, key=lambda place: (-place[2], place[0])):
            if rest < 0:
                break
            postings[word].append((number, position))
            rest -= weight
    return Index(rare, dict(postings))


def mandatory(templates: tuple = TEMPLATES) -> list[list[tuple[int, str]]]:
    """Per template the words that must be there, each with its position in the template."""
    found = []
    for _, sentence, phrases in templates:
        words, places = sentence.split(), []
        for phrase in phrases:
            wanted = phrase.split()
            start = next(i for i in range(len(words)) if words[i : i + len(wanted)] == wanted)
            places += [(start + i, word) for i, word in enumerate(wanted)]
        found.append(places)
    return found


def lowered(text: Column) -> Column:
    """A-Z lower-cased. `lower` does the same for the words here, as no other letter turns into an
    ASCII one but the two named, which are rare."""
    odd = text.contains("K") | text.contains("İ")
    return F.when(odd, F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def words_of(text: Column) -> Column:
    return F.filter(F.split(lowered(F.coalesce(text, F.lit(""))), SEPARATORS), lambda word: word != "")


def stands_at(words: Column, start: Column, wanted: list[str]) -> Column:
    """The wanted words stand one after another from a position on."""
    same = F.get(words, start) == wanted[0]
    for i, word in enumerate(wanted[1:], 1):
        same = same & F.coalesce(F.get(words, start + i) == word, F.lit(False))
    return F.coalesce(same, F.lit(False))


def starts_of(words: Column, wanted: list[str]) -> Callable[[Column], Column]:
    return lambda i: stands_at(words, i, wanted)


def literal_array(values: list, make) -> Column:
    return F.array(*(make(value) for value in values))


def scan(docs: DataFrame, templates: tuple = TEMPLATES) -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score (the largest share of a
    template's weight that a place in question has)."""
    index = rare_index(templates)
    first_words = {phrase.split()[0] for phrase in BASE_PHRASES}
    interesting = sorted(set(index.postings) | first_words)

    rows = documents(docs, "doc_id", "text").select("doc_id", words_of(F.col("text")).alias("words"))
    at = F.transform("words", lambda word, i: F.when(word.isin(*interesting), i))
    rows = rows.withColumn("at", F.filter(at, lambda i: i.isNotNull()))

    words = F.col("words")
    for n, phrase in enumerate(BASE_PHRASES):
        wanted = phrase.split()
        rows = rows.withColumn(f"base{n}", F.filter("at", starts_of(words, wanted)))
    places = F.concat(*(F.col(f"base{n}") for n in range(len(BASE_PHRASES))))
    base = F.array(*(F.when(F.size(f"base{n}") > 0, label) for n, label in enumerate(BASE_PHRASES.values())))
    rows = rows.select(
        "doc_id",
        "words",
        "at",
        F.size("words").cast("long").alias("n_words"),
        F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        F.filter(base, lambda label: label.isNotNull()).alias("base_found"),
    )

    places_of = F.create_map(
        *(
            x
            for word, found in index.postings.items()
            for x in (F.lit(word), literal_array(found, lambda p: F.struct(F.lit(p[0]).alias("t"), F.lit(p[1]).alias("p"))))
        )
    )

    def begins(i: Column) -> Column:
        """Where templates would have to begin for the word at a position."""
        return F.transform(
            F.element_at(places_of, F.get(words, i)), lambda place: F.struct(place["t"].alias("t"), (i - place["p"]).alias("start"))
        )

    looked_up = F.filter("at", lambda i: F.get(words, i).isin(*index.postings))
    rows = rows.withColumn("places", F.array_distinct(F.flatten(F.transform(looked_up, begins))))

    rare = literal_array(
        index.rare,
        lambda places: literal_array(
            places, lambda p: F.struct(F.lit(p[0]).alias("p"), F.lit(p[1]).alias("word"), F.lit(p[2]).alias("weight"))
        ),
    )
    total = literal_array([index.weight(number) for number in range(len(templates))], F.lit)
    needed = literal_array(
        mandatory(templates),
        lambda places: literal_array(places, lambda p: F.struct(F.lit(p[0]).alias("p"), F.lit(p[1]).alias("word"))),
    )

    def verified(t: Column, start: Column) -> Column:
        there = F.forall(
            F.get(needed, t),
            lambda n: F.when(start + n["p"] >= 0, F.coalesce(F.get(words, start + n["p"]) == n["word"], F.lit(False))).otherwise(False),
        )
        return F.coalesce(there, F.lit(False))

    def weighed(place: Column) -> Column:
        """The share of its template's weight that stands at a place."""
        there = F.aggregate(
            F.get(rare, place["t"]),
            F.lit(0.0),
            lambda sum, n: sum + F.when(F.get(words, place["start"] + n["p"]) == n["word"], n["weight"]).otherwise(0.0),
        )
        return there / F.get(total, place["t"])

    shares = F.transform("places", lambda place: F.struct(place["t"].alias("t"), place["start"].alias("start"), weighed(place).alias("share")))
    rows = rows.withColumn("shares", shares)
    stands = F.filter("shares", lambda p: (p["share"] >= LEAST_SHARE - 1e-12) & verified(p["t"], p["start"]))
    label_of = literal_array([label for label, _, _ in templates], F.lit)
    own = F.transform(stands, lambda p: F.get(label_of, p["t"]))
    best = F.coalesce(F.array_max(F.transform("shares", lambda p: p["share"])), F.lit(0.0))

    def joined(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    return rows.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        joined(F.col("base_found")).alias("base_labels"),
        joined(F.concat("base_found", own)).alias("labels"),
        F.least(F.lit(1.0), best).alias("score"),
    )
