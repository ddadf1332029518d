"""Quality rules as a short-circuit cascade.

The base test of the contract comes first. What passes it goes through rules ordered by rejections
per second, both estimated on a sample, so that cheap rules that reject much run before dear ones,
and a document stops at the first rule that rejects it. The order changes the work, never the
verdict: a document is kept if no rule rejects it.

Words are runs of bytes other than blank, tab, line feed, vertical tab, form feed and carriage
return. Defined cases: a null or empty text has no words and fails the base test; repeated rows are
judged one by one; ties between rules keep the order below; an empty table gives an empty result, and
rules then keep the order below; only `doc_id` and `text` are read. A text is judged whole, in the
memory of one task; Arrow batches are cut so that few texts are Python objects at a time.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewflow.llm.common import documents, per_batch, utf8

# Fixed values of the query's contract.
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

# Documents that costs and rejections are estimated on.
SAMPLE_ROWS = 400

BULLETS = ("-", "*", "•", "‣", "·", "–")
ELLIPSES = ("...", "…")


class Document:
    """A text and what several rules ask of it, worked out once and only if asked."""

    def __init__(self, text: bytes):
        self.text = text

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.split()

    @cached_property
    def lines(self) -> list[bytes]:
        """Lines with a word."""
        return [line for line in self.text.split(b"\n") if line.split(None, 1)]

    @cached_property
    def word_chars(self) -> int:
        return len(b"".join(self.words).decode("utf-8", "replace"))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.text) - len(self.text.translate(None, SYMBOLS))

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words in three-word windows that occur twice or more."""
        windows = list(zip(self.words, self.words[1:], self.words[2:], strict=False))
        counts = Counter(windows)
        if len(counts) == len(windows):
            return 0
        repeated, reached = 0, 0
        for at, window in enumerate(windows):
            if counts[window] > 1:
                repeated += at + 3 - max(at, reached)
                reached = at + 3
        return repeated

    @property
    def base_failed(self) -> bool:
        return len(self.words) < LEAST_WORDS or 100 * self.n_repeat_words > MOST_REPEATED_PERCENT * len(self.words)


# Each rule is true for a document to reject. They are asked about documents with words only.


def odd_word_length(doc: Document) -> bool:
    return not 2.0 <= doc.word_chars / len(doc.words) <= 14.0


def many_symbols(doc: Document) -> bool:
    return doc.n_symbols > 0.1 * len(doc.words)


def many_duplicate_lines(doc: Document) -> bool:
    return doc.n_dup_lines > 0.3 * len(doc.lines)


def bullet_list(doc: Document) -> bool:
    starts = tuple(mark.encode() for mark in BULLETS)
    return sum(line.lstrip().startswith(starts) for line in doc.lines) > 0.9 * len(doc.lines)


def many_ellipses(doc: Document) -> bool:
    ends = tuple(mark.encode() for mark in ELLIPSES)
    return sum(line.rstrip().endswith(ends) for line in doc.lines) > 0.3 * len(doc.lines)


NO_LETTER = bytes(b for b in range(128) if not chr(b).isalpha() and b not in b" \t\n\v\f\r")


def few_letters(doc: Document) -> bool:
    """Less than seven words in ten have a letter."""
    return len(doc.text.translate(None, NO_LETTER).split()) < 0.7 * len(doc.words)


def runs_of_a_word(doc: Document) -> bool:
    """More than a fifth of the words repeat the word before them."""
    words = doc.words
    return sum(a == b for a, b in zip(words, words[1:], strict=False)) > 0.2 * len(words)


def one_word_dominates(doc: Document) -> bool:
    return Counter(doc.words).most_common(1)[0][1] > 0.3 * len(doc.words)


Rule = Callable[[Document], bool]
RULES: tuple[Rule, ...] = (
    odd_word_length, many_symbols, many_duplicate_lines, bullet_list, many_ellipses, few_letters, runs_of_a_word,
    one_word_dominates,
)


def measure(docs: DataFrame, rules: tuple[Rule, ...] = RULES, rows: int = SAMPLE_ROWS) -> dict[str, tuple[float, float]]:
    """Per rule, on a sample: seconds per document, and the share of documents that it rejects.

    The sample has `rows` documents as expected, drawn from all of them, of which those count that pass the base test,
    as the rules only see these. One row per rule comes to the driver.
    """

    def timed(part: pa.RecordBatch) -> pa.RecordBatch:
        found = []
        for text in utf8(part.column("text")):
            for rule in rules:
                doc = Document(text)
                doc.words, doc.lines  # noqa: B018  shared by all rules, so no rule is charged for them
                if not doc.base_failed:
                    start = time.perf_counter()
                    rejected = rule(doc)
                    found.append((rule.__name__, time.perf_counter() - start, rejected))
        sums = Counter(name for name, _, _ in found)
        return pa.RecordBatch.from_pylist(
            [
                {
                    "rule": name,
                    "asked": asked,
                    "seconds": sum(s for n, s, _ in found if n == name),
                    "rejected": sum(r for n, _, r in found if n == name),
                }
                for name, asked in sums.items()
            ],
            schema=pa.schema([("rule", pa.string()), ("asked", pa.int64()), ("seconds", pa.float64()), ("rejected", pa.int64())]),
        )

    share = rows / max(1, docs.count())
    sample = documents(docs, "text")
    sample = sample.sample(share, seed=5) if share < 1 else sample
    measured = sample.mapInArrow(per_batch(timed), "rule STRING, asked BIGINT, seconds DOUBLE, rejected BIGINT")
    sums = measured.groupBy("rule").agg(F.sum("asked"), F.sum("seconds"), F.sum("rejected"))
    return {rule: (seconds / asked, rejected / asked) for rule, asked, seconds, rejected in sums.collect()}


def ordered(rules: tuple[Rule, ...], measured: dict[str, tuple[float, float]]) -> tuple[Rule, ...]:
    """Rules by rejections per second, most first."""

    def worth(rule: Rule) -> float:
        seconds, rejected = measured.get(rule.__name__, (1.0, 0.0))
        return rejected / max(seconds, 1e-9)

    return tuple(sorted(rules, key=worth, reverse=True))


SCHEMA = (
    "doc_id BIGINT, n_words BIGINT, word_chars BIGINT, n_symbols BIGINT, n_dup_lines BIGINT, n_repeat_words BIGINT, "
    "base_failed BOOLEAN, kept BOOLEAN, rejected_by STRING"
)


def judge_documents(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per document: the base figures, whether it is kept, and the name of a rule that rejected it.

    `rejected_by` is null for kept documents, `base` where the base test failed; else it names one of
    the rules that reject the document, which may differ from run to run with the order of the rules.
    """
    cascade = ordered(rules, measure(docs, rules))

    def judged(part: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text in utf8(part.column("text")):
            doc = Document(text)
            failed = doc.base_failed
            by = "base" if failed else next((rule.__name__ for rule in cascade if rule(doc)), None)
            rows.append((len(doc.words), doc.word_chars, doc.n_symbols, doc.n_dup_lines, doc.n_repeat_words, failed, by is None, by))
        kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.string()]
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rejected_by"]
        columns = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), *columns], ["doc_id", *names])

    return documents(docs, "doc_id", "text").mapInArrow(per_batch(judged), SCHEMA)
