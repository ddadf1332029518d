"""Benchmark decontamination: BM25 with block-max pruning, then a check of question and answer.

The benchmark is the index, the corpus the queries. Every text is cut into passages of two cells of
words, each cell `CELL` times as long as the longest item of the whole benchmark, passages overlapping by one cell, so that
any item lies whole in one passage, also with a quarter of the longest item's words inserted. For each passage all items with a BM25 score of at least their threshold are
retrieved:

1. WAND bound: the sum of the passage's largest impacts, over all items, has to reach the threshold.
2. Block-max bound: items are in blocks; the sum of largest impacts within a block has to reach it.
3. The items of the blocks left are scored exactly.

An item's impacts are divided by its threshold, so the threshold is 1 for all. It is derived, not
tuned: the item's own score less the largest part of it that words may carry which verification lets
a passage miss. Retrieval therefore loses nothing that verification would accept.

Verification: the passage holds `LEAST_OVERLAP` of the question's five-word shingles and of the
answer's words. The answer is an item's last sentence, or its last quarter if it has only one.

Words are runs of ASCII letters, digits and non-ASCII bytes, A-Z lower-cased. The index goes to the
tasks in parts of bounded size (`PART_ITEMS` items, about `PART_BYTES` of text); each part is one pass
over the documents. Cells and word statistics are those of the whole benchmark, so the parts change no result.

Defined cases: null and empty texts have no passages and no leaks; items that are null or shorter than
`LEAST_WORDS` words are left out, as they cannot be told from ordinary text; of items shorter than `LOOSE_WORDS` all
words must stand one after another; repeated rows are judged
one by one, repeated items are all reported; an empty benchmark finds nothing; only doc_id, item_id and text are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewflow.llm.common import documents, per_batch, stored, utf8

SHINGLE = 5
LEAST_OVERLAP = 0.8
# Items with fewer words say nothing; those with fewer than `LOOSE_WORDS` must stand in a passage word for word.
LEAST_WORDS = 5
LOOSE_WORDS = 8
# Words of a cell for each word of the longest item: a copy with words inserted that is no longer than
# a cell lies within two cells, wherever they begin.
CELL = 1.25

K1, B = 1.2, 0.75
BLOCK_ITEMS = 8
PART_ITEMS = 1024
PART_BYTES = 1 << 20
# Rounding of sums must not lose an item at its threshold.
SLACK = 1e-6

# Bytes other than letters, digits and those of non-ASCII characters part words.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
SENTENCE_END = re.compile(rb"[.!?]+\s+")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def question_and_answer(text: bytes) -> tuple[list[bytes], list[bytes]]:
    ends = [m.end() for m in SENTENCE_END.finditer(text) if words_of(text[m.end() :])]
    if ends and words_of(text[: ends[-1]]):
        return words_of(text[: ends[-1]]), words_of(text[ends[-1] :])
    words = words_of(text)
    cut = max(1, len(words) - max(1, len(words) // 4))
    return words[:cut], words[cut:]


def shingles(words: list[bytes]) -> set[tuple[bytes, ...]]:
    if len(words) < SHINGLE:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(SHINGLE)), strict=False))


@dataclass(frozen=True)
class Statistics:
    """Of all items that are long enough: their number, the words of them and of the longest, and in how
    many of them the words of one part occur."""

    items: int
    words: int
    longest: int
    frequency: dict[bytes, int]


class Index:
    """Inverted index of benchmark items with largest impacts per term and per block.

    The statistics are those of the items themselves, unless they are a part of a benchmark.
    """

    def __init__(self, items: list[tuple[int, str | None]], whole: Statistics | None = None):
        kept = [(item, *question_and_answer((text or "").encode())) for item, text in items]
        kept = sorted((k for k in kept if len(k[1]) + len(k[2]) >= LEAST_WORDS), key=lambda k: k[0])
        self.ids = [item for item, _, _ in kept]
        self.questions = [shingles(q) for _, q, _ in kept]
        self.question_words = [q for _, q, _ in kept]
        self.answers = [Counter(a) for _, _, a in kept]
        self.verbatim = [tuple(q + a) if len(q) + len(a) < LOOSE_WORDS else None for _, q, a in kept]
        bags = [Counter(q + a) for _, q, a in kept]
        lengths = [sum(bag.values()) for bag in bags]
        whole = whole or Statistics(len(bags), sum(lengths), max(lengths, default=1), Counter(term for bag in bags for term in bag))
        self.cell, frequency = math.ceil(CELL * max(1, whole.longest)), whole.frequency
        average = whole.words / max(1, whole.items)
        self.terms = {term: number for number, term in enumerate(sorted({term for bag in bags for term in bag}))}
        self.impacts: list[dict[int, float]] = []
        blocks = -(-len(bags) // BLOCK_ITEMS)
        self.block_max = np.zeros((len(self.terms) + 1, max(1, blocks)), np.float32)
        for number, (bag, (_, question, answer)) in enumerate(zip(bags, kept, strict=True)):
            norm = K1 * (1 - B + B * sum(bag.values()) / average)
            weight = {
                term: math.log(1 + (whole.items - frequency[term] + 0.5) / (frequency[term] + 0.5)) * tf * (K1 + 1) / (tf + norm)
                for term, tf in bag.items()
            }
            threshold = sum(weight.values())
            if self.verbatim[number] is None:
                threshold -= missing_weight(weight, question, answer)
            scale = 1 / max(threshold, 1e-9)
            self.impacts.append({self.terms[term]: w * scale for term, w in weight.items()})
            for term, impact in self.impacts[-1].items():
                place = term, number // BLOCK_ITEMS
                self.block_max[place] = max(self.block_max[place], np.float32(impact))
        self.largest = self.block_max.max(axis=1)

    def passages(self, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Candidates (first cell, block) of texts whose term numbers lie one after another in `ids`.

        `starts` has each text's first cell and, last, the number of cells.
        """
        cells, terms = np.divmod(np.unique(ids), len(self.terms) + 1)
        number = int(starts[-1])
        bound = np.bincount(cells, self.largest[terms].astype(float), number + 1)
        last = np.zeros(number + 1, bool)
        last[starts[1:] - 1] = True
        # A passage is a cell and the next one of the same text, if there is one.
        following = np.where(last[:number], 0.0, bound[1:])
        hot = np.flatnonzero(bound[:number] + following >= 1 - SLACK)
        if not len(hot):
            return hot, hot
        edges = np.searchsorted(cells, np.arange(number + 2))

        def block_bound(cell: int) -> np.ndarray:
            return self.block_max[terms[edges[cell] : edges[cell + 1]]].sum(axis=0)

        first, block = [], []
        for cell in hot:
            total = block_bound(cell) if last[cell] else block_bound(cell) + block_bound(cell + 1)
            for number_of_block in np.flatnonzero(total >= 1 - SLACK):
                first.append(cell)
                block.append(number_of_block)
        return np.array(first, int), np.array(block, int)

    def leaks(self, texts: list[bytes]) -> Iterator[tuple[int, int, float, float, float]]:
        """(text, item, score, question overlap, answer overlap) of the verified items of some texts,
        each item once a text, at its best passage."""
        unknown, per_cell = len(self.terms), self.cell
        if not self.ids:
            return
        get = self.terms.get
        split, keys, starts = [], [], [0]
        for text in texts:
            words = words_of(text)
            split.append(words)
            ids = np.fromiter((get(word, unknown) for word in words), np.int64, len(words))
            cell = starts[-1] + np.arange(len(words)) // per_cell
            known = ids != unknown
            keys.append(cell[known] * (unknown + 1) + ids[known])
            starts.append(starts[-1] + -(-len(words) // per_cell))
        starts = np.array(starts)
        used = np.concatenate([[0], starts[1:][np.diff(starts) > 0]])
        first, block = self.passages(np.concatenate(keys), used) if starts[-1] else (np.array([], int),) * 2
        found: dict[tuple[int, int], tuple[float, float, float]] = {}
        for cell, number in zip(first.tolist(), block.tolist(), strict=True):
            text = int(np.searchsorted(starts, cell, "right")) - 1
            at = (cell - int(starts[text])) * per_cell
            passage = split[text][at : at + 2 * per_cell]
            present = {get(word) for word in passage}
            for item in range(number * BLOCK_ITEMS, min(len(self.ids), (number + 1) * BLOCK_ITEMS)):
                score = sum(impact for term, impact in self.impacts[item].items() if term in present)
                if score >= 1 - SLACK:
                    overlaps = self.overlaps(passage, item)
                    if min(overlaps) >= LEAST_OVERLAP:
                        found[text, item] = max(found.get((text, item), (0.0, 0.0, 0.0)), (score, *overlaps))
        for (text, item), measures in found.items():
            yield (text, self.ids[item], *measures)

    def overlaps(self, passage: list[bytes], item: int) -> tuple[float, float]:
        """Shares of the question's shingles and of the answer's words that the passage holds; of a short item all
        or nothing."""
        whole = self.verbatim[item]
        if whole is not None:
            stands = whole in zip(*(passage[i:] for i in range(len(whole))), strict=False)
            return float(stands), float(stands)
        question, answer = self.questions[item], self.answers[item]
        length = min(SHINGLE, len(self.question_words[item]))
        there = set(zip(*(passage[i:] for i in range(length)), strict=False))
        held = sum((answer & Counter(passage)).values()) / max(1, sum(answer.values())) if answer else 1.0
        return len(question & there) / len(question), held


def missing_weight(weight: dict[bytes, float], question: list[bytes], answer: list[bytes]) -> float:
    """The largest weight of terms that may be absent from a passage which verification accepts.

    Of the question's shingles a fifth may be missing. A missing word takes all shingles it is in; the
    bound is on the sum of them, each shared by five words at most. Of the answer's words a fifth may
    be missing, where a word is missing only with all its occurrences.
    """
    in_shingles = Counter(word for shingle in shingles(question) for word in set(shingle))
    spare = math.floor((1 - LEAST_OVERLAP) * len(shingles(question)) + 1e-9) * min(SHINGLE, max(1, len(question)))
    spare_answer = math.floor((1 - LEAST_OVERLAP) * len(answer) + 1e-9)
    counts = Counter(answer)

    def most(costs: dict[bytes, int], room: int) -> float:
        """Fractional knapsack, an upper bound."""
        total = 0.0
        for word in sorted(costs, key=lambda w: -weight[w] / costs[w]):
            if room <= 0:
                break
            total += weight[word] * min(1.0, room / costs[word])
            room -= costs[word]
        return total

    return most(in_shingles, spare) + most(counts, spare_answer)


def item_terms(part: pa.RecordBatch) -> pa.RecordBatch:
    """The different words of each item, with the item's part."""
    rows = zip(part.column("part").to_pylist(), utf8(part.column("text")), strict=True)
    found = [(number, word) for number, text in rows for word in set(words_of(text))]
    columns = [pa.array([number for number, _ in found], pa.int64()), pa.array([word for _, word in found], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["part", "term"])


def indexes(benchmark: DataFrame) -> Iterator[Index]:
    """Indexes of bounded size that hold all items."""
    items = documents(benchmark, "item_id", "text").where("text IS NOT NULL")
    n, size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    parts = max(1, -(-n // PART_ITEMS), -(-size // PART_BYTES))
    if parts == 1:
        yield Index([(row.item_id, row.text) for row in items.collect()])
        return

    @F.arrow_udf("bigint")
    def n_words(texts: pa.Array) -> pa.Array:
        return pa.array([len(words_of(text)) for text in utf8(texts)], pa.int64())

    items = items.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)))
    items = stored(items.withColumn("words", n_words("text")).where(F.col("words") >= LEAST_WORDS), "benchmark-items")
    n, words, longest = items.agg(F.count("*"), F.coalesce(F.sum("words"), F.lit(0)), F.coalesce(F.max("words"), F.lit(1))).first()
    terms = items.select("part", "text").mapInArrow(per_batch(item_terms), "part BIGINT, term BINARY")
    in_part = terms.groupBy("term", "part").agg(F.count("*").alias("n"))
    every = in_part.groupBy("term").agg(F.sum("n").alias("frequency"))
    in_part = stored(in_part.select("term", "part").join(every, "term"), "benchmark-terms")
    for part in range(parts):
        # The words of a part are bounded by its text.
        frequency = {bytes(row.term): row.frequency for row in in_part.where(F.col("part") == part).collect()}
        rows = items.where(F.col("part") == part).collect()
        yield Index([(row.item_id, row.text) for row in rows], Statistics(n, words, longest, frequency))


SCHEMA = "doc_id BIGINT, item_id BIGINT, score DOUBLE, question_overlap DOUBLE, answer_overlap DOUBLE"


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item that it holds; score 1 is the item's threshold."""

    def searched(index: Index):
        def work(part: pa.RecordBatch) -> pa.RecordBatch | None:
            rows = list(index.leaks(utf8(part.column("text"))))
            if not rows:
                return None
            text, item, score, question, answer = zip(*rows, strict=True)
            ids = part.column("doc_id").cast(pa.int64()).take(pa.array(text, pa.int64()))
            columns = [ids, pa.array(item, pa.int64()), *(pa.array(c, pa.float64()) for c in (score, question, answer))]
            return pa.RecordBatch.from_arrays(columns, [field.split()[0] for field in SCHEMA.split(", ")])

        return per_batch(work)

    slim = documents(docs, "doc_id", "text")
    found = [slim.mapInArrow(searched(index), SCHEMA) for index in indexes(benchmark)]
    result = found[0]
    for more in found[1:]:
        result = result.unionAll(more)
    return result


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, all columns, that hold no benchmark item. No row is shuffled."""

    def leaky(index: Index):
        @F.arrow_udf("boolean")
        def judged(texts: pa.Array) -> pa.Array:
            values = utf8(texts)
            hit = np.zeros(len(values), bool)
            for start in range(0, len(values), 512):
                for text, *_ in index.leaks(values[start : start + 512]):
                    hit[start + text] = True
            return pa.array(hit)

        return judged

    for index in indexes(benchmark):
        docs = docs.where(~leaky(index)(F.col("text")))
    return docs
