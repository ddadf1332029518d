"""Ranked lexical search: the best documents of each item by an integer form of BM25.

1. Vectors. Each document with a term becomes its length and the items' terms it holds with their
   frequencies; the rest of it is not needed again. N, L and the document frequencies are summed from the vectors.
2. Geometric blocks. A task takes its vectors in chunks. In a chunk, the posting list of a term, the documents that
   hold it, is clustered by similarity: random projections of the vectors are compared with those of some
   documents of the list, and each joins the nearest. A block's summary is the coordinatewise maximum of its
   documents' vectors, so no document of the block scores more than the summary does.
3. Search. An item's lists are visited from the one that can add most. A document of a list that holds a term of
   an earlier list has been judged there, so bounds count the terms from this one on. A list, then a block, is
   skipped only if its exact bound is below the tenth best score so far; documents of other blocks are scored in full.
4. A first search over some documents, about `SEED_DOCUMENTS` whatever the table's size, gives each item a score
   that its tenth best document has at least; a wrong guess costs time, no result. All documents are then searched
   from there, each task returns at most the ten best of each item, and these are ranked.

The items are taken in parts of at most about `PART_ITEMS` or `PART_BYTES`, each with a pass over the documents, so
what a task and the driver hold of them is bounded. Blocks and sums are 64-bit integers, so bounds are exact.

Defined cases: a null or empty text, and one without a term, is no document; an item without terms, or whose terms
stand nowhere, has no rows; repeated documents count and are ranked one by one; equal scores go by doc_id, a null one
last; items that repeat as a whole, id and text, are one, and items that share an id are ranked each on its own; empty
tables give an empty result. Only doc_id and text, item_id and text are read. Texts are read whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewflow.llm.common import documents, over_all_cores, slices, stored, utf8

# Fixed values of the query's contract.
BEST = 10
# The bytes of terms: all of UTF-8 but ASCII other than digits and letters, which are lower case here.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
NO_TERM = re.compile(rb"[^0-9a-z\x80-\xff]")

PART_ITEMS = 4096
PART_BYTES = 4 << 20
SEED_DOCUMENTS = 4096
# Documents and entries of a chunk, documents of a block, width of the projections.
CHUNK_DOCUMENTS = 4096
CHUNK_ENTRIES = 400_000
BLOCK_DOCUMENTS = 32
PROJECTION = 32
# A longer text is cut into terms part by part.
TEXT_PART = 1 << 20

VECTOR = "doc_id BIGINT, n BIGINT, terms ARRAY<INT>, times ARRAY<BIGINT>"
HIT = "item INT, doc_id BIGINT, score BIGINT"


def terms_of(text: bytes) -> Counter:
    """Terms and how often they stand in a text."""
    text = text.lower()
    if len(text) <= TEXT_PART:
        return Counter(TERM.findall(text))
    found, at = Counter(), 0
    while at < len(text):
        border = NO_TERM.search(text, min(at + TEXT_PART, len(text)))
        end = border.end() if border else len(text)
        found.update(TERM.findall(text, at, end))
        at = end
    return found


def vectors(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """Rows of `VECTOR` for the documents with a term; the terms are those that have a number."""
    names = [field.split()[0] for field in VECTOR.split(", ")]
    shared = docs.sparkSession.sparkContext.broadcast(numbers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for part in slices(batches):
            rows = []
            for doc_id, text in zip(part.column("doc_id").to_pylist(), utf8(part.column("text")), strict=True):
                found = terms_of(text)
                if found:
                    held = sorted((known[term], times) for term, times in found.items() if term in known)
                    rows.append((doc_id, found.total(), [term for term, _ in held], [times for _, times in held]))
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()))
                columns = [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names)

    return over_all_cores(documents(docs, "doc_id", "text")).mapInArrow(run, VECTOR)


@dataclass
class Item:
    terms: np.ndarray
    repeats: np.ndarray


@dataclass
class Queries:
    """Items and the statistics of the documents, as a task needs them."""

    items: list[Item]
    weights: np.ndarray  # of the terms
    documents: int
    length: int
    least: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # score that the tenth best has at least

    def values(self, terms: np.ndarray, times: np.ndarray, n: np.ndarray) -> np.ndarray:
        """What a term adds to a document's score."""
        m = 100 - 75 + (75 * n * self.documents) // self.length
        return self.weights[terms] * ((1_000_000_000 * times) // (1000 * times + 8 * m))


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def entries_of(rows: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the entries of some rows, and where each row's begin among them."""
    sizes = begins[rows + 1] - begins[rows]
    first = np.cumsum(sizes) - sizes
    return np.arange(sizes.sum()) - np.repeat(first - begins[rows], sizes), first


class Blocks:
    """The posting list of a term in blocks of similar documents, with the blocks' summaries."""

    def __init__(self, rows: np.ndarray, chunk: Chunk):
        centres = rows[:: BLOCK_DOCUMENTS]
        nearest = np.argmax(chunk.sketch[rows] @ chunk.sketch[centres].T, axis=1) if len(centres) > 1 else np.zeros(len(rows), int)
        self.order = rows[np.argsort(nearest, kind="stable")]
        self.begins = np.append(np.searchsorted(np.sort(nearest), np.arange(len(centres))), len(rows))
        self.width = len(chunk.queries.weights)
        at, first = entries_of(rows, chunk.begins)
        sizes = np.diff(np.append(first, len(at)))
        keys = np.repeat(nearest, sizes) * self.width + chunk.terms[at]
        order = np.argsort(keys, kind="stable")
        keys, values = keys[order], chunk.values[at][order]
        new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        self.keys, self.summary = keys[new], np.maximum.reduceat(values, new)

    def bounds(self, terms: np.ndarray, repeats: np.ndarray) -> np.ndarray:
        """The most that a document of each block can score by some terms."""
        wanted = np.arange(len(self.begins) - 1)[:, None] * self.width + terms[None, :]
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return (np.where(self.keys[at] == wanted, self.summary[at], 0) * repeats).sum(axis=1)


class Chunk:
    """Vectors of some documents, and the posting lists of their terms."""

    def __init__(self, begins: np.ndarray, terms: np.ndarray, times: np.ndarray, n: np.ndarray, queries: Queries):
        self.queries, self.begins, self.terms = queries, begins, terms
        sizes = np.diff(begins)
        rows = np.repeat(np.arange(len(n)), sizes)
        self.values = queries.values(terms, times, n[rows])
        by_term = np.argsort(terms, kind="stable")
        self.posted = rows[by_term]
        self.lists = np.searchsorted(terms[by_term], np.arange(len(queries.weights) + 1))
        self.most = np.zeros(len(queries.weights), np.int64)
        np.maximum.at(self.most, terms, self.values)
        # Similarity needs no exactness: signs of the terms by a fixed seed, lengths of one.
        signs = np.random.default_rng(7).choice(np.array([-1, 1], np.float32), (len(queries.weights), PROJECTION))
        self.sketch = np.zeros((len(n), PROJECTION), np.float32)
        full = np.flatnonzero(sizes)
        if len(full):
            self.sketch[full] = np.add.reduceat(signs[terms] * self.values[:, None].astype(np.float32), begins[full])
        self.sketch /= np.linalg.norm(self.sketch, axis=1, keepdims=True) + 1
        self.blocks: dict[int, Blocks] = {}

    def blocks_of(self, term: int) -> Blocks:
        if term not in self.blocks:
            self.blocks[term] = Blocks(self.posted[self.lists[term] : self.lists[term + 1]], self)
        return self.blocks[term]

    def search(self, item: Item, least: int, keep) -> int:
        """Offer all documents that may score `least` or more to `keep`, which returns the new least score."""
        could = self.most[item.terms] * item.repeats
        order = np.argsort(-could, kind="stable")
        terms, repeats = item.terms[order], item.repeats[order]
        rest = np.cumsum(could[order][::-1])[::-1]
        wanted = np.zeros(len(self.most), np.int64)
        wanted[terms] = repeats
        seen = np.zeros(len(self.sketch), bool)
        for i, term in enumerate(terms.tolist()):
            if rest[i] < max(least, 1):
                break
            blocks = self.blocks_of(term)
            bounds = blocks.bounds(terms[i:], repeats[i:])
            for block in np.argsort(-bounds, kind="stable").tolist():
                if bounds[block] < max(least, 1):
                    break
                rows = blocks.order[blocks.begins[block] : blocks.begins[block + 1]]
                rows = rows[~seen[rows]]
                if len(rows):
                    seen[rows] = True
                    at, first = entries_of(rows, self.begins)
                    least = keep(rows, np.add.reduceat(self.values[at] * wanted[self.terms[at]], first))
        return least


class Best:
    """The best documents of an item in a task."""

    def __init__(self, least: int):
        self.least, self.hits = least, []

    def keep(self, ids: list[int | None], scores: np.ndarray) -> int:
        good = np.flatnonzero(scores >= max(self.least, 1)).tolist()
        if good:
            self.hits += [(-int(scores[i]), ids[i] is None, ids[i] or 0) for i in good]
            self.hits = sorted(self.hits)[:BEST]
            if len(self.hits) == BEST:
                self.least = max(self.least, -self.hits[-1][0])
        return self.least


def chunks(batches: Iterator[pa.RecordBatch], queries: Queries) -> Iterator[tuple[Chunk, list[int | None]]]:
    for batch in batches:
        lengths = batch.column("terms").value_lengths().to_numpy().astype(np.int64)
        ends = np.cumsum(lengths)
        first = 0
        while first < batch.num_rows:
            base = ends[first] - lengths[first]
            last = int(np.searchsorted(ends, base + CHUNK_ENTRIES, "right"))
            last = min(max(last, first + 1), first + CHUNK_DOCUMENTS, batch.num_rows)
            part = batch.slice(first, last - first)
            terms, times = (part.column(name).flatten().to_numpy().astype(np.int64) for name in ("terms", "times"))
            begins = np.append(0, ends[first:last] - base)
            yield Chunk(begins, terms, times, part.column("n").to_numpy(), queries), part.column("doc_id").to_pylist()
            first = last


def searched(queries: Queries):
    """The best documents of a task for each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(int(least)) for least in queries.least]
        for chunk, ids in chunks(batches, queries):
            for item, found in zip(queries.items, best, strict=True):

                def keep(rows: np.ndarray, scores: np.ndarray, found: Best = found) -> int:
                    return found.keep([ids[row] for row in rows.tolist()], scores)

                chunk.search(item, found.least, keep)
        rows = [(i, None if none else doc_id, -score) for i, one in enumerate(best) for score, none, doc_id in one.hits]
        if rows:
            columns = zip(zip(*rows, strict=True), (pa.int32(), pa.int64(), pa.int64()), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(*column) for column in columns], [x.split()[0] for x in HIT.split(", ")])

    return run


def ranked(hits: DataFrame) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= BEST)


def search_part(docs: DataFrame, rows: list) -> DataFrame:
    """The ranking of some items, rows of item_id and text."""
    spark = docs.sparkSession
    counted = [terms_of((row.text or "").encode()) for row in rows]
    numbers = {term: i for i, term in enumerate(sorted(set().union(*counted)))}
    found = stored(vectors(docs, numbers), "term-vectors")
    size, length = found.agg(F.count("*"), F.sum("n")).first()
    # At most a row for each term of the part.
    holding = dict(found.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
    weights = np.array([weight(size, holding.get(i, 0)) for i in range(len(numbers))], np.int64)
    items = []
    for one in counted:
        held = sorted((numbers[term], times) for term, times in one.items() if holding.get(numbers[term]))
        items.append(Item(*(np.array([x[i] for x in held], np.int64) for i in (0, 1))))
    queries = Queries(items, weights, size, length or 1, np.zeros(len(items), np.int64))

    share = max(1, size // SEED_DOCUMENTS)
    seeds = found.where(F.pmod(F.xxhash64("doc_id", "n", "terms"), F.lit(share)) == 0)
    # At most ten rows an item.
    for item, least in ranked(seeds.mapInArrow(searched(queries), HIT)).where(F.col("rank") == BEST).select("item", "score").collect():
        queries.least[item] = least
    best = ranked(found.mapInArrow(searched(queries), HIT))
    names = spark.createDataFrame([(i, row.item_id) for i, row in enumerate(rows)], "item INT, item_id BIGINT")
    return best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """item_id, rank, doc_id and score of the ten best documents of each item."""
    items = documents(benchmark, "item_id", "text").distinct()
    size, length = items.agg(F.count("*"), F.sum(F.length("text"))).first()
    parts = max(1, -(-size // PART_ITEMS), -(-(length or 0) // PART_BYTES))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    found = [search_part(docs, items.where(part == i).collect()) for i in range(parts)]
    result = found[0]
    for more in found[1:]:
        result = result.unionAll(more)
    return result
