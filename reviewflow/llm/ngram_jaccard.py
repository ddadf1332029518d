"""N-gram Jaccard join: exact links by blocked products of the document by n-gram incidence matrix.

1. Shingles. Each text becomes a set of 64-bit hashes of its five-word shingles. Texts of one set are
   one class, known by a 128-bit digest of the set; everything below works on classes.
2. Survivors. A document that links with another shares four fifths of its shingles with it, so of any
   part of its shingles it shares all but a fifth of the whole. The lowest `FILTER_SHARE` of each set,
   by hash, is compared with everything: tasks send every hash once, however many of their documents
   hold it, so a shingle in a third of all documents is sent once a task. Classes with too few shared
   hashes are done. This also counts the most frequent hashes.
3. Prefixes. The hashes of the survivors are counted, and sets are ordered by (frequent, count, hash).
   Two linked sets share one of their first n - ceil(0.8 n) + 1 hashes in any common order. Hashes that
   no other set has come first and fill the prefix of most sets, which are done. Classes that share a
   hash of their prefixes are put into one group, a connected component of stars around the smallest
   class of each hash; pairs are not enumerated. Common hashes come last, so a passage in many
   documents hardly ever holds a group together, and groups do not flow into one another as the table grows.
4. Products. A group of up to `SMALL_GROUP` classes is one block. A larger one is split: its classes are
   compared with one hub first, then put into blocks by their distance from the hub. A pair of blocks is
   multiplied only if the sizes allow for a link, the distances do (the Jaccard distance is a metric),
   and not all its classes are linked with the hub anyway. A product is accumulated over blocks of
   columns, and of the links it finds, a spanning forest is emitted.
5. Components of these links, and the smallest doc_id of each.

Hash order and hubs decide only what is compared when; every pair of classes that can link is either
compared or already connected, so components are exact (as far as 64-bit hashes are).

Defined cases: a null or empty text, or one without words, has no shingles and is its own component;
rows that share a doc_id are documents of one id, all in the result, each with its component (`keep_one` keeps one row
of a component); a null
doc_id counts for no minimum, and its component is null if it stands alone; an empty table gives an
empty result; only doc_id and text are read. Texts are read whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import ExitStack, contextmanager
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewflow.llm.common import BATCH_ROWS, READER_ROWS, documents, per_batch, slices, small_reads, stored, stored_for, utf8
from reviewflow.llm.components import components
from reviewflow.llm.components import stored as stored_narrow
from reviewflow.session import session_settings

# Fixed values of the query's contract.
SHINGLE = 5
PERCENT = 80

FILTER_SHARE = 0.3
# Hashes that a task sends at a time.
CHUNK_HASHES = 250_000
# Hashes of survivors that a task counts.
BUCKET_HASHES = 1 << 20
# A hash of so many classes is frequent; the bound doubles until so few are.
FREQUENT = 64
MOST_FREQUENT = 1 << 18
# A group of so many classes, if not of too many bytes, is one block. Classes, and bytes of sets, of a
# block of a larger group; columns of a product at a time.
SMALL_GROUP = 128
BLOCK_ROWS = 512
BLOCK_BYTES = 8 << 20
COLUMNS = 1024
# Words whose hash a worker remembers.
REMEMBERED = 100_000

# What a written table was shuffled for goes with the end of the write, not with the driver's garbage.
RELEASED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
# A row of two blocks has megabytes; Spark's number of rows at a time has no regard to bytes.
FEW_BLOCKS = {BATCH_ROWS: "1", READER_ROWS: "4"}
FEW_CHUNKS = {BATCH_ROWS: "8", READER_ROWS: "4"}

MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
STEP = np.uint64(0x9E3779B97F4A7C15)
BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))

_word_hashes: dict[bytes, int] = {}


def shingle_set(text: bytes) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(_word_hashes) > REMEMBERED:
        _word_hashes.clear()
    known, digest = _word_hashes, xxhash.xxh3_64_intdigest
    for word in set(words).difference(known):
        known[word] = digest(word)
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    length = min(SHINGLE, len(words))
    mixed = np.full(len(words) - length + 1, length, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(length):
            mixed = (mixed * STEP) ^ hashes[i : len(words) - length + 1 + i]
            mixed = (mixed ^ (mixed >> np.uint64(29))) * MIX1
        mixed = (mixed ^ (mixed >> np.uint64(27))) * MIX2
    return np.unique(mixed ^ (mixed >> np.uint64(31)))


def class_of(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.tobytes())


def least_overlap(n: int) -> int:
    """How many of its n shingles a set shares with any that it links with, at least."""
    return -(-PERCENT * n // 100)


def prefix_length(n: int) -> int:
    """Of so many first hashes, in any common order, a set shares one with any that it links with."""
    return n - least_overlap(n) + 1


def linked(overlap: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 100 * overlap >= PERCENT * (n + m - overlap)


# Step 2: what each task sends, and what is made of it.

# The hashes sent are the low ones of their sets. They travel under keys that fill the range that is dealt to buckets.


def keys_of(hashes: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return hashes * STEP


def hashes_of(keys: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return keys * BACK


SENT = "bucket INT, doc_id BIGINT, class BINARY, n BIGINT, shared BIGINT, single BINARY, several BINARY"
FACTS = "doc_id BIGINT, class BINARY, n BIGINT, shared BIGINT, hash BIGINT, classes BIGINT, tail BIGINT"


def send_hashes(buckets: int):
    """Rows of documents, and hashes by bucket: those of one class with it, others with their count."""
    names = [field.split()[0] for field in SENT.split(", ")]
    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]

    def flush(ids: list, classes: list, sizes: list, prefixes: list) -> pa.RecordBatch:
        tails = np.array([int.from_bytes(c[:8], "little") for c in classes], np.uint64)
        lengths = np.array([len(p) for p in prefixes], np.int64)
        hashes = keys_of(np.concatenate([*prefixes, np.empty(0, np.uint64)]))
        tail = np.repeat(tails, lengths)
        order = np.lexsort((tail, hashes))
        h, t = hashes[order], tail[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
        of = np.cumsum(np.concatenate([[True], h[1:] != h[:-1]])[: len(h)]) - 1
        classes_of = np.bincount(of, new)
        # Per document, how many of its hashes another class of the chunk has too.
        shared_row = np.empty(len(h), bool)
        shared_row[order] = (classes_of[of] > 1) if len(h) else False
        owner = np.repeat(np.arange(len(prefixes)), lengths)
        shared = np.bincount(owner, shared_row, len(prefixes)).astype(int)
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])[: len(h)])
        one = classes_of == 1
        single_h, single_t = h[first[one]], t[first[one]]
        several_h, several_n = h[first[~one]], classes_of[~one].astype(np.uint64)
        rows = [
            (i % buckets, ids[i], classes[i], sizes[i], int(shared[i]), None, None) for i in range(len(ids))
        ]
        edges = (np.arange(1, buckets) * (2**64 // buckets)).astype(np.uint64)
        cut1 = [0, *np.searchsorted(single_h, edges), len(single_h)]
        cut2 = [0, *np.searchsorted(several_h, edges), len(several_h)]
        for bucket in range(buckets):
            x, y = slice(cut1[bucket], cut1[bucket + 1]), slice(cut2[bucket], cut2[bucket + 1])
            if x.start < x.stop or y.start < y.stop:
                rows.append(
                    (bucket, None, None, None, None, np.stack([single_h[x], single_t[x]]).tobytes(),
                     np.stack([several_h[y], several_n[y]]).tobytes())
                )
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list, list, list, list] = ([], [], [], [])
        waiting = 0
        for part in slices(batches):
            for doc_id, text in zip(part.column("doc_id").to_pylist(), utf8(part.column("text")), strict=True):
                hashes = shingle_set(text)
                n = len(hashes)
                # Below four shingles only equal sets link. A copy, or else the whole set waits with its part.
                prefix = hashes[: math.ceil(FILTER_SHARE * n) if n > 3 else 0].copy()
                for column, value in zip(held, (doc_id, class_of(hashes), n, prefix), strict=True):
                    column.append(value)
                waiting += len(prefix)
                if waiting >= CHUNK_HASHES:
                    yield flush(*held)
                    held, waiting = ([], [], [], []), 0
        if held[0]:
            yield flush(*held)

    return run


def receive_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Passes documents on; of its buckets, gives classes with their shared hashes, and frequent hashes."""
    names = [field.split()[0] for field in FACTS.split(", ")]
    empty = np.empty((2, 0), np.uint64)
    single, several = [empty], [empty]

    def rows(count: int, **columns: pa.Array) -> pa.RecordBatch:
        kinds = dict(zip(names, [pa.int64(), pa.binary(), *[pa.int64()] * 5], strict=True))
        return pa.RecordBatch.from_arrays([columns.get(name, pa.nulls(count, kinds[name])) for name in names], names)

    for batch in batches:
        here = batch.filter(batch.column("class").is_valid())
        if here.num_rows:
            tails = [int.from_bytes(c[:8], "little", signed=True) for c in here.column("class").to_pylist()]
            known = {c: here.column(c) for c in ("doc_id", "class", "n", "shared")}
            yield rows(here.num_rows, **known, tail=pa.array(tails, pa.int64()))
        for held, name in ((single, "single"), (several, "several")):
            for blob in batch.column(name).to_pylist():
                if blob:
                    held.append(np.frombuffer(blob, np.uint64).reshape(2, -1))
    hashes, tails = np.hstack(single)
    single.clear()
    order = np.lexsort((tails, hashes))
    hashes, tails = hashes[order], tails[order]
    del order
    keep = np.ones(len(hashes), bool)
    keep[1:] = (hashes[1:] != hashes[:-1]) | (tails[1:] != tails[:-1])
    hashes, tails = hashes[keep], tails[keep]
    many, counts = np.hstack(several)
    several.clear()
    distinct, of = np.unique(np.concatenate([hashes, many]), return_inverse=True)
    classes = np.bincount(of, np.concatenate([np.ones(len(hashes)), counts.astype(float)]), len(distinct))
    tail, held = np.unique(tails[classes[of[: len(hashes)]] > 1], return_counts=True)
    if len(tail):
        yield rows(len(tail), tail=pa.array(tail.view(np.int64)), shared=pa.array(held.astype(np.int64)))
    frequent = classes >= FREQUENT
    if frequent.any():
        yield rows(
            int(frequent.sum()), hash=pa.array(hashes_of(distinct[frequent]).view(np.int64)), classes=pa.array(classes[frequent].astype(np.int64))
        )


def hash_facts(docs: DataFrame) -> DataFrame:
    """One table of documents (class not null), shared hashes of classes (tail), frequent hashes."""
    buckets = max(8, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sent = documents(docs, "doc_id", "text").mapInArrow(send_hashes(buckets), SENT)
    return stored(sent.repartitionById(buckets, F.col("bucket")).mapInArrow(receive_hashes, FACTS), "shingle-facts")


def frequent_hashes(facts: DataFrame) -> np.ndarray:
    """The most frequent hashes, `MOST_FREQUENT` at most. More would not be wrong, but not bounded."""
    found = facts.where("hash IS NOT NULL")
    bound = FREQUENT
    while found.where(F.col("classes") >= bound).count() > MOST_FREQUENT:
        bound *= 2
    rows = found.where(F.col("classes") >= bound).select("hash").toPandas()
    return np.sort(rows["hash"].to_numpy(np.int64).view(np.uint64))


def survivors(facts: DataFrame) -> DataFrame:
    """doc_id of the classes that may link with another, the smallest of each class.

    Classes meet by eight bytes of their digest. Should two have the same, both survive.
    """
    here = F.col("class").isNotNull()
    # A null id comes last, so a class is found by one of its documents that has an id, if any does.
    found = F.when(here, F.struct("class", F.col("doc_id").isNull().alias("none"), "doc_id"))
    sums = facts.where("tail IS NOT NULL").groupBy("tail").agg(
        F.min(found).alias("first"),
        F.max(F.when(here, F.struct("class", F.col("doc_id").isNotNull().alias("some"), "doc_id"))).alias("last"),
        F.max("n").alias("n"),
        F.max(F.when(here, F.col("shared"))).alias("near"),
        F.sum(F.when(~here, F.col("shared"))).alias("far"),
    )
    needed = F.ceil(F.lit(FILTER_SHARE) * F.col("n")) - (F.col("n") - F.ceil(F.lit(PERCENT / 100) * F.col("n")))
    shared = F.col("near") + F.coalesce(F.col("far"), F.lit(0))
    both = F.when(F.col("first.class") == F.col("last.class"), F.array("first.doc_id")).otherwise(F.array("first.doc_id", "last.doc_id"))
    near = sums.where((F.col("n") > 3) & (shared >= F.greatest(needed - 1, F.lit(1))))
    return near.select(F.explode(both).alias("doc_id"))


# Step 3: sets of the survivors and their groups.


CHUNK = "chunk BIGINT, length BIGINT, classes BINARY, sizes BINARY, hashes BINARY"
COUNTED = "chunk BIGINT, bucket INT, counts BINARY"
ORDERED = "class BINARY, tail BIGINT, n BIGINT, rare BIGINT, hashes BINARY"


def make_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets of texts, some `CHUNK_HASHES` hashes as one row."""
    names = [field.split()[0] for field in CHUNK.split(", ")]
    kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 3]
    first = TaskContext.get().partitionId() << 32
    held: list[np.ndarray] = []
    length = number = 0

    def flush() -> pa.RecordBatch:
        sizes = np.array([len(hashes) for hashes in held], np.int64)
        row = (first + number, length, b"".join(map(class_of, held)), sizes.tobytes(), np.concatenate(held).tobytes())
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)

    for part in slices(batches):
        for text in utf8(part.column("text")):
            hashes = shingle_set(text)
            # A row of one of several texts of an id may be empty.
            if len(hashes):
                held.append(hashes)
                length += len(hashes)
            if length >= CHUNK_HASHES:
                yield flush()
                held, length, number = [], 0, number + 1
    if held:
        yield flush()


def uncounted(hashes: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Which hashes are frequent: sent once already, so nobody asks for their counts again."""
    if not len(frequent):
        return np.zeros(len(hashes), bool)
    return frequent[np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)] == hashes


def send_chunks(buckets: int, frequent: np.ndarray):
    """By bucket, the hashes of a chunk and how many of its sets have them.

    Of a hash only half travels with its bucket. Hashes that are taken for one are counted together, which is
    right: what orders the sets must be the same for all of them, and 1 only for a hash of one set.
    """
    names = [field.split()[0] for field in COUNTED.split(", ")]
    edges = (np.arange(1, buckets) * (2**64 // buckets)).astype(np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1):
            hashes, counts = np.unique(np.frombuffer(part.column("hashes")[0].as_py(), np.uint64), return_counts=True)
            asked = ~uncounted(hashes, frequent)
            hashes, counts = hashes[asked], counts[asked]
            cuts = [0, *np.searchsorted(hashes, edges), len(hashes)]
            sent = [(i, hashes[x:y].astype(np.uint32), counts[x:y].astype(np.uint32)) for i, (x, y) in enumerate(pairwise(cuts)) if x < y]
            if sent:
                columns = [
                    pa.array([part.column("chunk")[0].as_py()] * len(sent), pa.int64()),
                    pa.array([i for i, _, _ in sent], pa.int32()),
                    pa.array([np.concatenate(both).tobytes() for _, *both in sent], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def receive_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In place of the hashes that a chunk sent: how many sets of all chunks have them."""
    batches = list(batches)
    sent = [np.frombuffer(blob, np.uint32).reshape(2, -1) for b in batches for blob in b.column("counts").to_pylist()]
    if not sent:
        return
    buckets = np.concatenate([np.asarray(b.column("bucket")) for b in batches]).astype(np.uint64)
    lengths = [both.shape[1] for both in sent]
    halves, counts = np.hstack(sent)
    # Two buckets may be in one task.
    _, of = np.unique(halves.astype(np.uint64) | (np.repeat(buckets, lengths) << np.uint64(32)), return_inverse=True)
    total = np.minimum(np.bincount(of, counts), 2**32 - 1).astype(np.uint32)[of]
    replies = iter(np.split(total, np.cumsum(lengths)[:-1]))
    for batch in batches:
        blobs = pa.array([next(replies).tobytes() for _ in range(batch.num_rows)], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("chunk"), batch.column("bucket"), blobs], batch.schema.names)


def order_sets(frequent: np.ndarray):
    """The sets of a chunk in the order of counts, those whose prefix has a hash of another set too."""
    names = [field.split()[0] for field in ORDERED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1):
            row = part.to_pylist()[0]
            n, flat = np.frombuffer(row["sizes"], np.int64), np.frombuffer(row["hashes"], np.uint64)
            distinct, of = np.unique(flat, return_inverse=True)
            late = uncounted(distinct, frequent)
            counts = np.full(len(distinct), 2**32, np.int64)
            replies = sorted(row["replies"] or (), key=lambda reply: reply["bucket"])
            counts[~late] = np.frombuffer(b"".join(reply["counts"] for reply in replies), np.uint32)
            owner = np.repeat(np.arange(len(n)), n)
            ranks = counts[of]
            order = np.lexsort((flat, ranks, owner))
            rare = np.bincount(owner, ranks == 1, len(n)).astype(np.int64)
            sets = np.split(flat[order], np.cumsum(n)[:-1])
            stay = np.flatnonzero(rare < [prefix_length(x) for x in n.tolist()])
            classes = [row["classes"][16 * i : 16 * i + 16] for i in stay]
            tails = [int.from_bytes(c[:8], "little", signed=True) for c in classes]
            columns = (classes, tails, n[stay], rare[stay], [sets[i].tobytes() for i in stay])
            kinds = [pa.binary(), *[pa.int64()] * 3, pa.binary()]
            if len(stay):
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return run


@contextmanager
def ordered_sets(docs: DataFrame, facts: DataFrame) -> Iterator[DataFrame]:
    """For a block of code, (class, tail, n, rare, hashes): the survivors' sets that another may link with, their
    `rare` hashes that no other survivor has first, frequent hashes last."""
    frequent = frequent_hashes(facts)
    chosen = stored_narrow(survivors(facts).select(F.col("doc_id").alias("of")), "survivors")
    slim = documents(docs, "doc_id", "text")
    # Catalyst knows the size of what was stored: a few ids are broadcast, many are joined by shuffle.
    texts = slim.join(chosen, F.col("doc_id").eqNullSafe(F.col("of")), "left_semi").select("text")
    with ExitStack() as later:
        with stored_for(texts.mapInArrow(make_chunks, CHUNK), "shingle-sets") as chunks:
            with session_settings(docs.sparkSession, FEW_CHUNKS):
                buckets = max(8, (chunks.agg(F.sum("length")).first()[0] or 0) // BUCKET_HASHES)
                asked = chunks.select("chunk", "hashes").mapInArrow(send_chunks(buckets, frequent), COUNTED)
                counted = stored(asked.repartitionById(buckets, F.col("bucket")).mapInArrow(receive_chunks, COUNTED), "hash-counts")
                replies = counted.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "counts")).alias("replies"))
                answered = chunks.join(replies, "chunk", "left").select("classes", "sizes", "hashes", "replies")
                ordered = later.enter_context(stored_for(answered.mapInArrow(order_sets(frequent), ORDERED), "shingle-sets"))
        yield ordered


def groups(sets: DataFrame) -> DataFrame:
    """(class, label): components of the classes that share a hash of their prefixes.

    Classes go by eight bytes of their digest here; two with the same would only share a group.
    """

    def prefixes(part: pa.RecordBatch) -> pa.RecordBatch:
        owner, found = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for i, (n, rare, blob) in enumerate(zip(*(part.column(c).to_pylist() for c in ("n", "rare", "hashes")), strict=True)):
            prefix = np.frombuffer(blob, np.int64)[rare : prefix_length(n)]
            owner.append(np.full(len(prefix), i))
            found.append(prefix)
        tails = part.column("tail").take(pa.array(np.concatenate(owner)))
        return pa.RecordBatch.from_arrays([tails, pa.array(np.concatenate(found))], ["tail", "hash"])

    with stored_for(sets.mapInArrow(per_batch(prefixes), "tail BIGINT, hash BIGINT"), "prefixes") as rows:
        stars = rows.groupBy("hash").agg(F.min("tail").alias("hub"), F.max("tail").alias("last")).where("hub <> last")
        stars = stored_narrow(stars.select("hash", "hub"), "stars")
        edges = rows.join(stars, "hash").where("tail <> hub").select("tail", "hub").distinct()
        return components(edges, "tail", "hub").select(F.col("node").alias("tail"), "label")


# Step 4: products.


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections: the product of two incidence matrices, by blocks of columns.

    Columns are the hashes that occur on both sides."""
    a, b = np.concatenate(left), np.concatenate(right)
    columns = np.intersect1d(a, b)
    row_a = np.repeat(np.arange(len(left)), [len(x) for x in left])
    row_b = np.repeat(np.arange(len(right)), [len(x) for x in right])

    def entries(values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(columns, values), max(0, len(columns) - 1))
        there = columns[at] == values if len(columns) else np.zeros(len(values), bool)
        order = np.argsort(at[there], kind="stable")
        return at[there][order], rows[there][order]

    (at_a, row_a), (at_b, row_b) = entries(a, row_a), entries(b, row_b)
    total = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, len(columns), COLUMNS):
        block = []
        for at, rows, height in ((at_a, row_a, len(left)), (at_b, row_b, len(right))):
            cut = slice(*np.searchsorted(at, [start, start + COLUMNS]))
            dense = np.zeros((height, min(COLUMNS, len(columns) - start)), np.float32)
            dense[rows[cut], at[cut] - start] = 1
            block.append(dense)
        total += block[0] @ block[1].T
    return np.rint(total).astype(np.int64)


def forest(found: np.ndarray, nodes: list[bytes], others: list[bytes]) -> list[tuple[bytes, bytes]]:
    """Spanning edges of a bipartite matrix of links."""
    parent: dict[bytes, bytes] = {}

    def root(node: bytes) -> bytes:
        while parent.setdefault(node, node) != node:
            parent[node] = parent[parent[node]]
            node = parent[node]
        return node

    kept = []
    for i, j in zip(*np.nonzero(found), strict=True):
        a, b = root(nodes[i]), root(others[j])
        if a != b:
            parent[a] = b
            kept.append((nodes[i], others[j]))
    return kept


BLOCK = "label BIGINT, block STRING, low BIGINT, high BIGINT, near DOUBLE, far DOUBLE, classes BINARY, sizes BINARY, hashes BINARY"
LINK = "left BINARY, right BINARY"


def make_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of sorted rows (label, class, n, hashes, distance) as one row per block."""
    task = TaskContext.get().partitionId()
    names = [field.split()[0] for field in BLOCK.split(", ")]
    held: list[tuple] = []
    size = number = 0

    def flush() -> pa.RecordBatch:
        label, classes, sizes, hashes, distances = zip(*held, strict=True)
        row = (
            label[0], f"{task}-{number}", min(sizes), max(sizes), min(distances), max(distances),
            b"".join(classes), np.array(sizes, np.int64).tobytes(), b"".join(hashes),
        )
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), *[pa.binary()] * 3]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)

    for part in slices(batches):
        for row in zip(*(part.column(c).to_pylist() for c in ("label", "class", "n", "hashes", "distance")), strict=True):
            if held and (row[0] != held[0][0] or len(held) >= BLOCK_ROWS or size + len(row[3]) > BLOCK_BYTES):
                yield flush()
                number += 1
                held, size = [], 0
            held.append(row)
            size += len(row[3])
    if held:
        yield flush()


def opened(classes: bytes, sizes: bytes, hashes: bytes) -> tuple[list[bytes], np.ndarray, list[np.ndarray]]:
    n = np.frombuffer(sizes, np.int64)
    return (
        [classes[i : i + 16] for i in range(0, len(classes), 16)],
        n,
        np.split(np.frombuffer(hashes, np.uint64), np.cumsum(n)[:-1]),
    )


def as_links(found: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([e[i] for e in found], pa.binary()) for i in (0, 1)], ["left", "right"])


def multiply(part: pa.RecordBatch) -> pa.RecordBatch:
    """Links between the two blocks of each row, as spanning edges."""
    found: list[tuple[bytes, bytes]] = []
    for row in part.to_pylist():
        a = opened(row["classes"], row["sizes"], row["hashes"])
        b = opened(row["classes2"], row["sizes2"], row["hashes2"])
        found += forest(linked(overlaps(a[2], b[2]), a[1][:, None], b[1][None, :]), a[0], b[0])
    return as_links(found)


def within(part: pa.RecordBatch) -> pa.RecordBatch:
    """Links of whole groups: each class that has one, with the smallest class of its component."""
    found: list[tuple[bytes, bytes]] = []
    for row in part.to_pylist():
        classes, n, sets = opened(row["classes"], row["sizes"], row["hashes"])
        smallest = {c: c for c in classes}
        for a, b in forest(linked(overlaps(sets, sets), n[:, None], n[None, :]), classes, classes):
            low, high = sorted((smallest[a], smallest[b]))
            smallest.update((c, low) for c, s in smallest.items() if s == high)
        found += [(c, s) for c, s in smallest.items() if c != s]
    return as_links(found)


def links_within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks are multiplied where they are made, one at a time."""
    return per_batch_of(within, 1)(make_blocks(batches))


def links(docs: DataFrame, facts: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(left, right): links between classes whose components are those of all links.

    The first are from small groups and lead to the smallest class of each component; the second, if
    there is a large group, are any."""
    with ordered_sets(docs, facts) as kept:
        grouped = kept.join(stored_narrow(groups(kept), "groups"), "tail")
        rows = stored(grouped.select("label", "class", "n", "hashes"), "grouped-sets")
    sizes = rows.groupBy("label").agg(F.count("*").alias("members"), F.sum(8 * F.col("n")).alias("bytes"))
    large = stored_narrow(sizes.where((F.col("members") > SMALL_GROUP) | (F.col("bytes") > BLOCK_BYTES)).select("label"), "large-groups")
    order = ["label", "distance", "n", "class"]
    columns = ["label", "class", "n", "hashes", "distance"]
    small = rows.join(large, "label", "left_anti").withColumn("distance", F.lit(0.0)).select(columns)
    near_links = small.repartition("label").sortWithinPartitions(*order).mapInArrow(links_within, LINK)
    return near_links, None if large.isEmpty() else large_links(rows.join(large, "label", "left_semi"), order, columns)


def large_links(big: DataFrame, order: list[str], columns: list[str]) -> DataFrame:
    """Links of groups of many blocks."""
    # The hub of a group is a class of its most frequent size; any class would be right.
    counted = big.groupBy("label", "n").agg(F.count("*").alias("members"), F.min("class").alias("class"))
    hubs = counted.groupBy("label").agg(F.max_by("class", F.struct("members", "n")).alias("hub"))
    hubs = stored_narrow(hubs.select(F.col("label").alias("of"), "hub"), "hubs")
    hub_sets = big.join(hubs, (F.col("label") == F.col("of")) & (F.col("class") == F.col("hub")))
    # Rows that repeat a class are alike.
    hub_sets = hub_sets.groupBy("of", "hub").agg(F.min("n").alias("hub_n"), F.min("hashes").alias("hub_hashes"))
    hub_sets = stored(hub_sets, "hub-sets")

    @F.arrow_udf("bigint")
    def overlap(left: pa.Array, right: pa.Array) -> pa.Array:
        counts = []
        for a, b in zip(left.to_pylist(), right.to_pylist(), strict=True):
            pair = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            counts.append(len(np.intersect1d(*pair, assume_unique=True)))
        return pa.array(counts, pa.int64())

    union = F.col("n") + F.col("hub_n") - F.col("overlap")
    near = big.join(hub_sets, F.col("label") == F.col("of")).withColumn("overlap", overlap("hashes", "hub_hashes"))
    linked_with_hub = (100 * F.col("overlap") >= PERCENT * union).alias("linked")
    near = near.select("label", "class", "n", "hashes", "hub", linked_with_hub, (1 - F.col("overlap") / union).alias("distance"))
    spread = int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    with stored_for(near, "hub-distances") as kept:
        hub_links = stored(kept.where("linked").select(F.col("class").alias("left"), F.col("hub").alias("right")), "hub-links")
        ranged = kept.select(columns).repartitionByRange(spread, *order).sortWithinPartitions(*order)
        blocks = stored(ranged.mapInArrow(make_blocks, BLOCK), "blocks")
    outline = blocks.select("label", "block", "low", "high", "near", "far")
    other = outline.select("label", *(F.col(c).alias(f"{c}2") for c in ("block", "low", "high", "near", "far")))
    gap = 1 - PERCENT / 100 + 1e-9
    pairs = outline.join(other, "label").where("block <= block2")
    pairs = pairs.where((100 * F.col("high") >= PERCENT * F.col("low2")) & (100 * F.col("high2") >= PERCENT * F.col("low")))
    pairs = pairs.where((F.col("near2") - F.col("far") <= gap) & (F.col("near") - F.col("far2") <= gap))
    # Classes no further than a fifth from the hub are linked with it, and so with one another.
    pairs = stored(pairs.where((F.col("far") > gap) | (F.col("far2") > gap)).select("block", "block2"), "block-pairs")
    blobs = blocks.select("block", "classes", "sizes", "hashes")
    second = blobs.select(*(F.col(c).alias(f"{c}2") for c in blobs.columns))
    filled = pairs.join(blobs, "block").join(second, "block2").select(*PRODUCT)
    # In tasks of Spark's own size: the few that write edges would each get many blocks.
    with session_settings(big.sparkSession, FEW_BLOCKS):
        products = stored(filled.mapInArrow(per_batch_of(multiply, 1), LINK), "links")
    return products.union(hub_links)


PRODUCT = ["classes", "sizes", "hashes", "classes2", "sizes2", "hashes2"]


def per_batch_of(work, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, rows):
            out = work(part)
            if out.num_rows:
                yield out

    return run


def join_near_duplicates(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, class (a digest of its set), label (a class of its component)."""
    small_reads(docs.sparkSession)
    with session_settings(docs.sparkSession, RELEASED):
        facts = hash_facts(docs)
        solved, open_links = links(docs, facts)
        labels = solved.select(F.col("left").alias("of"), F.col("right").alias("label"))
        if open_links is not None:
            found = components(open_links, "left", "right")
            labels = labels.union(found.select(F.col("node").alias("of"), "label"))
        labels = stored(labels, "class-labels")
    every = facts.where("class IS NOT NULL").select("doc_id", "class", F.col("n").alias("n_shingles"))
    # The smallest id of each component, summed up in each task first. Labels have one row per class.
    named = every.join(labels, F.col("class") == F.col("of"), "left")
    named = named.select("doc_id", "class", "n_shingles", F.coalesce("label", "class").alias("label"))
    lowest = named.where("n_shingles > 0").groupBy("label").agg(F.min("doc_id").alias("component"))
    lowest = stored_narrow(lowest.select(F.col("label").alias("name"), "component"), "component-ids")
    rows = named.join(lowest, F.col("label") == F.col("name"), "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id"), "class", "label")


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents, all columns, of which one row of each component stays: that with the smallest id (a null one
    last), of these the one whose set has the smallest digest, and of rows of one id and set any one.

    A document without shingles is alone in its component and stays.
    """
    rows = stored(join_near_duplicates(docs).select("doc_id", "n_shingles", "class", "label"), "near-duplicates")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "class")).alias("best")
    best = rows.where("n_shingles > 0").groupBy("label").agg(best).select("best.doc_id", "best.class")
    best = stored(best, "kept-classes")
    # An id is clear if it has one row; which of several rows stays is told by their texts.
    ids = rows.groupBy("doc_id").agg(((F.count("*") == 1) & F.col("doc_id").isNotNull()).alias("clear"), (F.max("n_shingles") == 0).alias("bare"))
    stay = ids.join(best.select(F.col("doc_id").alias("of")).distinct(), F.col("doc_id").eqNullSafe(F.col("of")), "left")
    stay = stay.where("of IS NOT NULL OR bare OR NOT clear").select(F.col("doc_id").alias("of"), F.col("clear").alias("is_clear"))
    stay = stored(stay, "kept-ids")
    # Whole rows in one column, so that no name of theirs clashes.
    whole = docs.select(F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"))
    kept = whole.join(stay.hint("shuffle_hash"), F.col("row.doc_id").eqNullSafe(F.col("of")))

    def opened(rows: DataFrame) -> DataFrame:
        return rows.select(*(F.col("row")[name].alias(name) for name in docs.columns))

    if stay.where("NOT is_clear").isEmpty():
        return opened(kept)

    @F.arrow_udf("binary")
    def class_of_text(texts: pa.Array) -> pa.Array:
        sets = [shingle_set(text) for text in utf8(texts)]
        return pa.array([class_of(hashes) if len(hashes) else None for hashes in sets], pa.binary())

    told = kept.where("NOT is_clear").select("row", F.col("row.doc_id").alias("id"), class_of_text(F.col("row.text")).alias("set"))
    same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("set") == F.col("class"))
    one = told.where("set IS NOT NULL").join(best, same, "left_semi").dropDuplicates(["id", "set"])
    return opened(kept.where("is_clear")).unionAll(opened(one)).unionAll(opened(told.where("set IS NULL")))
