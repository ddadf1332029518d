"""Suffix dedup: bytes covered by a string of `LENGTH` bytes that also starts earlier are removed.

Strings are compared as suffixes cut to `LENGTH` bytes, but not all suffixes of the corpus are sorted
together: only those that can be equal meet.

1. Anchors. The anchor of a window of `LENGTH` bytes is its `GRAM`-byte string of least hash, the
   leftmost of equals. Equal windows have equal anchors at the same place. Neighbouring windows with
   one anchor form a segment; about one position in 35 begins one. Tasks send two hashes per segment,
   of the anchor and of the segment's whole text, with its place, and one row for all segments of the
   task that are alike, so a passage in a third of all documents is sent once a task.
2. Per anchor: of segments with equal text all but the earliest repeat earlier strings as a whole. If an
   anchor has segments of different texts, the earliest of each text is asked for its text. What tasks send is dealt
   by ranges of the key, over which anchors are spread evenly; a task receives its share slot by slot and
   holds one slot.
3. Deep-shallow sorting. The windows of the segments of an anchor are suffixes to sort. Multikey
   sorting, eight bytes a step and only among ties, goes to a shallow depth. Groups that are still tied
   have long common prefixes; pairs are compared to the end, larger groups are ordered by a blind trie,
   which branches where strings differ first and looks at nothing between. Suffixes that end in one leaf
   are equal, and all but the earliest repeat.
4. Anchors with more than `MOST_SEGMENTS` different texts, which could fill a task, go another way:
   their windows are compared by 128-bit hashes, in the manner of step 2.
5. What repeats comes back per document as ranges, which are joined with the texts and cut out.

Places are ordered by doc_id (null first) and start. Removed runs are judged on the input.

Defined cases: null and empty texts, and texts shorter than `LENGTH` bytes, lose nothing; rows that
share a doc_id are parts of one document, so of equal strings in them the one with the smaller start
stays, and equal starts both stay; an empty table gives an empty result; only doc_id and text are read.
Texts are sorted whole, in UTF-8 bytes; `dedup_text` drops bytes that no longer form characters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewflow.llm.common import documents, slices, small_reads, stored, utf8
from reviewflow.session import session_settings, source_bytes

# Fixed value of the query's contract.
LENGTH = 100

GRAM = 32
# Segments that a task sends at a time, texts and bytes whose anchors are found at a time.
CHUNK_SEGMENTS = 200_000
# Input whose keys are received together, and the most parts that a task's share is cut into for it.
SLOT_BYTES = 1 << 20
MOST_SLOTS = 8
SLICE_TEXTS = 128
SLICE_BYTES = 1 << 19
# More different texts of one anchor than this are compared by hashes.
MOST_SEGMENTS = 192
# Bytes that multikey sorting looks at, and windows that are sorted at a time.
SHALLOW = 24
SORTED_WINDOWS = 400_000

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
BASE = 0x100000001B3 * 0x9E3779B1 | 1
# An order key is a hash above the position; a text of Spark's is shorter than 2 GiB.
PLACE_BITS = 32
NULL_ID = -(2**63)
# The seed of Spark's xxhash64.
HASH_SEED = 42

# What a written table was shuffled for goes with the end of the write, not with the driver's garbage.
RELEASED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

# A place: document id, hash of its text, start of the first window, number of windows.
PLACE = "doc_id BIGINT, text_hash BIGINT, start INT, windows INT"
SENT = "slot INT, blob BINARY, doc_id BIGINT, text_hash BIGINT, start INT, windows INT"
FOUND = PLACE + ", anchor BIGINT, texts INT"
PLACE_KINDS = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]


def power(n: int) -> np.uint64:
    return np.uint64(pow(BASE, n, 2**64))


def gram_hashes(text: np.ndarray) -> np.ndarray:
    """Hashes of all strings of `GRAM` bytes, a power of two, by doubling."""
    with np.errstate(over="ignore"):
        h = (text.astype(np.uint64) + np.uint64(1)) * MULTIPLIER
        h ^= h >> np.uint64(31)
        length = 1
        while length < GRAM:
            h = h[:-length] * power(length) + h[length:]
            length *= 2
        h = (h ^ (h >> np.uint64(29))) * MULTIPLIER
        return h ^ (h >> np.uint64(32))


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    reach = 1
    result = values
    while 2 * reach <= width:
        result = np.minimum(result[:-reach], result[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(result[: len(result) - rest], result[rest:]) if rest else result


def segments(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Text number, start, windows and anchor key of the segments of some texts."""
    lengths = np.array([len(text) for text in texts], np.int64)
    if int(lengths.sum()) < LENGTH:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    data = np.frombuffer(b"".join(texts), np.uint8)
    hashes = gram_hashes(data)
    place = np.uint64((1 << PLACE_BITS) - 1)
    keys = (hashes & ~place) | np.arange(len(hashes), dtype=np.uint64)
    anchor = (sliding_minimum(keys, LENGTH - GRAM + 1) & place).astype(np.int64)
    ends = np.cumsum(lengths)
    # Windows that reach beyond their text are none.
    start = np.arange(len(anchor))
    owner = np.repeat(np.arange(len(texts)), lengths)[: len(anchor)]
    inside = start + LENGTH <= ends[owner]
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new & inside)
    run = np.cumsum(new) - 1
    windows = np.bincount(run, inside, run[-1] + 1).astype(np.int64)[run[first]]
    number = owner[first]
    # Least hashes lie near zero; multiplied by an odd number, they spread over the ranges that keys are dealt by.
    with np.errstate(over="ignore"):
        key = hashes[anchor[first]] * MULTIPLIER
    return number, first - (ends - lengths)[number], windows, key


def text_hashes(texts: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(text, HASH_SEED) for text in texts), np.uint64, len(texts)).view(np.int64)


def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """doc_id and text, few texts at a time; a very long text comes alone."""
    for part in slices(batches, SLICE_TEXTS):
        ids = part.column("doc_id").cast(pa.int64()).fill_null(NULL_ID).to_numpy()
        texts = utf8(part.column("text"))
        first = size = 0
        for i, text in enumerate(texts):
            if i > first and size + len(text) > SLICE_BYTES:
                yield ids[first:i], texts[first:i]
                first, size = i, 0
            size += len(text)
        if first < len(texts):
            yield ids[first:], texts[first:]


# Keyed places: what is sent, and which of equal ones is the earliest.

KEY = np.dtype([("a", "<u8"), ("b", "<u8"), ("doc_id", "<i8"), ("text_hash", "<i8"), ("start", "<i4"), ("windows", "<i4")])


def sort_keyed(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows ordered by key and place, where a key begins, and which rows come later than its first place."""
    rows = rows[np.lexsort((rows["start"], rows["doc_id"], rows["b"], rows["a"]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows["a"][1:] != rows["a"][:-1]) | (rows["b"][1:] != rows["b"][:-1])
    first = rows[np.flatnonzero(new)[np.cumsum(new) - 1]] if len(rows) else rows
    later = (rows["doc_id"] != first["doc_id"]) | (rows["start"] != first["start"])
    return rows, new, later


def packed(rows: np.ndarray) -> bytes:
    """Rows in the order of places, column by column: all but the hashes compress well."""
    rows = rows[np.lexsort((rows["start"], rows["doc_id"]))]
    hashes = rows["a"].tobytes() + rows["b"].tobytes()
    rest = [np.diff(rows[name], prepend=rows[name].dtype.type(0)).tobytes() for name in ("doc_id", "text_hash", "start")]
    rest.append(rows["windows"].tobytes())
    return len(rows).to_bytes(8, "little") + hashes + zstandard.compress(b"".join(rest), 1)


def unpacked(blob: bytes) -> np.ndarray:
    n = int.from_bytes(blob[:8], "little")
    rows = np.empty(n, KEY)
    rows["a"], rows["b"] = np.frombuffer(blob, "<u8", 2 * n, 8).reshape(2, n)
    rest, at = zstandard.decompress(blob[8 + 16 * n :]), 0
    for name, kind in (("doc_id", "<i8"), ("text_hash", "<i8"), ("start", "<i4")):
        with np.errstate(over="ignore"):
            rows[name] = np.cumsum(np.frombuffer(rest, kind, n, at), dtype=kind)
        at += n * np.dtype(kind).itemsize
    rows["windows"] = np.frombuffer(rest, "<i4", n, at)
    return rows


def place_columns(rows: np.ndarray) -> list[pa.Array]:
    return [pa.array(rows[name], kind) for name, kind in zip(("doc_id", "text_hash", "start", "windows"), PLACE_KINDS, strict=True)]


def joined_runs(rows: np.ndarray) -> np.ndarray:
    """Places that follow one another in a document as one place, so a copied text is one row."""
    if not len(rows):
        return rows
    rows = rows[np.lexsort((rows["start"], rows["text_hash"], rows["doc_id"]))]
    begins = np.ones(len(rows), bool)
    begins[1:] = rows["start"][1:] != rows["start"][:-1] + rows["windows"][:-1]
    begins[1:] |= (rows["doc_id"][1:] != rows["doc_id"][:-1]) | (rows["text_hash"][1:] != rows["text_hash"][:-1])
    runs = rows[begins].copy()
    runs["windows"] = np.add.reduceat(rows["windows"], np.flatnonzero(begins))
    return runs


@dataclass(frozen=True)
class Spread:
    """Ranges of keys: a task receives the slots of a bucket one after another and holds one at a time."""

    buckets: int
    slots: int

    def deal(self, rows: DataFrame) -> DataFrame:
        return rows.repartitionById(self.buckets, F.floor(F.col("slot") / (self.slots // self.buckets)).cast("int")).sortWithinPartitions("slot")


def spread(docs: DataFrame) -> Spread:
    """A bucket for each shuffle partition, with as many slots as bring a slot down to about `SLOT_BYTES` of input."""
    buckets = max(8, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    per_bucket = source_bytes(docs) // (buckets * SLOT_BYTES)
    return Spread(buckets, buckets * max(1, min(MOST_SLOTS, per_bucket)))


def send(rows: np.ndarray, slots: int) -> Iterator[pa.RecordBatch]:
    """The earliest row of each key by slot; the other rows are known to repeat."""
    rows, new, later = sort_keyed(rows)
    names = [field.split()[0] for field in SENT.split(", ")]
    repeated = joined_runs(rows[later])
    if len(repeated):
        slot = pa.array(np.arange(len(repeated)) % slots, pa.int32())
        yield pa.RecordBatch.from_arrays([slot, pa.nulls(len(repeated), pa.binary()), *place_columns(repeated)], names)
    rows = rows[~later]
    edges = (np.arange(1, slots) * (2**64 // slots)).astype(np.uint64)
    cuts = [0, *np.searchsorted(rows["a"], edges), len(rows)]
    blobs = [(i, packed(rows[a:b])) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if a < b]
    for i, blob in blobs:
        none = [pa.nulls(1, kind) for kind in PLACE_KINDS]
        yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([blob], pa.binary()), *none], names)


def receive(different: bool):
    """Places that repeat (anchor null); if asked, the first place of each text of anchors that have
    several, with the number of them."""

    names = [field.split()[0] for field in FOUND.split(", ")]

    def of_slot(blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        rows = np.concatenate([unpacked(blob) for blob in blobs])
        blobs.clear()
        rows, new, later = sort_keyed(rows)
        repeated = joined_runs(rows[later])
        if len(repeated):
            nothing = [pa.nulls(len(repeated), pa.int64()), pa.nulls(len(repeated), pa.int32())]
            yield pa.RecordBatch.from_arrays([*place_columns(repeated), *nothing], names)
        if different:
            begins = np.ones(len(rows), bool)
            begins[1:] = rows["a"][1:] != rows["a"][:-1]
            of = np.cumsum(begins) - 1
            texts = np.bincount(of[new], minlength=int(begins.sum()))[of]
            # All rows at a text's first place: several if rows share a doc_id.
            first = ~later & (texts > 1)
            rows, texts = rows[first], texts[first]
            if len(rows):
                yield pa.RecordBatch.from_arrays(
                    [*place_columns(rows), pa.array(rows["a"].view(np.int64)), pa.array(texts, pa.int32())], names
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs: list[bytes] = []
        of = None
        for batch in batches:
            passed = batch.filter(batch.column("doc_id").is_valid())
            if passed.num_rows:
                nothing = [pa.nulls(passed.num_rows, pa.int64()), pa.nulls(passed.num_rows, pa.int32())]
                yield pa.RecordBatch.from_arrays([*(passed.column(n) for n in names[:4]), *nothing], names)
            for part in slices(iter([batch.filter(batch.column("blob").is_valid())]), SLICE_TEXTS):
                for slot, blob in zip(part.column("slot").to_pylist(), part.column("blob").to_pylist(), strict=True):
                    if slot != of and blobs:
                        yield from of_slot(blobs)
                    of = slot
                    blobs.append(blob)
        if blobs:
            yield from of_slot(blobs)

    return run


def keyed(ids: np.ndarray, hashes: np.ndarray, number, start, windows, a, b) -> np.ndarray:
    rows = np.empty(len(number), KEY)
    rows["a"], rows["b"], rows["start"], rows["windows"] = a, b, start, windows
    rows["doc_id"], rows["text_hash"] = ids[number], hashes[number]
    return rows


def send_segments(slots: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for ids, texts in batches_of(batches):
            number, start, windows, anchor = segments(texts)
            spans = zip(number.tolist(), start.tolist(), (start + windows + LENGTH - 1).tolist(), strict=True)
            digest = xxhash.xxh3_64_intdigest
            whole = np.fromiter((digest(texts[n][s:e]) for n, s, e in spans), np.uint64, len(number))
            held.append(keyed(ids, text_hashes(texts), number, start, windows, anchor, whole))
            if sum(map(len, held)) >= CHUNK_SEGMENTS:
                yield from send(np.concatenate(held), slots)
                held.clear()
        if held:
            yield from send(np.concatenate(held), slots)

    return run


# Texts that are asked for.

ASKED = PLACE + ", anchor BIGINT, texts INT, context BINARY"


def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts of the asked segments, from rows (doc_id, text_hash, text, asked)."""
    names = [field.split()[0] for field in ASKED.split(", ")]
    kinds = [*PLACE_KINDS, pa.int64(), pa.int32(), pa.binary()]
    for part in slices(batches, SLICE_TEXTS):
        rows: list[tuple] = []
        columns = (part.column(c).to_pylist() for c in ("doc_id", "text_hash", "asked"))
        for text, doc_id, text_hash, asked in zip(utf8(part.column("text")), *columns, strict=True):
            for one in asked:
                start, windows = one["start"], one["windows"]
                context = text[start : start + windows + LENGTH - 1]
                rows.append((doc_id, text_hash, start, windows, one["anchor"], one["texts"], context))
        if rows:
            arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names)


def send_windows(slots: int):
    """The windows of segments, keyed by their 128-bit hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for part in slices(batches):
            texts = utf8(part.column("context"))
            windows = part.column("windows").to_numpy()
            number = np.repeat(np.arange(len(texts)), windows)
            offset = np.concatenate([np.arange(w) for w in windows])
            digests = b"".join(
                xxhash.xxh3_128_digest(texts[n][o : o + LENGTH]) for n, o in zip(number.tolist(), offset.tolist(), strict=True)
            )
            a, b = np.frombuffer(digests, "<u8").reshape(-1, 2).T
            ids, hashes = part.column("doc_id").to_numpy(), part.column("text_hash").to_numpy()
            held.append(keyed(ids, hashes, number, part.column("start").to_numpy()[number] + offset, 1, a, b))
            if sum(map(len, held)) >= CHUNK_SEGMENTS:
                yield from send(np.concatenate(held), slots)
                held.clear()
        if held:
            yield from send(np.concatenate(held), slots)

    return run


# Step 3: sorting.


def blind_trie(strings: list[bytes]) -> list[list[int]]:
    """Numbers of the strings, of one length, in the order of the strings; equal ones in one list.

    An inner node is (depth, children by byte); a leaf lists equal strings. A string is led down by the
    branching bytes alone to some leaf; the first difference from that leaf's string tells where it
    branches off. Strings met before go to their leaf at once.
    """
    leaves: dict[bytes, list[int]] = {}
    root: list = [None]
    for number, string in enumerate(strings):
        leaf = leaves.get(string)
        if leaf is not None:
            leaf.append(number)
            continue
        leaf = leaves[string] = [number]
        if root[0] is None:
            root[0] = leaf
            continue
        node = root[0]
        while type(node) is tuple:
            node = node[1].get(string[node[0]]) or next(iter(node[1].values()))
        other = strings[node[0]]
        size = len(string)
        differing = int.from_bytes(string, "big") ^ int.from_bytes(other, "big")
        depth = (8 * size - differing.bit_length()) // 8
        holder, key, node = root, 0, root[0]
        while type(node) is tuple and node[0] < depth:
            holder, key = node[1], string[node[0]]
            node = holder[key]
        if type(node) is tuple and node[0] == depth:
            node[1][string[depth]] = leaf
        else:
            holder[key] = (depth, {other[depth]: node, string[depth]: leaf})
    order: list[list[int]] = []
    stack = [root[0]] if root[0] is not None else []
    while stack:
        node = stack.pop()
        if type(node) is tuple:
            stack.extend(node[1][byte] for byte in sorted(node[1], reverse=True))
        else:
            order.append(node)
    return order


def eight_bytes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as a number whose order is that of the bytes."""
    value = np.zeros(len(data) - 7, np.uint64)
    for i in range(8):
        value = (value << np.uint64(8)) | data[i : len(data) - 7 + i]
    return value


def equal_windows(group: np.ndarray, start: np.ndarray, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Deep-shallow sort of the suffixes that begin at `start`, within their groups.

    Gives the suffixes in order, and a number for each that equal ones share."""
    words = eight_bytes(np.frombuffer(data + bytes(8), np.uint8))
    order = np.lexsort((words[start], group))
    first = np.concatenate([[True], (group[order][1:] != group[order][:-1]) | (words[start[order]][1:] != words[start[order]][:-1])])
    for depth in range(8, SHALLOW, 8):
        run = np.cumsum(first) - 1
        tied = np.flatnonzero(np.bincount(run)[run] > 1)
        if not len(tied):
            break
        # Ties only, and each within its own run, so the runs stay where they are.
        key, of = words[start[order[tied]] + depth], run[tied]
        again = np.lexsort((key, of))
        order[tied] = order[tied][again]
        key, of = key[again], of[again]
        first[tied[1:]] |= (key[1:] != key[:-1]) & (of[1:] == of[:-1])
    begins = np.flatnonzero(first)
    sizes = np.diff([*begins, len(order)])
    # A pair: eight bytes at a time to the end.
    pair = begins[sizes == 2]
    same = np.ones(len(pair), bool)
    for depth in [*range(SHALLOW, LENGTH - 8, 8), LENGTH - 8]:
        same &= words[start[order[pair]] + depth] == words[start[order[pair + 1]] + depth]
    first[pair[~same] + 1] = True
    for at, size in zip(begins[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
        members = order[at : at + size]
        leaves = blind_trie([data[s : s + LENGTH] for s in start[members].tolist()])
        order[at : at + size] = members[[number for leaf in leaves for number in leaf]]
        first[at + np.cumsum([0, *map(len, leaves)])[:-1]] = True
    return order, np.cumsum(first) - 1


def sort_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places that repeat an earlier window, from segments sorted by anchor."""
    names = [field.split()[0] for field in PLACE.split(", ")]
    held: list[tuple] = []
    waiting = 0

    def flush() -> pa.RecordBatch:
        anchors, ids, hashes, starts, windows, texts = zip(*held, strict=True)
        windows = np.array(windows)
        base = np.cumsum([0, *map(len, texts)])[:-1]
        number = np.repeat(np.arange(len(texts)), windows)
        offset = np.arange(len(number)) - np.repeat(np.cumsum(windows) - windows, windows)
        group = np.unique(np.array(anchors), return_inverse=True)[1][number]
        order, value = equal_windows(group, base[number] + offset, b"".join(texts))
        doc_id = np.array(ids, np.int64)[number]
        start = np.array(starts, np.int64)[number] + offset
        # Of equal windows, the earliest.
        order = order[np.lexsort((start[order], doc_id[order], value))]
        begins = np.concatenate([[True], value[1:] != value[:-1]])
        earliest = order[np.flatnonzero(begins)[np.cumsum(begins) - 1]]
        later = np.zeros(len(number), bool)
        later[order] = (doc_id[order] != doc_id[earliest]) | (start[order] != start[earliest])
        # Runs of windows that repeat, within each segment.
        before = np.concatenate([[False], later[:-1]]) & (offset > 0)
        begin = np.flatnonzero(later & ~before)
        run = np.cumsum(later & ~before) - 1
        length = np.bincount(run[later], minlength=len(begin)) if len(begin) else begin
        columns = (doc_id[begin], np.array(hashes, np.int64)[number[begin]], start[begin], length)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, PLACE_KINDS, strict=True)], names)

    for part in slices(batches):
        for row in zip(
            *(part.column(c).to_pylist() for c in ("anchor", "doc_id", "text_hash", "start", "windows", "context")), strict=True
        ):
            if waiting >= SORTED_WINDOWS and row[0] != held[-1][0]:
                yield flush()
                held, waiting = [], 0
            held.append(row)
            waiting += row[4]
    if held:
        yield flush()


# The whole.


def hash_of_text() -> Column:
    """`text_hashes` as a column, without a round of all texts through Python."""
    return F.when(F.col("text").isNull(), int(text_hashes([b""])[0])).otherwise(F.xxhash64("text")).alias("text_hash")


def repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, start, windows): runs of windows that also start earlier."""
    small_reads(docs.sparkSession)
    slim = documents(docs, "doc_id", "text")
    dealt = spread(slim)
    sent = dealt.deal(slim.mapInArrow(send_segments(dealt.slots), SENT))
    with session_settings(docs.sparkSession, RELEASED):
        found = stored(sent.mapInArrow(receive(True), FOUND), "segments")
    place = ["doc_id", "text_hash", "start", "windows"]
    whole = found.where("anchor IS NULL").select(*place)

    # A document's group holds its own segments only.
    asked = found.where("anchor IS NOT NULL").groupBy(F.col("doc_id").alias("of"), F.col("text_hash").alias("hash"))
    asked = asked.agg(F.collect_set(F.struct("start", "windows", "anchor", "texts")).alias("asked"))
    texts = slim.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc_id"), hash_of_text(), "text")
    same = (F.col("doc_id") == F.col("of")) & (F.col("text_hash") == F.col("hash"))
    both = texts.join(asked.hint("shuffle_hash"), same).select("doc_id", "text_hash", "text", "asked")
    with session_settings(docs.sparkSession, RELEASED):
        asked_texts = stored(both.mapInArrow(contexts, ASKED), "segment-texts")

    few = asked_texts.where(F.col("texts") <= MOST_SEGMENTS).repartition("anchor").sortWithinPartitions("anchor")
    ordered = few.mapInArrow(sort_segments, PLACE)
    many = asked_texts.where(F.col("texts") > MOST_SEGMENTS)
    many = dealt.deal(many.mapInArrow(send_windows(dealt.slots), SENT))
    by_hash = many.mapInArrow(receive(False), FOUND).select(*place)
    return whole.unionAll(ordered).unionAll(by_hash)


def removed_spans(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of covered bytes, begin and end, from runs of windows (start, number)."""
    spans: list[list[int]] = []
    for start, windows in sorted(runs):
        end = start + windows + LENGTH - 1
        if spans and start <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], end)
        else:
            spans.append([start, end])
    return [(begin, end) for begin, end in spans]


def kept_bytes(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *(edge for span in spans for edge in span), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def marked(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, text, `rest` (a struct of all other columns), and the runs, null if none."""
    grouped = repeats(docs).groupBy(F.col("doc_id").alias("of"), F.col("text_hash").alias("hash"))
    # A group holds the segments of one document only.
    grouped = grouped.agg(F.collect_list(F.struct("start", "windows")).alias("runs"))
    rest = [F.col(f"`{name}`") for name in docs.columns if name not in ("doc_id", "text")]
    rows = docs.select("doc_id", "text", F.struct(*rest, F.lit(0).alias("-")).alias("rest"))
    rows = rows.select("doc_id", hash_of_text(), "text", "rest")
    same = (F.coalesce("doc_id", F.lit(NULL_ID)) == F.col("of")) & (F.col("text_hash") == F.col("hash"))
    return rows.join(grouped.hint("shuffle_hash"), same, "left").drop("of", "hash")


def dedup_spans(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, SHA-256 of what is kept, and the spans."""
    kinds = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))]
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            rows = []
            columns = (part.column(c).to_pylist() for c in ("doc_id", "runs"))
            for text, doc_id, runs in zip(utf8(part.column("text")), *columns, strict=True):
                spans = removed_spans([(run["start"], run["windows"]) for run in runs or []])
                digest = hashlib.sha256(kept_bytes(text, spans)).hexdigest()
                removed = sum(end - begin for begin, end in spans)
                listed = [{"begin": begin, "end": end} for begin, end in spans]
                rows.append((doc_id, len(text), removed, len(spans), digest, listed))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    schema = "doc_id BIGINT, n_bytes BIGINT, n_removed BIGINT, n_spans BIGINT, kept_sha256 STRING, spans ARRAY<STRUCT<begin: BIGINT, end: BIGINT>>"
    return marked(documents(docs, "doc_id", "text")).select("doc_id", "text", "runs").mapInArrow(digested, schema)


def dedup_text(docs: DataFrame) -> DataFrame:
    """The documents, all columns, without the repeated bytes of `text`."""

    @F.arrow_udf("string")
    def cut(texts: pa.Array, runs: pa.Array) -> pa.Array:
        kept = []
        for text, found in zip(utf8(texts), runs.to_pylist(), strict=True):
            spans = removed_spans([(run["start"], run["windows"]) for run in found or []])
            kept.append(kept_bytes(text, spans).decode("utf-8", "ignore"))
        return pa.array(kept, pa.string())

    rows = marked(docs)
    text = F.when(F.col("runs").isNull(), F.col("text")).otherwise(cut("text", "runs"))
    return rows.select(
        *(
            text.alias(name) if name == "text" else F.col(name) if name == "doc_id" else F.col("rest")[name].alias(name)
            for name in docs.columns
        )
    )
