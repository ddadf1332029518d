"""Line dedup: lines that many documents share stay in one of them.

A line's key is the line without blanks at both ends, A-Z lower-cased. Keys of at least
`LEAST_LENGTH` code points that at least `LEAST_DOCUMENTS` documents hold lose their lines in all
documents but the one with the largest doc_id.

1. Each document gives one small row per distinct key: a 128-bit hash, its id, the line numbers.
2. The rows are range-partitioned by hash and id and sorted by hash and, largest first, by id. Ranges
   cut inside a hot key too, so a line that stands in a third of all documents fills many tasks.
3. Each task streams its rows. A key that begins and ends inside the task is decided there, with a
   buffer of a few rows. The task's first and last key may go on in a neighbour: their rows pass
   undecided, beside one summary row, and are decided by the joined summaries, two per task.
4. What is dropped comes back as one compressed bitmap of kept lines per document, never as text. The
   bitmaps are joined with the documents, which are read again, by id and text hash.

Defined cases: a null or empty text is one empty line; a null doc_id counts as one document, smaller
than all others; rows that share a doc_id are one document when documents are counted, and each keeps
or loses its own lines; an empty table gives an empty result; only `doc_id` and `text` are read,
other columns are carried by `dedup_lines` untouched.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewflow.llm.common import documents, per_batch, stored, utf8

# Fixed values of the query's contract.
LEAST_LENGTH = 40
LEAST_DOCUMENTS = 5
BLANKS = b" \t\n\x0b\x0c\r"

KEYED = "h1 BIGINT, h2 BIGINT, doc_id BIGINT, text_hash BIGINT, lines BINARY"
STREAMED = KEYED + ", decided BOOLEAN, task INT, n_docs BIGINT, first_doc BIGINT, last_doc BIGINT, summary BOOLEAN"


def line_keys(docs: DataFrame, least_length: int = LEAST_LENGTH) -> DataFrame:
    """One row per document and distinct key of enough length: hash, id, text hash, line numbers."""

    def keyed(part: pa.RecordBatch) -> pa.RecordBatch:
        h1, h2, row, held = [], [], [], []
        for i, text in enumerate(utf8(part.column("text"))):
            if len(text) < least_length:
                continue
            at: dict[bytes, list[int]] = {}
            for number, line in enumerate(text.split(b"\n")):
                if len(line) >= least_length:
                    key = line.strip(BLANKS).lower()
                    if len(key) >= least_length and len(key.decode("utf-8", "replace")) >= least_length:
                        at.setdefault(xxhash.xxh3_128_digest(key), []).append(number)
            for digest, numbers in at.items():
                h1.append(int.from_bytes(digest[:8], "big", signed=True))
                h2.append(int.from_bytes(digest[8:], "big", signed=True))
                row.append(i)
                held.append(np.array(numbers, "<u4").tobytes())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(h1, pa.int64()),
                pa.array(h2, pa.int64()),
                part.column("doc_id").cast(pa.int64()).take(pa.array(row, pa.int64())),
                part.column("text_hash").take(pa.array(row, pa.int64())),
                pa.array(held, pa.binary()),
            ],
            ["h1", "h2", "doc_id", "text_hash", "lines"],
        )

    return with_text_hash(documents(docs, "doc_id", "text")).mapInArrow(per_batch(keyed), KEYED)


def with_text_hash(docs: DataFrame) -> DataFrame:
    """Add the hash that tells rows of one doc_id apart."""
    return docs.withColumn("text_hash", F.xxhash64("text"))


def stream_decisions(least_documents: int = LEAST_DOCUMENTS):
    """A task's work on its sorted rows: rows to drop, undecided rows, and summaries of its ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        key = None
        first_key = True
        n_docs, first_doc, last_doc = 0, None, None
        buffer: list[tuple] = []
        out: list[tuple] = []

        def summary() -> tuple:
            return (*key, None, None, None, None, task, n_docs, first_doc, last_doc, True)

        def flush() -> Iterator[pa.RecordBatch]:
            if out:
                columns = list(zip(*out, strict=True))
                kinds = [pa.int64()] * 4 + [pa.binary(), pa.bool_(), pa.int32()] + [pa.int64()] * 3 + [pa.bool_()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    [field.split()[0] for field in STREAMED.split(", ")],
                )
                out.clear()

        for batch in batches:
            h1, h2, ids, hashes, lines = (batch.column(i).to_pylist() for i in range(5))
            for row in zip(h1, h2, ids, hashes, lines, strict=True):
                if key is None or row[:2] != key:
                    if key is not None and first_key:
                        out.append(summary())
                        first_key = False
                    key, n_docs, first_doc = row[:2], 0, row[2]
                    buffer.clear()
                    last_doc = object()
                if row[2] != last_doc:
                    n_docs, last_doc = n_docs + 1, row[2]
                if first_key:
                    # This key may have begun in the task before: hand its rows on.
                    out.append((*row, False, task, None, None, None, False))
                elif n_docs < least_documents:
                    buffer.append(row)
                else:
                    for held in (*buffer, row):
                        if held[2] != first_doc:
                            out.append((*held, True, task, None, None, None, False))
                    # Its largest document is here; if the key goes on, so do its decided rows.
                    buffer.clear()
            yield from flush()
        if key is not None:
            out.append(summary())
            if not first_key:
                # The last key may go on in the next task. Rows in the buffer wait for its count.
                out.extend((*held, False, task, None, None, None, False) for held in buffer)
            yield from flush()

    return run


def dropped_lines(docs: DataFrame, least_length: int = LEAST_LENGTH, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """Rows (doc_id, text_hash, lines) of the lines to drop."""
    keys = stored(line_keys(docs, least_length), "line-keys")
    spread = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = keys.repartitionByRange(spread, "h1", "h2", F.desc_nulls_last("doc_id"))
    ordered = ranged.sortWithinPartitions("h1", "h2", F.desc_nulls_last("doc_id"))
    streamed = stored(ordered.mapInArrow(stream_decisions(least_documents), STREAMED), "line-decisions")
    ends = end_totals(streamed.where("summary"))
    decided = streamed.where("NOT summary AND decided")
    # At most two summaries per task, so their totals are bounded by the number of tasks.
    waiting = streamed.where("NOT summary AND NOT decided").join(F.broadcast(ends), ["h1", "h2"])
    late = waiting.where(F.col("all_docs") >= least_documents).where(~F.col("doc_id").eqNullSafe(F.col("largest")))
    columns = ["doc_id", "text_hash", "lines"]
    return decided.select(*columns).unionAll(late.select(*columns))


def end_totals(summaries: DataFrame) -> DataFrame:
    """Per key at an end of a task: documents over all tasks, and the largest id.

    Tasks are in the order of the rows, so a document cut by a border is the last of one task and the
    first of the next, and is counted once. A key has at most two summaries per task, in order.
    """
    rows = sorted(summaries.select("h1", "h2", "task", "n_docs", "first_doc", "last_doc").collect(), key=lambda r: (r.h1, r.h2, r.task))
    totals: dict[tuple, list] = {}
    for r in rows:
        seen = totals.get((r.h1, r.h2))
        if seen is None:
            totals[r.h1, r.h2] = [r.n_docs, r.first_doc, r.last_doc]
        else:
            seen[0] += r.n_docs - (seen[2] == r.first_doc)
            seen[2] = r.last_doc
    return summaries.sparkSession.createDataFrame(
        [(*key, n, largest) for key, (n, largest, _) in totals.items()],
        "h1 BIGINT, h2 BIGINT, all_docs BIGINT, largest BIGINT",
    )


def pack(drops: list[bytes]) -> bytes:
    """Line numbers to drop as a compressed bitmap of the lines to keep, up to the last to drop."""
    last = max(int(np.frombuffer(numbers, "<u4").max()) for numbers in drops)
    keep = np.ones(8 * (last // 8 + 1), bool)
    for numbers in drops:
        keep[np.frombuffer(numbers, "<u4")] = False
    return zlib.compress(np.packbits(keep).tobytes(), 1)


def unpack(bitmap: bytes | None, n_lines: int) -> np.ndarray:
    if bitmap is None:
        return np.ones(n_lines, bool)
    keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8)).astype(bool)[:n_lines]
    return np.concatenate([keep, np.ones(n_lines - len(keep), bool)])


def keep_bitmaps(docs: DataFrame, least_length: int = LEAST_LENGTH, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """Per document that loses lines: doc_id, text_hash, and the compressed bitmap of kept lines.

    A group has one row per key of one document at most, so it is bounded by the document. Rows that
    repeat id and text have the same lines to drop; their numbers fall together in the bitmap.
    """

    @F.arrow_udf("binary")
    def packed(drops: pa.Array) -> pa.Array:
        return pa.array([pack(numbers) for numbers in drops.to_pylist()], pa.binary())

    drops = dropped_lines(docs, least_length, least_documents)
    grouped = drops.groupBy("doc_id", "text_hash").agg(F.collect_set("lines").alias("drops"))
    return grouped.select("doc_id", "text_hash", packed("drops").alias("bitmap"))


def marked(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """doc_id, text, `rest` (a struct of all other columns), keep_bitmap (null where no line goes).

    Texts are shuffled once, by id; the bitmaps, which are much smaller, are hashed in each task.
    """
    rest = [F.col(f"`{name}`") for name in docs.columns if name not in ("doc_id", "text")]
    rows = docs.select("doc_id", "text", F.struct(*rest, F.lit(0).alias("-")).alias("rest"))
    names = bitmaps.select(F.col("doc_id").alias("of"), F.col("text_hash").alias("hash"), F.col("bitmap").alias("keep_bitmap"))
    same = rows["doc_id"].eqNullSafe(F.col("of")) & F.xxhash64(rows["text"]).eqNullSafe(F.col("hash"))
    return rows.join(names.hint("shuffle_hash"), same, "left").drop("of", "hash")


def kept_text(text: bytes, bitmap: bytes | None) -> tuple[bytes, int, int]:
    """The kept lines joined again, the number of lines, and how many were dropped."""
    if bitmap is None:
        return text, text.count(b"\n") + 1, 0
    lines = text.split(b"\n")
    keep = unpack(bitmap, len(lines))
    return b"\n".join(line for line, kept in zip(lines, keep, strict=True) if kept), len(lines), int((~keep).sum())


def line_digests(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped, and the SHA-256 of what is kept."""

    def digested(part: pa.RecordBatch) -> pa.RecordBatch:
        rows = [kept_text(*pair) for pair in zip(utf8(part.column("text")), part.column("keep_bitmap").to_pylist(), strict=True)]
        return pa.RecordBatch.from_arrays(
            [
                part.column("doc_id").cast(pa.int64()),
                pa.array([n for _, n, _ in rows], pa.int64()),
                pa.array([dropped for _, _, dropped in rows], pa.int64()),
                pa.array([hashlib.sha256(text).hexdigest() for text, _, _ in rows], pa.string()),
            ],
            ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
        )

    slim = documents(docs, "doc_id", "text")
    return marked(slim, keep_bitmaps(slim)).mapInArrow(
        per_batch(digested), "doc_id BIGINT, n_lines BIGINT, n_dropped BIGINT, kept_sha256 STRING"
    )


def dedup_lines(docs: DataFrame, least_length: int = LEAST_LENGTH, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """The documents, all columns, with the repeated lines taken out of `text`."""

    @F.arrow_udf("string")
    def cut(texts: pa.Array, bitmaps: pa.Array) -> pa.Array:
        pairs = zip(utf8(texts), bitmaps.to_pylist(), strict=True)
        return pa.array([kept_text(*pair)[0] for pair in pairs], pa.binary()).cast(pa.string())

    rows = marked(docs, keep_bitmaps(docs, least_length, least_documents))
    text = F.when(F.col("keep_bitmap").isNull(), F.col("text")).otherwise(cut("text", "keep_bitmap"))
    return rows.select(
        *(
            text.alias(name) if name == "text" else F.col(name) if name == "doc_id" else F.col("rest")[name].alias(name)
            for name in docs.columns
        )
    )
