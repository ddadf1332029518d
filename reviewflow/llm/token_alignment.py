"""Alignment of two tokenizers: which tokens of one stand where tokens of the other do.

Each text is encoded as a blank and the text by a byte-level BPE (A) and by a sentencepiece model (B),
which adds the blank itself. Character offsets of A's tokens and the spans of B's tokens cut the text
coarsely; a token that holds a part of a character, such as a byte of a multibyte character or a
byte-fallback token, is cut where its decoded bytes end. Where tokens of both end, a group ends. All
pairs of an A and a B token of one group are linked.

1. Texts are cut before each blank that follows a character other than white space, and between a letter and a mark
   that no token joins. Both tokenizers have a token end there (`cuts` asks their files; texts are encoded whole
   if they have not), so tokens, groups and links of a text are those of its pieces, and a task encodes a piece that
   occurs again once.
2. A task writes its documents in chunks. A chunk has its documents as numbers of pieces, and the id pairs
   of its pieces, each once, with the number of its documents that hold it.
3. The counts of an id pair are summed over the chunks, and the highest count of each A id is found.
4. Each chunk gets the counts of its own id pairs, and its documents sum them up over their pieces.

Nothing but tokenizer files is broadcast, and what a task holds is a chunk: `CHUNK_BYTES` of text, or one
longer text. A pair of very frequent tokens arrives once a chunk.

Defined cases: null and empty texts, and texts whose tokens do not give back the blank and the text byte
by byte, have no tokens: zeros and an empty digest. Their bytes count nowhere. Repeated rows, also those
that share a doc_id or have none, are documents of their own. An empty table gives an empty result. Only
doc_id and text are read. Very long texts are encoded piece by piece, and a piece without blanks whole.
"""

from __future__ import annotations

import gc
import hashlib
import os
import re
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache
from itertools import chain
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewflow.llm.common import documents, over_all_cores, slices, stored

FOLDER = "/opt/tokenizers"
BYTE_LEVEL = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"

# Text of a chunk, texts looked at together, pieces remembered by a worker and the longest of them.
CHUNK_BYTES = 3 << 20
SLICE_TEXTS = 64
REMEMBERED = 130_000
LONGEST_REMEMBERED = 64
# Pieces encoded together, and those of them that make up one text; groups with more links than this are counted by
# distinct ids.
ALIGNED_PIECES = 8192
JOINED_PIECES = 64
LONG_GROUP = 4096
# Documents of a chunk whose pairs are laid out at a time.
COUNTED_TEXTS = 128

META = "▁"
BLANK_AFTER_BLANK = r"(?<=\s) "
APART = "\n"
# Marks that pieces may begin with; an apostrophe is none, since A's splitting pattern takes letters behind it along.
MARKS = ",.;:!?%*#$&\n"
LETTER = "[A-Za-zÀ-ÖØ-öø-ɏΑ-ΡΣ-ώЀ-ҁ]"
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")

CHUNK = "chunk BIGINT, pairs ARRAY<BIGINT>, held ARRAY<INT>, pieces BINARY, texts BINARY"
DIGESTS = "doc_id BIGINT, n_a BIGINT, n_b BIGINT, n_groups BIGINT, n_links BIGINT, n_best BIGINT, count_sum BIGINT, groups_sha256 STRING"


def byte_level_alphabet() -> dict[str, int]:
    """The byte of each character of a byte-level vocabulary: printable bytes are themselves, the others
    follow from 256 on in their order."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [byte for byte in range(256) if byte not in set(plain)]
    return {chr(byte): byte for byte in plain} | {chr(256 + i): byte for i, byte in enumerate(others)}


def byte_ends(begin: np.ndarray, end: np.ndarray, sizes: np.ndarray, owner: np.ndarray, first_byte: np.ndarray) -> np.ndarray:
    """Where tokens end, from their spans in bytes. A token that fills its span ends with it; one that does
    not holds a part of a character, and the decoded bytes from the first byte of its piece on tell where it ends."""
    decoded = np.cumsum(sizes)
    new = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else owner
    before = np.repeat((decoded - sizes)[new], np.diff(np.append(new, len(owner))))
    return np.where(end - begin == sizes, end, first_byte[owner] + decoded - before)


def ranges(sizes: np.ndarray) -> np.ndarray:
    """0 to n - 1 for each size n, one after another."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


class Piece(NamedTuple):
    """What a piece of text adds to its document; its text and links are None if its tokens do not give it back."""

    n_a: int
    n_b: int
    n_groups: int
    groups: str | None  # each with its end mark
    pairs: bytes  # distinct id pairs, as A id * 2**32 + B id
    links: bytes  # how often each is linked


COUNTS = Piece._fields[:3]
NO_PIECE = Piece(0, 0, 0, None, b"", b"")


class Aligner:
    def __init__(self, byte_level: str, pieces: str):
        self.a = tokenizers.Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        alphabet = byte_level_alphabet()
        self.a_bytes = [b""] * self.a.get_vocab_size(with_added_tokens=True)
        for token, number in self.a.get_vocab(with_added_tokens=True).items():
            known = all(c in alphabet for c in token)
            self.a_bytes[number] = bytes(alphabet[c] for c in token) if known else token.encode()
        self.b_bytes = [self.piece_bytes(i) for i in range(self.b.get_piece_size())]
        self.sizes = [np.array([len(part) for part in parts], np.int64) for parts in (self.a_bytes, self.b_bytes)]
        # The text of an A id and of a B id, within a group and at its end.
        self.written = [f"{i}{mark}" for n, marks in zip(map(len, self.sizes), (",|", ",;"), strict=True) for mark in marks for i in range(n)]
        self.blank = self.b.piece_to_id(META)
        self.remembered: dict[str, Piece] = {}
        self.older: dict[str, Piece] = {}
        # B's tokens of what is put before a piece without a blank.
        self.apart = self.b.encode(APART)
        self.cut = self.cuts()

    def piece_bytes(self, number: int) -> bytes:
        piece = self.b.id_to_piece(number)
        byte = BYTE_PIECE.fullmatch(piece) if self.b.is_byte(number) else None
        return bytes([int(byte[1], 16)]) if byte else piece.replace(META, " ").encode()

    def cuts(self) -> re.Pattern | None:
        """Where both tokenizers end a token whatever stands around. A's splitting pattern does where a blank follows
        a visible character, as its tokens have blanks in front only, and where a mark follows a letter. B's merges do
        if no piece holds the two characters side by side; pieces without a blank in front also need a character
        that B keeps apart to be put before them."""
        kept = self.a.normalizer is None and self.a.pre_tokenizer is not None
        probe = self.a.pre_tokenizer.pre_tokenize_str(" a b. c1 d,e") if kept else []
        if [end for _, (_, end) in probe] != [2, 4, 5, 7, 8, 10, 11, 12]:
            return None
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size()) if not self.b.is_byte(i)]
        beside = {pair for piece in pieces if not self.b.is_control(self.b.piece_to_id(piece)) for pair in zip(piece, piece[1:], strict=False)}
        if any(second == META != first for first, second in beside):
            return None
        joined = {second for first, second in beside if first == APART or re.match(LETTER, first)}
        marks = [mark for mark in MARKS if mark not in joined and self.b.encode(APART + mark)[:2] == self.apart]
        # A piece goes on over blanks behind white space and over marks behind other characters than letters.
        mark = re.escape("".join(marks))
        over = BLANK_AFTER_BLANK + (f"|(?<!{LETTER})[{mark}]" if marks else "")
        return re.compile(rf"[\s\S][^ {mark}]*(?:(?:{over})[^ {mark}]*)*")

    def split(self, text: str) -> list[str]:
        """Pieces of a blank and the text; the first begins with the blank."""
        return self.cut.findall(" " + text) if self.cut else [" " + text]

    def runs(self, pieces: list[str]) -> list[int]:
        """Where runs of pieces begin that may be encoded as one text, since it is cut between all of them."""
        begins, size, visible = [], 0, False
        for i, piece in enumerate(pieces):
            if not visible or size >= JOINED_PIECES or piece[0] != " ":
                begins.append(i)
                size = 0
            size += 1
            visible = self.cut is not None and not piece[-1].isspace()
        return begins

    def aligned(self, pieces: list[str]) -> list[Piece]:
        """Pieces, each named once; those met in one of the last two rounds of memory at once."""
        found = list(map(self.remembered.get, pieces))
        wanted = []
        for i in [i for i, known in enumerate(found) if known is None]:
            if (known := self.older.get(pieces[i])) is not None:
                found[i] = self.remembered[pieces[i]] = known
            else:
                wanted.append(i)
        for first in range(0, len(wanted), ALIGNED_PIECES):
            some = wanted[first : first + ALIGNED_PIECES]
            for i, result in zip(some, self.align([pieces[i] for i in some]), strict=True):
                found[i] = result
                if len(pieces[i]) <= LONGEST_REMEMBERED:
                    self.remembered[pieces[i]] = result
            if len(self.remembered) > REMEMBERED:
                self.remembered, self.older = {}, self.remembered
        return found

    def encoded(self, pieces: list[str], edges: np.ndarray, at_byte: np.ndarray, begins: list[int]) -> list[tuple[np.ndarray, ...]]:
        """Per tokenizer: ids, piece numbers and span begins and ends in the bytes of all pieces together. Runs of
        pieces, which begin at `begins`, are encoded as one text."""
        first_byte = edges[begins]
        first_character = np.searchsorted(at_byte, first_byte)
        texts = ["".join(pieces[i:j]) for i, j in zip(begins, [*begins[1:], len(pieces)], strict=True)]

        def flat(ids: list[list[int]], spans: list[list[tuple[int, int]]]) -> tuple[np.ndarray, ...]:
            of = np.repeat(np.arange(len(ids)), list(map(len, ids)))
            numbers = np.fromiter(chain.from_iterable(ids), np.int64, len(of))
            both = np.fromiter(chain.from_iterable(chain.from_iterable(spans)), np.int64, 2 * len(of))
            return numbers, of, both[::2], both[1::2]

        first_piece, last_piece = np.array(begins, np.int64), np.append(begins[1:], len(pieces)).astype(np.int64) - 1

        def owners(begin: np.ndarray, of: np.ndarray) -> np.ndarray:
            """The piece that a token begins in, one of its own text's."""
            within = np.clip(np.searchsorted(edges, begin, "right") - 1, first_piece[of], last_piece[of])
            return np.maximum.accumulate(within)

        # A's offsets are in characters.
        a = self.a.encode_batch(texts, add_special_tokens=False)
        ids, of, begin, end = flat([one.ids for one in a], [one.offsets for one in a])
        begin = at_byte[begin + first_character[of]]
        a_side = (ids, owners(begin, of), begin, at_byte[end + first_character[of]])
        # B's are in bytes of what it was given: a text without the blank that B adds, or one behind `APART`.
        spaced = [text[0] == " " for text in texts]
        given = [text[1:] if blank else APART + text for text, blank in zip(texts, spaced, strict=True)]
        b = self.b.encode(given, num_threads=1, return_type="offset_mapping", return_bytes=True)
        skip = len(self.apart)
        b = [(one["ids"], one["offsets"]) if blank else (one["ids"][skip:], one["offsets"][skip:]) for one, blank in zip(b, spaced, strict=True)]
        # B adds no blank to an empty text.
        ids, of, begin, end = flat([i or [self.blank] for i, _ in b], [o or [(0, 0)] for _, o in b])
        first = np.append(True, of[1:] != of[:-1]) if len(of) else of.astype(bool)
        shift = first_byte[of] + np.where(np.array(spaced)[of], 1, -len(APART))
        begin = np.where(first, first_byte[of], begin + shift)
        return [a_side, (ids, owners(begin, of), begin, end + shift)]

    def given_back(self, data: bytes, edges: np.ndarray, both: list[tuple[np.ndarray, ...]]) -> np.ndarray:
        """Which pieces the decoded bytes of either side's tokens make up."""
        lengths, count = np.diff(edges), len(edges) - 1
        good = np.ones(count, bool)
        for (ids, owner, *_), parts, sizes in zip(both, (self.a_bytes, self.b_bytes), self.sizes, strict=True):
            decoded = list(map(parts.__getitem__, ids.tolist()))
            if b"".join(decoded) == data and (np.bincount(owner, sizes[ids], count) == lengths).all():
                continue
            cuts, at = np.searchsorted(owner, np.arange(count + 1)).tolist(), edges.tolist()
            good &= [b"".join(decoded[i:j]) == data[x:y] for i, j, x, y in zip(cuts, cuts[1:], at, at[1:], strict=False)]
        return good

    def align(self, pieces: list[str]) -> list[Piece]:
        """Tokens, groups and links of pieces, all at once: their bytes lie one after another. A run of pieces of
        which one is not given back is encoded again piece by piece, so that none is told by its neighbours."""
        begins = self.runs(pieces)
        found = self.align_runs(pieces, begins)
        again: list[int] = []
        for i, j in zip(begins, [*begins[1:], len(pieces)], strict=True):
            if j - i > 1 and any(piece.groups is None for piece in found[i:j]):
                again += range(i, j)
        if again:
            for k, piece in zip(again, self.align_runs([pieces[k] for k in again], list(range(len(again)))), strict=True):
                found[k] = piece
        return found

    def align_runs(self, pieces: list[str], begins: list[int]) -> list[Piece]:
        data = "".join(pieces).encode()
        lead = np.frombuffer(data, np.uint8) & 0xC0 != 0x80
        at_byte = np.append(np.flatnonzero(lead), len(data))
        characters = np.fromiter(map(len, pieces), np.int64, len(pieces))
        edges = at_byte[np.append(0, np.cumsum(characters))]
        both = self.encoded(pieces, edges, at_byte, begins)
        good = self.given_back(data, edges, both)
        both = [tuple(column[good[side[1]]] for column in side) for side in both]
        ends = [byte_ends(begin, end, sizes[ids], owner, edges) for (ids, owner, begin, end), sizes in zip(both, self.sizes, strict=True)]
        # Where tokens of both end; the group of a token is the number of such places before its end.
        marked = np.zeros((2, len(data) + 1), bool)
        for side, end in zip(marked, ends, strict=True):
            side[end] = True
        cut = marked[0] & marked[1]
        before = np.cumsum(cut) - cut
        n_groups = int(cut.sum())
        (a_ids, a_owner), (b_ids, b_owner) = (side[:2] for side in both)
        a_group, b_group = (before[end] for end in ends)
        n_a, n_b = np.bincount(a_group, minlength=n_groups), np.bincount(b_group, minlength=n_groups)
        a_first, b_first = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b

        # Written form: A's ids, then B's, group by group.
        last = [np.append(group[1:] != group[:-1], True) if len(group) else group.astype(bool) for group in (a_group, b_group)]
        a_codes = a_ids + len(self.sizes[0]) * last[0]
        b_codes = 2 * len(self.sizes[0]) + b_ids + len(self.sizes[1]) * last[1]
        codes = np.empty(len(a_codes) + len(b_codes), np.int64)
        codes[np.arange(len(a_codes)) + b_first[a_group]] = a_codes
        codes[np.arange(len(b_codes)) + (a_first + n_a)[b_group]] = b_codes
        written = list(map(self.written.__getitem__, codes.tolist()))

        # Links: each A token with its group's B tokens; long groups by distinct ids, so that they stay small.
        group_owner = a_owner[a_first]
        long = n_a * n_b > LONG_GROUP
        ours = np.flatnonzero(~long[a_group])
        repeats = n_b[a_group[ours]]
        theirs = np.repeat(b_first[a_group[ours]], repeats) + ranges(repeats)
        keys = np.repeat(a_ids[ours], repeats) << 32 | b_ids[theirs]
        owner, times = np.repeat(a_owner[ours], repeats), np.ones(len(keys), np.int64)
        for g in np.flatnonzero(long).tolist():
            x, m = np.unique(a_ids[a_first[g] : a_first[g] + n_a[g]], return_counts=True)
            y, n = np.unique(b_ids[b_first[g] : b_first[g] + n_b[g]], return_counts=True)
            keys = np.concatenate([keys, (x[:, None] << 32 | y[None, :]).ravel()])
            times = np.concatenate([times, (m[:, None] * n[None, :]).ravel()])
            owner = np.concatenate([owner, np.full(len(x) * len(y), group_owner[g])])
        # Piece, A id and B id fit into one number.
        widths = list(map(len, self.sizes))
        order = np.argsort((owner * widths[0] + (keys >> 32)) * widths[1] + (keys & (2**32 - 1)))
        keys, owner, times = keys[order], owner[order], times[order]
        if len(keys):
            new = np.append(True, (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1]))
            keys, owner, times = keys[new], owner[new], np.add.reduceat(times, np.flatnonzero(new))

        numbers = np.arange(len(pieces) + 1)
        a_at, b_at, group_at, key_at = (np.searchsorted(of, numbers) for of in (a_owner, b_owner, group_owner, owner))
        token_at = (a_at + b_at).tolist()
        counts = zip(np.diff(a_at).tolist(), np.diff(b_at).tolist(), np.diff(group_at).tolist(), strict=True)
        pairs, links, key_at = keys.tobytes(), times.tobytes(), (8 * key_at).tolist()
        # Most links are single ones; equal texts of them are one object in memory.
        same: dict[bytes, bytes] = {}
        return [
            Piece(*count, "".join(written[token_at[i] : token_at[i + 1]]), pairs[key_at[i] : key_at[i + 1]], same.setdefault(one := links[key_at[i] : key_at[i + 1]], one))
            if good[i]
            else NO_PIECE
            for i, count in enumerate(counts)
        ]


@lru_cache(maxsize=1)
def aligner(folder: str, byte_level: str, pieces: str) -> Aligner:
    """One a worker, in one thread: Spark runs as many tasks as there are cores."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Aligner(str(Path(folder, byte_level)), str(Path(folder, pieces)))


def lists(values: np.ndarray, lengths: list[int] | np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def ipc(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def from_ipc(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


class Chunk:
    """Documents of a task and the pieces they hold, each piece under a number."""

    def __init__(self):
        self.numbers: dict[str, int] = {}
        self.pieces: list[Piece] = []
        self.groups: list[str] = []
        self.bad: set[int] = set()
        self.rows: list[tuple] = []
        self.size = 0

    def add(self, ids: list[int | None], texts: list[str | None], work: Aligner) -> None:
        split = [work.split(text) if text else [] for text in texts]
        new = [piece for piece in set().union(*split) if piece not in self.numbers]
        aligned = work.aligned(new)
        known = len(self.pieces)
        self.numbers.update(zip(new, range(known, known + len(new)), strict=True))
        self.pieces += aligned
        self.groups += [piece.groups or "" for piece in aligned]
        self.bad.update(known + i for i, piece in enumerate(aligned) if piece.groups is None)
        self.size += sum(len(text or "") for text in texts)
        for doc_id, pieces in zip(ids, split, strict=True):
            numbers = list(map(self.numbers.__getitem__, pieces))
            if not numbers or not self.bad.isdisjoint(numbers):
                self.rows.append((doc_id, "", np.empty(0, np.int64), np.empty(0, np.int64)))
                continue
            written = "".join(map(self.groups.__getitem__, numbers))
            digest = hashlib.sha256(written[:-1].encode()).hexdigest()
            self.rows.append((doc_id, digest, *np.unique(np.array(numbers), return_counts=True)))

    def row(self, number: int) -> pa.RecordBatch:
        # Pieces of texts that have no tokens are not used.
        lengths = np.array([len(row[2]) for row in self.rows], np.int64)
        used, numbers = np.unique(np.concatenate([row[2] for row in self.rows]), return_inverse=True)
        pieces = [self.pieces[i] for i in used.tolist()]
        sizes = np.array([len(piece.pairs) // 8 for piece in pieces], np.int64)
        keys = np.frombuffer(b"".join(piece.pairs for piece in pieces), "<i8")
        links = np.frombuffer(b"".join(piece.links for piece in pieces), "<i8")
        pairs, at = np.unique(keys, return_inverse=True)
        held, seen = np.zeros((2, len(pairs)), np.int64)
        begins, ends = np.cumsum(sizes) - sizes, np.append(0, np.cumsum(lengths))
        for first in range(0, len(lengths), COUNTED_TEXTS):
            some = lengths[first : first + COUNTED_TEXTS]
            piece = numbers[ends[first] : ends[first] + some.sum()]
            n = sizes[piece]
            pair = at[np.repeat(begins[piece], n) + ranges(n)]
            of = np.append(0, np.cumsum(n))[np.append(0, np.cumsum(some))].tolist()
            for i, j in zip(of, of[1:], strict=False):
                # Each pair of a document once: where its last place is.
                one, places = pair[i:j], np.arange(i, j)
                seen[one] = places
                held[one[seen[one] == places]] += 1
        per_piece = {"at": lists(at, sizes, pa.int32()), "links": lists(links, sizes, pa.int64())}
        per_piece |= {name: pa.array([piece[i] for piece in pieces], pa.int32()) for i, name in enumerate(COUNTS)}
        per_text = {
            "doc_id": pa.array([row[0] for row in self.rows], pa.int64()),
            "groups_sha256": pa.array([row[1] for row in self.rows], pa.string()),
            "piece": lists(numbers, lengths, pa.int32()),
            "times": lists(np.concatenate([row[3] for row in self.rows]), lengths, pa.int32()),
        }
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()),
                lists(pairs, [len(pairs)], pa.int64()),
                lists(held, [len(pairs)], pa.int32()),
                pa.array([ipc(pa.table(per_piece))], pa.binary()),
                pa.array([ipc(pa.table(per_text))], pa.binary()),
            ],
            [field.split()[0] for field in CHUNK.split(", ")],
        )


def chunked(folder: str, byte_level: str, model: str):
    """The rows of `CHUNK` of a task's documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = aligner(folder, byte_level, model)
        number, chunk = TaskContext.get().partitionId() << 32, Chunk()
        for part in slices(batches, SLICE_TEXTS):
            with no_cycles():
                chunk.add(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), work)
            if chunk.size >= CHUNK_BYTES:
                yield chunk.row(number)
                number, chunk = number + 1, Chunk()
        if chunk.rows:
            yield chunk.row(number)

    return run


@contextmanager
def no_cycles() -> Iterator[None]:
    """Without the search for reference cycles: the pieces remembered are many objects that have none."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


def totals(lengths: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of runs of values; a run may be empty."""
    sums = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(lengths)
    return sums[ends] - sums[ends - lengths]


def summed(chunk: pa.Table, counts: pa.Table) -> pa.Table:
    """The digests of a chunk's documents, from the counts of its pairs."""
    names = [field.split()[0] for field in DIGESTS.split(", ")]
    kinds = [pa.string() if name == "groups_sha256" else pa.int64() for name in names]
    if not chunk.num_rows:
        return pa.table([pa.array([], kind) for kind in kinds], names)
    at = counts.column("at").to_numpy()
    count, best = np.zeros((2, len(at)), np.int64)
    count[at], best[at] = counts.column("count").to_numpy(), counts.column("best").cast(pa.int64()).to_numpy()
    pieces = from_ipc(chunk.column("pieces")[0].as_py()).combine_chunks()
    texts = from_ipc(chunk.column("texts")[0].as_py()).combine_chunks()

    def flat(table: pa.Table, name: str) -> np.ndarray:
        return table.column(name).combine_chunks().flatten().to_numpy().astype(np.int64)

    def lengths(table: pa.Table, name: str) -> np.ndarray:
        return pa.compute.list_value_length(table.column(name)).to_numpy().astype(np.int64)

    pair, links, sizes = flat(pieces, "at"), flat(pieces, "links"), lengths(pieces, "at")
    piece, times, of_text = flat(texts, "piece"), flat(texts, "times"), lengths(texts, "piece")
    of_piece = {name: pieces.column(name).to_numpy().astype(np.int64) for name in COUNTS}
    of_piece |= {name: totals(sizes, links * of) for name, of in (("n_links", 1), ("n_best", best[pair]), ("count_sum", count[pair]))}
    found = {name: totals(of_text, values[piece] * times) for name, values in of_piece.items()}
    return pa.table([pa.array(found[n]) if n in found else texts.column(n) for n in names], names)


def aligned_digests(
    docs: DataFrame, folder: str = FOLDER, byte_level: str = BYTE_LEVEL, pieces: str = PIECES
) -> DataFrame:
    """Per document the columns of `DIGESTS`."""
    slim = over_all_cores(documents(docs, "doc_id", "text"))
    chunks = stored(slim.mapInArrow(chunked(folder, byte_level, pieces), CHUNK), "token-chunks")
    held = chunks.select("chunk", F.posexplode(F.arrays_zip("pairs", "held")).alias("at", "one"))
    held = held.select("chunk", "at", F.col("one.pairs").alias("pair"), F.col("one.held").alias("held"))
    counts = pair_counts(held)
    answers = held.select("chunk", "at", "pair").join(counts, "pair").select("chunk", "at", "count", "best")
    bodies = chunks.select(F.col("chunk").alias("of"), "pieces", "texts")
    return bodies.groupBy("of").cogroup(answers.groupBy("chunk")).applyInArrow(summed, DIGESTS)


def pair_counts(held: DataFrame) -> DataFrame:
    """pair, count of its documents, and whether that is the highest count of its A id."""
    counts = held.groupBy("pair").agg(F.sum("held").alias("count"))
    of_a = Window.partitionBy(F.shiftright("pair", 32))
    return counts.select("pair", "count", (F.col("count") == F.max("count").over(of_a)).alias("best"))


def links(docs: DataFrame, folder: str = FOLDER, byte_level: str = BYTE_LEVEL, pieces: str = PIECES) -> DataFrame:
    """The table of the alignment itself: a_id, b_id, count of documents, best."""
    slim = documents(docs, "doc_id", "text")
    chunks = slim.mapInArrow(chunked(folder, byte_level, pieces), CHUNK)
    held = chunks.select(F.explode(F.arrays_zip("pairs", "held")).alias("one")).select("one.pairs", "one.held")
    counts = pair_counts(held.withColumnRenamed("pairs", "pair"))
    a_id, b_id = F.shiftright("pair", 32).alias("a_id"), F.col("pair").bitwiseAND(F.lit(2**32 - 1)).alias("b_id")
    return counts.select(a_id, b_id, "count", "best")
