"""Token alignment against whole texts, encoded and cut by decoded bytes alone."""

from __future__ import annotations

import hashlib
import random
from bisect import bisect_left
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

from reviewflow.llm import token_alignment as alignment
from reviewflow.llm.common import read

if not Path(alignment.FOLDER, alignment.PIECES).exists():
    pytest.skip("no tokenizer files", allow_module_level=True)

TEXTS = [
    "The quick brown fox\njumps over  the lazy dog. 12345 it's",
    "",
    None,
    " ",
    "a ",
    "  two  blanks  ",
    "héllo ☃𝄞 wörld 👩‍👩‍👧 日本語のテキスト\n\n x  y",
    "holds ▁ the mark",
    "<|endoftext|> <s> </s> <unk> <0x41> plain",
    "\x00\x1c\x85 　 odd \x1f blanks\t\r\n   z",
    "The quick brown fox",
    "The quick brown fox",
    "ab" * 3000,
    "word " * 4000,
    "ﬁ Å ½ é é",
]


def expected(texts):
    work = alignment.aligner(alignment.FOLDER, alignment.BYTE_LEVEL, alignment.PIECES)
    rows, held = [], Counter()
    for text in texts:
        groups = []
        if text:
            full = (" " + text).encode()
            a_ids = work.a.encode(" " + text, add_special_tokens=False).ids
            b_ids = work.b.encode(text)
            a_parts, b_parts = [work.a_bytes[i] for i in a_ids], [work.b_bytes[i] for i in b_ids]
            if b"".join(a_parts) == full == b"".join(b_parts):
                ends = []
                for parts in (a_parts, b_parts):
                    at, found = 0, []
                    for part in parts:
                        at += len(part)
                        found.append(at)
                    ends.append(found)
                cuts = sorted(set(ends[0]) & set(ends[1]))
                sides = []
                for ids, ended in zip((a_ids, b_ids), ends, strict=True):
                    of = defaultdict(list)
                    for i, e in zip(ids, ended, strict=True):
                        of[bisect_left(cuts, e)].append(i)
                    sides.append(of)
                groups = [(sides[0][i], sides[1][i]) for i in range(len(cuts))]
        links = Counter((a, b) for left, right in groups for a in left for b in right)
        held.update(links.keys())
        rows.append((groups, links))
    best = defaultdict(int)
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    out = []
    for groups, links in rows:
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append(
            (
                sum(len(a) for a, _ in groups),
                sum(len(b) for _, b in groups),
                len(groups),
                sum(links.values()),
                sum(n for (a, b), n in links.items() if held[a, b] == best[a]),
                sum(n * held[pair] for pair, n in links.items()),
                hashlib.sha256(text.encode()).hexdigest() if groups else "",
            )
        )
    return out, held, best


def table(spark, texts):
    rows = [(i, text, "x", i) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING, n_a STRING, count INT")


def result(frame):
    return [tuple(row)[1:] for row in sorted(frame.collect())]


@pytest.mark.parametrize("chunk_bytes", [4 << 20, 40])
def test_equals_whole_texts(spark, monkeypatch, chunk_bytes):
    monkeypatch.setattr(alignment, "CHUNK_BYTES", chunk_bytes)
    rows, _, _ = expected(TEXTS)
    found = result(alignment.aligned_digests(table(spark, TEXTS).repartition(3)))
    assert found == rows
    assert rows[1] == rows[2] == rows[7] == (0, 0, 0, 0, 0, 0, "")
    assert rows[6][0] > 0 and rows[8][0] > 0


def test_equals_whole_texts_of_the_table(spark, tables):
    docs = read(spark, tables, "documents")
    texts = [row.text for row in docs.orderBy("doc_id").collect()]
    assert result(alignment.aligned_digests(docs)) == expected(texts)[0]


def test_pieces_remembered_or_not(monkeypatch):
    alignment.aligner.cache_clear()
    monkeypatch.setattr(alignment, "REMEMBERED", 2)
    work = alignment.aligner(alignment.FOLDER, alignment.BYTE_LEVEL, alignment.PIECES)
    split = [work.split(text or "") for text in TEXTS]
    first = [work.aligned(list(dict.fromkeys(pieces))) for pieces in split]
    assert first == [work.aligned(list(dict.fromkeys(pieces))) for pieces in split]
    monkeypatch.setattr(alignment, "LONG_GROUP", 0)
    work.remembered.clear(), work.older.clear()
    assert first == [work.aligned(list(dict.fromkeys(pieces))) for pieces in split]
    assert work.cut and {len(p) for p in work.split('Ab, c.d%%')} == {3, 1, 2}


def test_cuts_at_random_texts(spark):
    """Whole texts and texts cut into pieces have the same tokens."""
    rng = random.Random(3)
    alphabet = ["a", "b", "The", "é", "日", "²", "́", "'", "'s", ",", ".", "%%", "\n", " ", "  ", "\t", "1", "23", "-", "(", ")", "☃", "▁", "$", "&amp;"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(1, 14))) for _ in range(400)]
    assert result(alignment.aligned_digests(table(spark, texts))) == expected(texts)[0]


def test_links_table(spark):
    _, held, best = expected(TEXTS)
    found = {(r.a_id, r.b_id): (r["count"], r.best) for r in alignment.links(table(spark, TEXTS)).collect()}
    assert found == {pair: (n, n == best[pair[0]]) for pair, n in held.items()}


def test_partial_characters_are_cut_by_decoded_bytes():
    # "é☃x": the snowman is three bytes in three tokens that all span its character.
    sizes = np.array([2, 1, 1, 1, 1])
    ends = alignment.byte_ends(np.array([0, 2, 2, 2, 5]), np.array([2, 5, 5, 5, 6]), sizes, np.zeros(5, int), np.array([0]))
    assert ends.tolist() == [2, 3, 4, 5, 6]
    # Byte-fallback tokens span nothing, and the last one the character.
    ends = alignment.byte_ends(np.array([0, 2, 2, 2, 5]), np.array([2, 2, 2, 5, 6]), sizes, np.zeros(5, int), np.array([0]))
    assert ends.tolist() == [2, 3, 4, 5, 6]


def test_empty_table_and_no_ids(spark):
    assert alignment.aligned_digests(table(spark, [])).collect() == []
    rows = spark.createDataFrame([(None, "one two"), (None, "one two"), (5, "one two")], "doc_id BIGINT, text STRING")
    found = alignment.aligned_digests(rows).collect()
    assert sorted(str(row.doc_id) for row in found) == ["5", "None", "None"]
    assert len({tuple(row)[1:] for row in found}) == 1
    assert found[0].count_sum == 3 * found[0].n_links


def test_runs_of_pieces_have_the_tokens_of_each_piece():
    """Pieces encoded together, also beside ones that are not given back, are as if encoded alone; a run is one text."""
    work = alignment.Aligner(str(Path(alignment.FOLDER, alignment.BYTE_LEVEL)), str(Path(alignment.FOLDER, alignment.PIECES)))
    rng = random.Random(7)
    alphabet = ["a", "b", "The", "é", "日", "ﬁ", "１", "​", "'s", ",", "\n", " ", "  ", "\t", "\x00", "▁", "👩‍👩‍👧"]
    texts = ["one two, three" * 9, *TEXTS, *("".join(rng.choices(alphabet, k=9)) for _ in range(900))]
    pieces = list(dict.fromkeys(piece for text in texts if text for piece in work.split(text)))
    alone = [work.align([piece])[0] for piece in pieces]
    assert any(piece.groups is None for piece in alone)
    assert work.align(pieces) == alone
    begins = work.runs(pieces)
    assert begins[0] == 0 and len(begins) < len(pieces) / 2
    assert max(j - i for i, j in zip(begins, [*begins[1:], len(pieces)], strict=True)) <= alignment.JOINED_PIECES
