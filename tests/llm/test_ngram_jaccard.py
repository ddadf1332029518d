from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from reviewflow.llm import common
from reviewflow.llm import ngram_jaccard as op
from reviewflow.llm.components import components
from reviewflow.session import path_exists


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute_force(rows):
    """All pairs, then components by repeated search."""
    sets = [shingles(text) for _, text in rows]
    near = {i: {i} for i in range(len(rows))}
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                near[i].add(j)
                near[j].add(i)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(ids, default=None)))
    return sorted(out, key=str)


def got(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    return sorted((tuple(row)[:3] for row in op.join_near_duplicates(docs).collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    source = random.Random(5)

    def prose(n):
        return [f"w{source.randrange(400)}" for _ in range(n)]

    def changed(words, n):
        words = list(words)
        for _ in range(n):
            words[source.randrange(len(words))] = f"changed{source.randrange(10**6)}"
        return words

    passage, base, short = prose(60), prose(120), prose(20)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a b c"), (5, "A B\tc"), (6, "a b c d e"), (7, "a b c d e f"), (None, "a b c"), (None, "lonely one")]
    rows += [(20 + i, " ".join(changed(base, i % 5))) for i in range(60)]
    rows += [(100 + i, " ".join(short + [f"t{i}"] * (i % 3))) for i in range(12)]
    rows += [(150 + i, " ".join(passage + prose(5 + i % 20))) for i in range(50)]
    chain = prose(100)
    for i in range(12):
        rows.append((250 + i, " ".join(chain)))
        chain = chain[2:] + prose(2)
    rows += [(280, rows[20][1]), (280, "another text of this id, quite alone in here"), (281, " ".join(prose(5000))), (282, " ".join(base) + "!")]
    rows += [(290 + i, " ".join(prose(30))) for i in range(20)]
    return rows


def test_equals_brute_force(spark, rows):
    assert got(spark, rows) == brute_force(rows)


@pytest.mark.parametrize(("block", "frequent", "chunk"), [(2, 4, 500), (7, 1, 10**6), (5, 10**6, 50)])
def test_large_groups_equal_brute_force(spark, rows, monkeypatch, block, frequent, chunk):
    monkeypatch.setattr(op, "SMALL_GROUP", block)
    monkeypatch.setattr(op, "BLOCK_ROWS", block)
    monkeypatch.setattr(op, "FREQUENT", frequent)
    monkeypatch.setattr(op, "CHUNK_HASHES", chunk)
    assert got(spark, rows) == brute_force(rows)


def test_groups_of_long_texts_equal_brute_force(spark, rows, monkeypatch):
    monkeypatch.setattr(op, "BLOCK_BYTES", 3000)
    assert got(spark, rows) == brute_force(rows)


def test_one_of_each_group_stays(spark, rows):
    odd = spark.createDataFrame([(d, t, "c", i) for i, (d, t) in enumerate(rows)], "doc_id BIGINT, text STRING, class STRING, of INT")
    stay = op.keep_one(odd)
    assert stay.columns == odd.columns
    found = brute_force(rows)
    bare = sorted(str(r[0]) for r in found if r[1] == 0)
    kept = [row for row in stay.collect()]
    assert sorted(str(row.doc_id) for row in kept if not op.shingle_set((row.text or "").encode()).size) == bare
    ids = {r[2] for r in found if r[1] and r[2] is not None}
    assert {row.doc_id for row in kept if op.shingle_set((row.text or "").encode()).size} - {None} == ids


def test_one_row_of_copies_under_one_id_or_none(spark):
    text, other = "one two three four five six seven eight", "nine ten eleven twelve thirteen fourteen fifteen"
    rows = [(1, text), (1, text), (None, text), (None, text), (2, text)]
    assert sorted(map(tuple, op.keep_one(spark.createDataFrame(rows, "doc_id BIGINT, text STRING")).collect())) == [(1, text)]
    rows = [(None, other), (None, other), (3, text), (3, other + " more"), (4, None), (4, None), (None, "")]
    kept = op.keep_one(spark.createDataFrame(rows, "doc_id BIGINT, text STRING")).collect()
    assert sorted(map(str, map(tuple, kept))) == sorted(
        map(str, [(None, other), (3, text), (3, other + " more"), (4, None), (4, None), (None, "")])
    )


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id BIGINT, text STRING")
    assert op.join_near_duplicates(docs).count() == 0
    assert op.keep_one(docs).count() == 0


def test_products():
    source = np.random.default_rng(1)
    sets = [np.unique(source.integers(0, 30_000, size).astype(np.uint64)) for size in (5, 5000, 9000, 1, 7000)]
    found = op.overlaps(sets[:2], sets)
    assert found.tolist() == [[len(np.intersect1d(a, b)) for b in sets] for a in sets[:2]]


@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components(spark, shape):
    source = random.Random(2)
    edges = {
        "chain": [(i, i + 1) for i in range(40)],
        "star": [(7, i) for i in range(50) if i != 7],
        "random": [(source.randrange(60), source.randrange(60)) for _ in range(45)],
        "none": [(3, 3)],
    }[shape]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    frame = spark.createDataFrame(edges, "a BIGINT, b BIGINT").selectExpr("a AS left", "b AS right")
    got = {row.node: row.label for row in components(frame, "left", "right").collect()}
    assert got == {x: root(x) for x in parent}


def test_hashes_are_dealt_evenly():
    source = random.Random(4)
    texts = [" ".join(f"w{source.randrange(10**6)}" for _ in range(60)) for _ in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(300), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    held = dict.fromkeys(range(20), 0)
    found = set()
    for sent in op.send_hashes(20)(iter([batch])):
        for bucket, blob in zip(sent.column("bucket").to_pylist(), sent.column("single").to_pylist(), strict=True):
            keys = np.frombuffer(blob or b"", np.uint64).reshape(2, -1)[0]
            held[bucket] += len(keys)
            found.update(op.hashes_of(keys).tolist())
    sets = [op.shingle_set(text.encode()) for text in texts]
    assert found == {h for hashes in sets for h in hashes[: -(-len(hashes) * 3 // 10)].tolist()}
    assert max(held.values()) < 1.5 * sum(held.values()) / len(held)


def test_frequent_hashes_are_those_of_shingles(spark):
    rows = [(i, f"one two three four five six seven eight w{i} x{i}") for i in range(op.FREQUENT + 6)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    sets = [op.shingle_set(text.encode()) for _, text in rows]
    hashes, counts = np.unique(np.concatenate([s[: -(-len(s) * 3 // 10)] for s in sets]), return_counts=True)
    assert op.frequent_hashes(op.hash_facts(docs)).tolist() == hashes[counts >= op.FREQUENT].tolist()


def test_blocks_are_multiplied_one_pair_at_a_time(spark, rows, monkeypatch):
    def single(work, _):
        def run(batches):
            for batch in batches:
                if batch.num_rows > 1:
                    raise ValueError(f"{batch.num_rows} pairs of blocks at a time")
                yield work(batch)

        return run

    monkeypatch.setattr(op, "SMALL_GROUP", 2)
    monkeypatch.setattr(op, "per_batch_of", single)
    names = op.BATCH_ROWS, op.READER_ROWS, *op.RELEASED
    assert got(spark, rows) == brute_force(rows)
    before = [spark.conf.get(name, None) for name in names]
    assert got(spark, rows) == brute_force(rows)
    assert [spark.conf.get(name, None) for name in names] == before


def test_shuffles_of_written_tables_are_released(spark, monkeypatch):
    """Disk holds what one written table was shuffled for, whenever the driver collects its garbage."""
    (setting,), seen, stored = op.RELEASED, [], op.stored
    before = spark.conf.get(setting)
    monkeypatch.setattr(op, "stored", lambda *of: seen.append(spark.conf.get(setting)) or stored(*of))
    assert len(got(spark, [(1, "a b c d e f"), (2, "a b c d e f")])) == 2
    assert set(seen) == {"true"}
    assert spark.conf.get(setting) == before


def test_tables_that_nothing_reads_any_more_go(spark, rows, monkeypatch):
    made, folder = {}, common.shared_folder

    def noted(spark, purpose):
        path = folder(spark, purpose)
        made[path] = purpose
        return path

    monkeypatch.setattr(common, "shared_folder", noted)
    monkeypatch.setattr(op, "SMALL_GROUP", 2)
    assert got(spark, rows) == brute_force(rows)
    gone = {purpose for path, purpose in made.items() if not path_exists(spark, path)}
    assert gone == {"shingle-sets", "prefixes", "hub-distances"}


def test_passages_of_two_documents_each_make_no_group(spark, monkeypatch):
    """A chain of documents, each with a passage of the one before and of the one after: groups must not grow with the table."""
    source = random.Random(6)
    passages = [[f"p{i}x{source.randrange(10**6)}" for _ in range(30)] for i in range(121)]
    rows = [(i, " ".join(passages[i] + [f"d{i}x{j}" for j in range(50)] + passages[i + 1])) for i in range(120)]
    rows.append((500, rows[7][1] + " more"))

    def large(big, *_):
        raise AssertionError(f"{big.count()} classes in a group")

    monkeypatch.setattr(op, "SMALL_GROUP", 2)
    monkeypatch.setattr(op, "large_links", large)
    assert got(spark, rows) == brute_force(rows)


def test_sets_are_ordered_by_how_many_have_a_hash():
    source = np.random.default_rng(7)
    sets = [np.unique(source.integers(0, 2**64, 40, np.uint64)) for _ in range(30)]
    common, late = source.integers(0, 2**64, 60, np.uint64), np.sort(source.integers(0, 2**64, 2, np.uint64))
    sets = [np.unique(np.concatenate([s[: i % 9], source.choice(common, 30, False), late])) for i, s in enumerate(sets)]
    values, counts = np.unique(np.concatenate(sets), return_counts=True)
    counts = dict(zip(values.tolist(), counts.tolist(), strict=True))
    chunks = [
        {"chunk": k, "classes": b"".join(map(op.class_of, part)), "sizes": np.array([len(s) for s in part]).tobytes(), "hashes": np.concatenate(part).tobytes()}
        for k, part in enumerate((sets[:11], sets[11:12], sets[12:]))
    ]
    sent = list(op.send_chunks(8, late)(iter([pa.RecordBatch.from_pylist(chunks).select(["chunk", "hashes"])])))
    replies = [reply for odd in (0, 1) for reply in pa.Table.from_batches(
        op.receive_chunks(b.filter(pa.array([x % 2 == odd for x in b.column("bucket").to_pylist()])) for b in sent)
    ).to_pylist()]
    for chunk in chunks:
        number = chunk.pop("chunk")
        chunk["replies"] = [{"bucket": r["bucket"], "counts": r["counts"]} for r in replies if r["chunk"] == number]
    found = {}
    for batch in op.order_sets(late)(iter([pa.RecordBatch.from_pylist(chunks)])):
        found.update((row["class"], row) for row in batch.to_pylist())
    for hashes in sets:
        rare = sum(counts[h] == 1 for h in hashes.tolist())
        row = found.pop(op.class_of(hashes), None)
        assert (row is not None) == (rare < len(hashes) - op.least_overlap(len(hashes)) + 1)
        if row:
            assert (row["n"], row["rare"]) == (len(hashes), rare)
            assert np.frombuffer(row["hashes"], np.uint64).tolist() == sorted(hashes.tolist(), key=lambda h: (h in late.tolist(), counts[h], h))
    assert not found
