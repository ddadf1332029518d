from __future__ import annotations

import random

import corpus_pipeline
import pytest
from test_decontaminate import brute_force as leaks
from test_line_dedup import brute_force as deduped_lines
from test_ngram_jaccard import brute_force as groups
from test_source_mix import brute_copies

from reviewflow.llm import source_mix, toxicity
from reviewflow.llm.common import read

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


def brute_force(spark, folder):
    """The stages on plain rows; the model is the operator's, applied text by text."""
    model = toxicity.train(read(spark, folder, "documents"), read(spark, folder, "labels"))
    scale = toxicity.Scale(model.ordinary, model.toxic)
    docs = [tuple(row) for row in read(spark, folder, "documents").collect()]
    docs = [d for d in docs if model.score(scale.measures((d[1] or "").encode())) < toxicity.THRESHOLD]
    lines = deduped_lines([d[:2] for d in docs])
    docs = [(d[0], text, *d[2:4], len(text)) for d, (_, _, _, text) in zip(docs, lines, strict=True)]
    stay = {row[2] for row in groups([d[:2] for d in docs])}
    docs = [d for d in docs if d[0] in stay]
    leaky = {doc_id for doc_id, _ in leaks([d[:2] for d in docs], [tuple(r) for r in read(spark, folder, "benchmark").collect()])}
    docs = [d for d in docs if d[0] not in leaky]
    sizes = {}
    for d in docs:
        sizes[d[3]] = sizes.get(d[3], 0) + 1
    weights = {s: n**source_mix.TEMPERATURE for s, n in sizes.items()}
    rates = {s: weights[s] / sum(weights.values()) * len(docs) / n for s, n in sizes.items()}
    return sorted((d, copy) for d in docs for copy in range(1, brute_copies(d[0], rates[d[3]]) + 1))


def test_equals_brute_force(spark, tables):
    rows = corpus_pipeline.run(spark, tables).collect()
    assert sorted((tuple(row)[:5], row.copy) for row in rows) == brute_force(spark, tables)


def test_stages_keep_the_columns(spark, tables):
    docs = read(spark, tables, "documents")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line dedup", "near duplicates", "benchmark decontamination", "mixing",
    ]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, tables).schema.simpleString() == docs.schema.simpleString()


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0)]])
def test_odd_documents(spark, tables, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, tables)
        assert out.count() >= 0
        if "copy" not in out.columns:
            assert out.count() == len(rows)
            docs = out


@pytest.mark.parametrize("empty", [("documents",), ("labels", "benchmark"), ("documents", "labels", "benchmark")])
def test_empty_tables_run_through_all_stages(spark, tables, tmp_path, empty):
    for name in ("documents", "labels", "benchmark"):
        table = read(spark, tables, name)
        (table.limit(0) if name in empty else table).write.parquet(f"{tmp_path}/{name}.parquet")
    rows = corpus_pipeline.run(spark, str(tmp_path))
    assert rows.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    assert (rows.count() == 0) == ("documents" in empty)


def test_order_of_rows_does_not_matter(spark, tables):
    docs = read(spark, tables, "documents").collect()
    random.Random(3).shuffle(docs)
    for _, stage in corpus_pipeline.STAGES[:4]:
        one = stage(spark, read(spark, tables, "documents"), tables)
        other = stage(spark, spark.createDataFrame(docs, SCHEMA).repartition(3), tables)
        assert sorted(one.collect()) == sorted(other.collect())
