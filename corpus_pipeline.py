"""A pipeline over the corpus: toxic documents out, repeated lines out, one of each near-duplicate
group, benchmark items out, sources mixed to their target weights.

Each stage takes (spark, documents, folder of tables) and returns a DataFrame, which is written as
parquet and read again as the next stage's documents. All but the last return the columns of documents.

Defined cases are those of the operators: a null or empty text goes through all stages, an empty
table comes out empty, repeated rows are handled one by one, and further columns are not carried.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reviewflow.llm import decontaminate, line_dedup, ngram_jaccard, source_mix, toxicity
from reviewflow.llm.common import documents, read, stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic by a model trained on the labelled ones."""
    return toxicity.without_toxic(documents(docs, *COLUMNS), read(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in one of them; `n_chars` is counted anew."""
    cut = line_dedup.dedup_lines(documents(docs, *COLUMNS))
    return cut.selectExpr("doc_id", "text", "lang", "source", "CAST(length(text) AS BIGINT) AS n_chars")


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    return ngram_jaccard.keep_one(documents(docs, *COLUMNS))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_leaks(documents(docs, *COLUMNS), read(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of the documents in proportion to target weights of their sources, shuffled."""
    return source_mix.mix(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line dedup", line_dedup_stage),
    ("near duplicates", near_duplicates_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

# SQL cannot express the first stage, which compresses windows; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what each but the last returns is written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
