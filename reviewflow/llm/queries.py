"""The registered queries of the operators: each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reviewflow.llm import (
    decontaminate,
    html_extraction,
    lexical_search,
    license_scan,
    line_dedup,
    ngram_jaccard,
    quality_classifier,
    quality_rules,
    source_mix,
    suffix_dedup,
    token_alignment,
    toxicity,
    url_filter,
)
from reviewflow.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


@query
def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    return quality_classifier.score_documents(docs, labels)


@query
def op2_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    joined = ngram_jaccard.join_near_duplicates(read(spark, folder, "documents"))
    return joined.select("doc_id", "n_shingles", "component_id")


@query
def op3_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    judged = url_filter.judge_urls(read(spark, folder, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query
def op4_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.dedup_spans(read(spark, folder, "documents")).drop("spans")


@query
def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.judge_documents(read(spark, folder, "documents"))
    return judged.drop("rejected_by")


@query
def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.line_digests(read(spark, folder, "documents"))


@query
def op7_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(read(spark, folder, "documents"))


@query
def op8_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return source_mix.mix(read(spark, folder, "documents"))


@query
def op9_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_leaks(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


@query
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    return toxicity.score_documents(docs, labels).select("doc_id", "held_out", "score", "predicted")


@query
def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.search(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


@query
def op12_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_extraction.extract(read(spark, folder, "pages"))


@query
def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return token_alignment.aligned_digests(read(spark, folder, "documents"))
