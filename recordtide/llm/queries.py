"""One query per operator of this subpackage, with production parameters over its whole table, and SQL where it serves."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordtide.llm import (
    collocations, decontaminate, html_text, jaccard_join, license_scan, packing, quality_classifier, quality_rules, sharding, substring_dedup,
    token_counts, token_files, whitening,
)
from recordtide.llm.tables import table, tokenizer_file
from recordtide.session import work_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def importable(spark: SparkSession) -> None:
    """Workers find the package where the driver has it, unless told otherwise."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


def query(plan: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Register a query under its function's name."""

    @wraps(plan)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        importable(spark)
        return plan(spark, folder)

    QUERIES[plan.__name__] = run
    return run


@query
def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judge(table(spark, folder, "documents"))


@query
def op4_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.classes(table(spark, folder, "documents"))


@query
def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"), tokenizer_file("byte_bpe_50k.json"))


@query
def op2_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages"))


@query
def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"), tokenizer_file("word_bpe_49k.json"))


@query
def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(table(spark, folder, "documents"))


@query
def op6_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality_classifier.score(docs, quality_classifier.train(docs, table(spark, folder, "labels")))


@query
def op7_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.removed(table(spark, folder, "documents"))


@query
def op9_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    target = work_folder(spark, "tokens")
    token_files.write_tokens(table(spark, folder, "documents"), target, tokenizer_file("byte_bpe_50k.json"))
    return token_files.read_documents(spark, target)


@query
def op11_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    model = whitening.fit(vectors)
    error = whitening.identity_error(vectors, model) if model else 0.0
    rows = whitening.whiten(vectors, model)
    return rows.withColumns({"deviation": F.expr("try_cast(deviation AS bigint)"), "identity_error": F.lit(error)})


@query
def op12_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


@query
def op13_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign(table(spark, folder, "documents"))


SQL["op12_phrase_collocations"] = collocations.SQL
SQL["op13_sharding"] = sharding.SQL
