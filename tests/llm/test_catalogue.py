"""Every text query has SQL that it equals, or a test against a brute-force version, an exact round trip or held-out labels."""

import importlib

import pytest

import __spark_entry__ as contract
from recordtide.llm.queries import QUERIES, SQL
from tests.conftest import DATA
from tests.test_catalogue import same_rows

#: Queries without SQL, and the tests that take its place.
TESTED_BY = {
    "op1_best_fit_packing": "test_tokens.test_packing",
    "op2_html_extraction": "test_quality.test_pages",
    "op3_token_counts": "test_tokens.test_token_counts",
    "op4_jaccard_join": "test_passages.test_jaccard_join_finds_the_components_of_near_copies",
    "op5_license_scan": "test_quality.test_license_scan",
    "op6_quality_classifier": "test_quality.test_classifier_on_the_held_out_fold",
    "op7_substring_dedup": "test_passages.test_repeated_windows_of_the_corpus",
    "op8_quality_rules": "test_quality.test_rule_counts",
    "op9_benchmark_decontamination": "test_passages.test_benchmark_passages_of_the_corpus",
    "op10_token_files": "test_tokens.test_token_files",
    "op11_embedding_whitening": "test_whitening.test_query_against_brute_force",
    "pipeline": "test_pipeline.test_stages_one_by_one",
}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(name, spark, duck):
    same_rows(QUERIES[name](spark, DATA), duck.execute(SQL[name]))


def test_every_query_has_sql_or_a_test():
    text = set(QUERIES) | {"pipeline"}
    assert text <= set(contract.queries()) and set(SQL) | set(TESTED_BY) == text and not set(SQL) & set(TESTED_BY)
    for where in TESTED_BY.values():
        module, test = where.split(".")
        assert callable(getattr(importlib.import_module(f"tests.llm.{module}"), test))
