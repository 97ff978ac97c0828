"""The operators' queries and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from palimpsest.llm import decontaminate, disclosure, html_extract, importance, mixing, ngram_join, periodic_runs, quality_classifier, quality_rules, substring_dedup, token_output, toxicity, url_filter


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_output": token_output.query,
        "op2_mixing": mixing.query,
        "op3_url_filter": url_filter.query,
        "op4_decontaminate": decontaminate.query,
        "op5_substring_dedup": substring_dedup.query,
        "op6_ngram_join": ngram_join.query,
        "op7_toxicity": toxicity.query,
        "op8_quality_rules": quality_rules.query,
        "op9_html_extract": html_extract.query,
        "op10_quality_classifier": quality_classifier.query,
        "op11_periodic_runs": periodic_runs.query,
        "op12_pii_sanitisation": disclosure.query,
        "op13_importance_resampling": importance.query,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_url_filter": url_filter.oracle_sql(),
        "op4_decontaminate": decontaminate.oracle_sql(),
        "op6_ngram_join": ngram_join.oracle_sql(),
        "op8_quality_rules": quality_rules.oracle_sql(),
        "op13_importance_resampling": importance.oracle_sql(),
    }
