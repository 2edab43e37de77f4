"""Queries of the corpus operators and, where SQL can express them, their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (decontaminate, filter_audit, html_extract, language_id, line_dedup, lm_scoring, mixing, ngram_join, quality_rules, ranked_search, sharding,
               token_output, url_filter)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": mixing.op1_mixing,
    "op2_quality_rules": quality_rules.op2_quality_rules,
    "op3_line_dedup": line_dedup.op3_line_dedup,
    "op4_ngram_jaccard_join": ngram_join.op4_ngram_jaccard_join,
    "op5_sharding": sharding.op5_sharding,
    "op6_token_output": token_output.op6_token_output,
    "op7_lm_scoring": lm_scoring.op7_lm_scoring,
    "op8_language_id": language_id.op8_language_id,
    "op9_benchmark_decontamination": decontaminate.op9_benchmark_decontamination,
    "op10_html_extraction": html_extract.op10_html_extraction,
    "op11_url_filter": url_filter.op11_url_filter,
    "op12_ranked_search": ranked_search.op12_ranked_search,
    "op13_filter_audit": filter_audit.op13_filter_audit,
}

ORACLE_SQL: dict[str, str] = {
    "op1_mixing": mixing.SQL,
    "op2_quality_rules": quality_rules.SQL,
    "op3_line_dedup": line_dedup.SQL,
    "op9_benchmark_decontamination": decontaminate.SQL,
    "op11_url_filter": url_filter.SQL,
    "op12_ranked_search": ranked_search.SQL,
    "op13_filter_audit": filter_audit.SQL,
}
