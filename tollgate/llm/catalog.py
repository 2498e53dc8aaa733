"""Registered queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tollgate.llm import (chat_format, curriculum, decontaminate, hard_negatives, jaccard_join, language_id, merkle, pii,
                          quality_mil, quality_rules, secret_scan, token_output, url_cascade)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard_join": jaccard_join.op1_ngram_jaccard_join,
    "op2_quality_rules": quality_rules.op2_quality_rules,
    "op3_quality_classifier": quality_mil.op3_quality_classifier,
    "op4_language_id": language_id.op4_language_id,
    "op5_token_output": token_output.op5_token_output,
    "op6_pii": pii.op6_pii,
    "op7_secret_scan": secret_scan.op7_secret_scan,
    "op8_decontamination": decontaminate.op8_decontamination,
    "op9_url_filter": url_cascade.op9_url_filter,
    "op10_curriculum_mix": curriculum.op10_curriculum_mix,
    "op11_hard_negatives": hard_negatives.op11_hard_negatives,
    "op12_chat_format": chat_format.op12_chat_format,
    "op13_merkle_manifest": merkle.op13_merkle_manifest,
}

#: Keys without an entry cannot be expressed in SQL; tests/llm holds them
#: against brute force, exact round trips or held-out accuracy.
ORACLE: dict[str, str] = {
    "op2_quality_rules": quality_rules.ORACLE_SQL,
    "op8_decontamination": decontaminate.ORACLE_SQL,
    "op9_url_filter": url_cascade.ORACLE_SQL,
    "op10_curriculum_mix": curriculum.ORACLE_SQL,
    "op11_hard_negatives": hard_negatives.ORACLE_SQL,
    "op12_chat_format": chat_format.ORACLE_SQL,
    "op13_merkle_manifest": merkle.ORACLE_SQL,
}
