"""Registered queries of the corpus operators and their DuckDB oracles where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from retentia.llm import (op1_toxicity, op2_packing, op3_sharding, op4_url_filters, op5_decontamination, op6_substring_dedup,
                          op7_simhash, op8_warc, op9_quality_rules, op10_lm_scoring,
                          op11_language_id, op12_token_alignment, op13_periodic_runs)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity.query,
    "op2_packing": op2_packing.query,
    "op3_sharding": op3_sharding.query,
    "op4_url_filters": op4_url_filters.query,
    "op5_decontamination": op5_decontamination.query,
    "op6_substring_dedup": op6_substring_dedup.query,
    "op7_simhash": op7_simhash.query,
    "op8_warc": op8_warc.query,
    "op9_quality_rules": op9_quality_rules.query,
    "op10_lm_scoring": op10_lm_scoring.query,
    "op11_language_id": op11_language_id.query,
    "op12_token_alignment": op12_token_alignment.query,
    "op13_periodic_runs": op13_periodic_runs.query,
}

ORACLES: dict[str, str] = {
    "op4_url_filters": op4_url_filters.ORACLE_SQL,
    "op5_decontamination": op5_decontamination.ORACLE_SQL,
    "op8_warc": op8_warc.ORACLE_SQL,
    "op9_quality_rules": op9_quality_rules.ORACLE_SQL,
}
