"""Registered queries of this subpackage and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import op1_mix, op2_decontaminate, op3_quality_rules, op4_pii, op5_warc, op6_license_scan, op7_jaccard_join, op8_substring_dedup, \
    op9_quality_classifier, op10_language_id, op11_shard, op12_collocations, op13_conversation_repair

_MODULES = {
    "op1_mix": op1_mix,
    "op2_decontaminate": op2_decontaminate,
    "op3_quality_rules": op3_quality_rules,
    "op4_pii": op4_pii,
    "op5_warc": op5_warc,
    "op6_license_scan": op6_license_scan,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_language_id": op10_language_id,
    "op11_shard": op11_shard,
    "op12_collocations": op12_collocations,
    "op13_conversation_repair": op13_conversation_repair,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: getattr(m, name) for name, m in _MODULES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: m.ORACLE for name, m in _MODULES.items() if hasattr(m, "ORACLE")}
