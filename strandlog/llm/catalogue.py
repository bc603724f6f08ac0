"""The queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from strandlog.llm import (
    decontaminate,
    language_id,
    line_dedup,
    mixing,
    near_dedup,
    packing,
    quality_classifier,
    quality_rules,
    suffix_dedup,
    url_filters,
)

QUERIES = {
    "op1_decontaminate": decontaminate.op1_decontaminate,
    "op2_quality_classifier": quality_classifier.op2_quality_classifier,
    "op3_quality_rules": quality_rules.op3_quality_rules,
    "op4_pack_tokens": packing.op4_pack_tokens,
    "op5_suffix_dedup": suffix_dedup.op5_suffix_dedup,
    "op6_url_filters": url_filters.op6_url_filters,
    "op7_mix_sources": mixing.op7_mix_sources,
    "op8_language_id": language_id.op8_language_id,
    "op9_line_dedup": line_dedup.op9_line_dedup,
    "op9_line_dedup_from_one": line_dedup.op9_line_dedup_from_one,
    "op10_near_dedup": near_dedup.op10_near_dedup,
}

ORACLE_SQL = {
    "op3_quality_rules": quality_rules.ORACLE_SQL,
    "op6_url_filters": url_filters.ORACLE_SQL,
    "op9_line_dedup": line_dedup.ORACLE_SQL,
    "op9_line_dedup_from_one": line_dedup.ORACLE_SQL_FROM_ONE,
}
