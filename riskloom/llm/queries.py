"""Registered queries of the package and their oracle SQL."""

from __future__ import annotations

from riskloom.llm import (
    chat_format,
    embedding_dedup,
    fill_in_middle,
    language_id,
    line_dedup,
    packing,
    quality_gam,
    quality_rules,
    simhash_dedup,
    source_mixing,
    spelling_variants,
    topk_search,
    url_filters,
)

QUERIES = {
    "op1_topk_search": topk_search.op1,
    "op2_url_filters": url_filters.op2,
    "op3_language_id": language_id.op3,
    "op4_simhash_dedup": simhash_dedup.op4,
    "op5_quality_gam": quality_gam.op5,
    "op6_line_dedup": line_dedup.op6,
    "op7_source_mixing": source_mixing.op7,
    "op8_packing": packing.op8,
    "op9_chat_format": chat_format.op9,
    "op10_quality_rules": quality_rules.op10,
    "op11_fill_in_middle": fill_in_middle.op11,
    "op12_spelling_variants": spelling_variants.op12,
    "op13_embedding_dedup": embedding_dedup.op13,
}
ORACLE = {
    "op1_topk_search": topk_search.OP1_SQL,
    "op2_url_filters": url_filters.OP2_SQL,
    "op10_quality_rules": quality_rules.OP10_SQL,
    "op11_fill_in_middle": fill_in_middle.OP11_SQL,
}
