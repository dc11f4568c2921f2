"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from tidewrack.llm import chat, decontaminate, jaccard_join, licenses, line_rules, lm_score, mixing, pii, piece_tokens, quality, reversed_search, suffix_dedup, vector_codes

QUERIES = {
    "op1_license_scan": licenses.op1_license_scan,
    "op2_quality_classifier": quality.op2_quality_classifier,
    "op3_decontaminate": decontaminate.op3_decontaminate,
    "op4_lm_score": lm_score.op4_lm_score,
    "op5_chat_format": chat.op5_chat_format,
    "op6_pii": pii.op6_pii,
    "op7_jaccard_join": jaccard_join.op7_jaccard_join,
    "op8_quality_rules": line_rules.op8_quality_rules,
    "op9_mixing": mixing.op9_mixing,
    "op10_suffix_dedup": suffix_dedup.op10_suffix_dedup,
    "op11_reversed_search": reversed_search.op11_reversed_search,
    "op12_piece_tokens": piece_tokens.op12_piece_tokens,
    "op13_vector_codes": vector_codes.op13_vector_codes,
}
ORACLES = {
    "op1_license_scan": licenses.ORACLE,
    "op3_decontaminate": decontaminate.ORACLE,
    "op4_lm_score": lm_score.ORACLE,
    "op5_chat_format": chat.ORACLE,
    "op9_mixing": mixing.ORACLE,
    "op11_reversed_search": reversed_search.ORACLE,
    "op13_vector_codes": vector_codes.ORACLE,
}
