"""Registered queries of the llm operators and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from . import (
    attention_scores, conversation_trie, language_fusion, license_diagonals, piece_spans, quality_ledger, rank_merge, soft_mix, spelling_variants, threshold_topk, token_dac,
    weighted_minhash, wrapper_induction,
)

QUERIES = {f.__name__: f for f in (
    quality_ledger.op1_quality_ledger,
    token_dac.op2_token_dac,
    soft_mix.op3_soft_mix,
    weighted_minhash.op4_weighted_minhash,
    threshold_topk.op5_threshold_topk,
    piece_spans.op6_piece_spans,
    rank_merge.op7_rank_merge,
    language_fusion.op8_language_fusion,
    language_fusion.op8_page_languages,
    license_diagonals.op9_license_diagonals,
    wrapper_induction.op10_wrapper_induction,
    conversation_trie.op11_prefix_trie,
    spelling_variants.op12_spelling_variants,
    attention_scores.op13_attention_scores,
)}

ORACLES = {"op5_threshold_topk": threshold_topk.ORACLE, "op11_prefix_trie": conversation_trie.ORACLE,
           "op12_spelling_variants": spelling_variants.ORACLE}
