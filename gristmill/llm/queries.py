"""The queries of this folder and, where SQL can express one, its SQL for DuckDB."""

from __future__ import annotations

from gristmill.llm import chat, ctw, exactdedup, neardup, ngramjoin, packing, pieces, revisits, secretscan, toxicity

QUERIES = {
    "op1_warc_revisits": revisits.op1_warc_revisits,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_gumbel_topk_pieces": pieces.op3_gumbel_topk_pieces,
    "op4_ngram_jaccard_join": ngramjoin.op4_ngram_jaccard_join,
    "op5_nn_descent": neardup.op5_nn_descent,
    "op6_exact_dedup": exactdedup.op6_exact_dedup,
    "op7_secret_scan": secretscan.op7_secret_scan,
    "op8_preference_format": chat.op8_preference_format,
    "op9_context_tree_weighting": ctw.op9_context_tree_weighting,
    "op10_best_fit_packing": packing.op10_best_fit_packing,
}

ORACLE_SQL: dict[str, str] = {
    "op1_warc_revisits": revisits.ORACLE,
    "op6_exact_dedup": exactdedup.ORACLE,
    "op8_preference_format": chat.ORACLE,
}
