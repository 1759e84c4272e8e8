"""Queries of the llm operators and, where SQL can express them, their oracles."""

from __future__ import annotations

from . import chat, decontamination, html_text, mixing, ngram_join, quality, secrets, token_counts, topk, toxicity

QUERIES = {
    "op1_chat_formatting": chat.op1_chat_formatting,
    "op2_quality_classifier": quality.op2_quality_classifier,
    "op3_ngram_jaccard_join": ngram_join.op3_ngram_jaccard_join,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_token_counts": token_counts.op5_token_counts,
    "op6_benchmark_decontamination": decontamination.op6_benchmark_decontamination,
    "op7_secret_scan": secrets.op7_secret_scan,
    "op8_source_mixing": mixing.op8_source_mixing,
    "op9_html_extraction": html_text.op9_html_extraction,
    "op10_topk_search": topk.op10_topk_search,
}
ORACLES = {
    "op1_chat_formatting": chat.SQL,
    "op3_ngram_jaccard_join": ngram_join.SQL,
    "op6_benchmark_decontamination": decontamination.SQL,
    "op8_source_mixing": mixing.SQL,
    "op10_topk_search": topk.SQL,
}
