"""The queries of this package and their SQL for DuckDB."""

from __future__ import annotations

from fieldbalance.llm import (chat, decontaminate, exact_dedup, html, license, mixing, ngram_join, spelling,
                              substring, tokens, topk, toxicity, whitening)

QUERIES = {
    "op1_substring": substring.op1_substring, "op2_html": html.op2_html,
    "op3_decontaminate": decontaminate.op3_decontaminate, "op4_toxicity": toxicity.op4_toxicity,
    "op5_ngram_join": ngram_join.op5_ngram_join, "op6_mix": mixing.op6_mix, "op7_license": license.op7_license,
    "op8_chat": chat.op8_chat, "op9_tokens": tokens.op9_tokens, "op10_topk": topk.op10_topk,
    "op11_spelling": spelling.op11_spelling, "op12_exact_dedup": exact_dedup.op12_exact_dedup,
    "op13_whitening": whitening.op13_whitening,
}

ORACLE_SQL = {"op10_topk": topk.OP10_SQL, "op12_exact_dedup": exact_dedup.OP12_SQL}
