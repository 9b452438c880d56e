"""Registered queries of the training-data operators and their SQL counterparts."""

from __future__ import annotations

import corpus_pipeline
from depthframe.llm import decontaminate, lexical, line_dedup, near_dedup, pieces, prefix_trie, quality, secrets, simhash, suffix_lm, tokens, topk, urls

QUERIES = {
    "op1_decontaminate": decontaminate.op1_decontaminate,
    "op2_near_duplicates": near_dedup.op2_near_duplicates,
    "op3_quality": quality.op3_quality,
    "op4_url_filter": urls.op4_url_filter,
    "op5_token_counts": tokens.op5_token_counts,
    "op6_line_dedup": line_dedup.op6_line_dedup,
    "op7_secrets": secrets.op7_secrets,
    "op8_sentencepiece": pieces.op8_sentencepiece,
    "op9_lm_score": suffix_lm.op9_lm_score,
    "op10_topk": topk.op10_topk,
    "op11_simhash": simhash.op11_simhash,
    "op12_lexical_search": lexical.op12_lexical_search,
    "op13_prefix_trie": prefix_trie.op13_prefix_trie,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op1_decontaminate": decontaminate.OP1_SQL,
    "op2_near_duplicates": near_dedup.OP2_SQL,
    "op4_url_filter": urls.OP4_SQL,
    "op10_topk": topk.OP10_SQL,
    "op12_lexical_search": lexical.OP12_SQL,
    "op13_prefix_trie": prefix_trie.OP13_SQL,
}
