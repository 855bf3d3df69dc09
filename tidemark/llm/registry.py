"""The queries of this subpackage, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from tidemark.llm import ann, centroids, html, language, mixing, neardup_pq, ngram_join, phrases, pieces, suffix_dedup, tokenstore, topk, toxicity

QUERIES = {
    "op1_topk": topk.op1_topk,
    "op4_sentencepiece": pieces.op4_sentencepiece,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_embedding_neardup": neardup_pq.op3_embedding_neardup,
    "op5_html": html.op5_html,
    "op6_ngram_join": ngram_join.op6_ngram_join,
    "op7_token_store": tokenstore.op7_token_store,
    "op8_mixing": mixing.op8_mixing,
    "op9_suffix_dedup": suffix_dedup.op9_suffix_dedup,
    "op10_language": language.op10_language,
    "op11_phrases": phrases.op11_phrases,
    "op12_centroids": centroids.op12_centroids,
    "op13_ann": ann.op13_ann,
}
SQL = {
    "op1_topk": topk.OP1_SQL,
    "op8_mixing": mixing.OP8_SQL,
    "op11_phrases": phrases.OP11_SQL,
    "op12_centroids": centroids.OP12_SQL,
}
