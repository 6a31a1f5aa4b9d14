"""Registered queries of this subpackage and their reference SQL."""

from __future__ import annotations

from mergewright.llm import (
    byte_bpe,
    collocations,
    exact_dedup,
    host_quality,
    language,
    near_dedup,
    near_join,
    packing,
    records,
    secrets,
    toxicity,
    turn_trie,
    url_filter,
)

QUERIES = {
    "op1_url_filters": url_filter.op1_url_filters,
    "op2_token_records": records.op2_token_records,
    "op3_packing": packing.op3_packing,
    "op4_language": language.op4_language,
    "op5_exact_dedup": exact_dedup.op5_exact_dedup,
    "op6_secret_scans": secrets.op6_secret_scans,
    "op7_host_quality": host_quality.op7_host_quality,
    "op8_byte_bpe": byte_bpe.op8_byte_bpe,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_ngram_jaccard_join": near_join.op10_ngram_jaccard_join,
    "op11_minhash_near_dedup": near_dedup.op11_minhash_near_dedup,
    "op12_conversation_trie": turn_trie.op12_conversation_trie,
    "op13_collocations": collocations.op13_collocations,
}

ORACLE = {
    "op10_ngram_jaccard_join": near_join.OP10_SQL,
    "op11_minhash_near_dedup": near_dedup.OP11_SQL,
    "op12_conversation_trie": turn_trie.OP12_SQL,
    "op13_collocations": collocations.OP13_SQL,
    "op1_url_filters": url_filter.OP1_SQL,
    "op5_exact_dedup": exact_dedup.OP5_SQL,
    "op7_host_quality": host_quality.OP7_SQL,
}
