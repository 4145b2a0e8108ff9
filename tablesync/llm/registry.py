"""The registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from tablesync.llm import conversation_trie, hidden_markov, line_dedup, mixing, packing, quality, secrets, simhash, spelling, substring_dedup, token_counts, topk, toxicity

QUERIES = {
    "op1_substring_dedup": substring_dedup.query,
    "op2_line_dedup": line_dedup.query,
    "op3_quality_rules": quality.query,
    "op4_simhash_near_dedup": simhash.query,
    "op5_source_mixing": mixing.query,
    "op6_secret_scan": secrets.query,
    "op7_token_counts": token_counts.query,
    "op8_exact_top_k": topk.query,
    "op9_best_fit_packing": packing.query,
    "op10_toxicity": toxicity.query,
    "op11_hidden_markov": hidden_markov.query,
    "op12_spelling_variants": spelling.query,
    "op13_conversation_trie": conversation_trie.query,
}

ORACLE_SQL = {
    "op1_substring_dedup": substring_dedup.ORACLE,
    "op2_line_dedup": line_dedup.ORACLE,
    "op5_source_mixing": mixing.ORACLE,
    "op8_exact_top_k": topk.ORACLE,
    "op12_spelling_variants": spelling.ORACLE,
    "op13_conversation_trie": conversation_trie.ORACLE,
}
