"""Queries and DuckDB oracles of this subpackage."""

from __future__ import annotations

from ledgerlens.llm import collocations, licences, queries, secrets_scan

QUERIES = {
    "op1_sharding": queries.op1_sharding,
    "op2_ngram_jaccard_join": queries.op2_ngram_jaccard_join,
    "op3_quality_rules": queries.op3_quality_rules,
    "op4_token_counts": queries.op4_token_counts,
    "op5_language_id": queries.op5_language_id,
    "op6_bpe_round_trip": queries.op6_bpe_round_trip,
    "op7_licence_scan": queries.op7_licence_scan,
    "op8_chat_format": queries.op8_chat_format,
    "op9_exact_dedup": queries.op9_exact_dedup,
    "op10_best_fit_packing": queries.op10_best_fit_packing,
    "op11_collocations": queries.op11_collocations,
    "op12_secret_scan": queries.op12_secret_scan,
    "op13_hard_negatives": queries.op13_hard_negatives,
}

ORACLES = {
    "op2_ngram_jaccard_join": queries.OP2_SQL,
    "op7_licence_scan": licences.oracle_sql(),
    "op8_chat_format": queries.OP8_SQL,
    "op9_exact_dedup": queries.OP9_SQL,
    "op11_collocations": collocations.oracle_sql(),
    "op12_secret_scan": secrets_scan.oracle_sql(),
    "op13_hard_negatives": queries.OP13_SQL,
}
