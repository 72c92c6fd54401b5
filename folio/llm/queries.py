"""The operators' queries: name -> callable, and DuckDB SQL where it can express them."""

from __future__ import annotations

from folio.llm import ann, bpe, conversation_repair, decontaminate, embedding_dedup, jaccard_join, langid, lexical_search, license_scan, lm_score, token_counts, toxicity, url_filter

QUERIES = {
    "op1_bpe": bpe.op1_bpe,
    "op2_nearest": ann.op2_nearest,
    "op3_token_counts": token_counts.op3_token_counts,
    "op4_language_id": langid.op4_language_id,
    "op5_decontaminate": decontaminate.op5_decontaminate,
    "op6_lm_score": lm_score.op6_lm_score,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_url_filter": url_filter.op8_url_filter,
    "op9_license_scan": license_scan.op9_license_scan,
    "op10_jaccard_join": jaccard_join.op10_jaccard_join,
    "op11_conversation_repair": conversation_repair.op11_conversation_repair,
    "op12_lexical_search": lexical_search.op12_lexical_search,
    "op13_embedding_dedup": embedding_dedup.op13_embedding_dedup,
}
ORACLE_SQL = {
    "op8_url_filter": url_filter.oracle(),
    "op9_license_scan": license_scan.oracle(),
    "op11_conversation_repair": conversation_repair.oracle(),
    "op12_lexical_search": lexical_search.ORACLE,
    "op13_embedding_dedup": embedding_dedup.ORACLE,
}
