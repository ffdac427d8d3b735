"""The contract's queries of this subpackage and, where SQL can express one, its DuckDB SQL."""

from __future__ import annotations

from quarry.llm import (decontaminate, jaccard, lm_scoring, periodic_runs, pieces_codec, pii, quality, quality_pu,
                        ranked_search, suffix_dedup, token_counts, token_files, url_filter)

QUERIES = {
    "op1_prefix_free_parsing": suffix_dedup.op1_prefix_free_parsing,
    "op2_wu_manber": decontaminate.op2_wu_manber,
    "op3_quality_divergence": quality.op3_quality_divergence,
    "op4_token_counts": token_counts.op4_token_counts,
    "op5_sentencepiece_chunks": pieces_codec.op5_sentencepiece_chunks,
    "op6_jaccard_join": jaccard.op6_jaccard_join,
    "op7_pii_boosting": pii.op7_pii_boosting,
    "op8_attention_lm": lm_scoring.op8_attention_lm,
    "op9_url_filter": url_filter.op9_url_filter,
    "op10_token_files": token_files.op10_token_files,
    "op11_bag_search": ranked_search.op11_bag_search,
    "op12_quality_pu": quality_pu.op12_quality_pu,
    "op13_periodic_runs": periodic_runs.op13_periodic_runs,
}

ORACLE_SQL = {
    "op2_wu_manber": decontaminate.OP2_SQL,
    "op6_jaccard_join": jaccard.OP6_SQL,
    "op11_bag_search": ranked_search.OP11_SQL,
}
