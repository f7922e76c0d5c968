"""Queries of the corpus operators and their DuckDB SQL, where SQL can express and afford them."""

from tenderlake.llm import bpe_transducer, collocations, fingerprints, hard_negatives, jaccard_join, language_id, line_dedup, packing, quality, search, slack_packing, substring_dedup, token_counts


def queries() -> dict:
    return {
        "op1_substring_dedup": substring_dedup.query,
        "op2_language_id": language_id.query,
        "op3_topk_search": search.query,
        "op4_line_dedup": line_dedup.query,
        "op5_jaccard_join": jaccard_join.query,
        "op6_packing": packing.query,
        "op7_token_counts": token_counts.query,
        "op8_quality": quality.query,
        "op9_bpe_transducer": bpe_transducer.query,
        "op10_fingerprints": fingerprints.query,
        "op11_collocations": collocations.query,
        "op12_slack_packing": slack_packing.query,
        "op13_hard_negatives": hard_negatives.query,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_substring_dedup": substring_dedup.SQL,
        "op3_topk_search": search.SQL,
        "op5_jaccard_join": jaccard_join.SQL,
        "op11_collocations": collocations.SQL,
        "op13_hard_negatives": hard_negatives.SQL,
    }
