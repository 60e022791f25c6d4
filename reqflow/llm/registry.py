"""The named corpus queries and, where SQL can express them, their DuckDB text."""

from __future__ import annotations

from reqflow.llm import bpe, chat_format, exact_dedup, license_scan, lm_score, near_dedup, packing, periodic, pii, prefix_trie, quality, token_count, warc


def queries() -> dict:
    return {
        "op1_best_fit_packing": packing.op1_best_fit_packing,
        "op2_license_scan": license_scan.op2_license_scan,
        "op3_quality_rules": quality.op3_quality_rules,
        "op4_pii_surrogates": pii.op4_pii_surrogates,
        "op5_lm_score": lm_score.op5_lm_score,
        "op6_warc_transactions": warc.op6_warc_transactions,
        "op7_near_dedup": near_dedup.op7_near_dedup,
        "op8_token_counts": token_count.op8_token_counts,
        "op9_exact_dedup": exact_dedup.op9_exact_dedup,
        "op10_bpe_round_trip": bpe.op10_bpe_round_trip,
        "op11_prefix_trie": prefix_trie.op11_prefix_trie,
        "op12_chat_format": chat_format.op12_chat_format,
        "op13_periodic_runs": periodic.op13_periodic_runs,
    }


def oracle_sql() -> dict[str, str]:
    return {"op6_warc_transactions": warc.OP6_SQL, "op9_exact_dedup": exact_dedup.OP9_SQL}
