"""The text queries and their SQL, for the driver's registry."""

from __future__ import annotations

import corpus_pipeline
from passbook.llm import (
    decontaminate,
    exact,
    language,
    line_dedup,
    minhash,
    mixing,
    packing,
    pii,
    prefix_trie,
    resampling,
    substrings,
    token_counts,
    token_output,
)


def queries() -> dict:
    return {
        "op1_line_dedup": line_dedup.op1_line_dedup,
        "op2_token_counts": token_counts.op2_token_counts,
        "op3_token_output": token_output.op3_token_output,
        "op4_minhash_near_dedup": minhash.op4_minhash_near_dedup,
        "op5_pii": pii.op5_pii,
        "op6_best_fit_packing": packing.op6_best_fit_packing,
        "op7_language_id": language.op7_language_id,
        "op8_decontamination": decontaminate.op8_decontamination,
        "op9_substring_dedup": substrings.op9_substring_dedup,
        "op10_exact_dedup": exact.op10_exact_dedup,
        "op11_context_mixing": mixing.op11_context_mixing,
        "op12_importance_resampling": resampling.op12_importance_resampling,
        "op13_prefix_trie": prefix_trie.op13_prefix_trie,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_line_dedup": line_dedup.OP1_SQL,
        "op8_decontamination": decontaminate.OP8_SQL,
        "op10_exact_dedup": exact.OP10_SQL,
        "op13_prefix_trie": prefix_trie.OP13_SQL,
    }
