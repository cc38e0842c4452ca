"""Registered queries of the training-data operators."""

from __future__ import annotations

from kinrank.llm import (bpe, conversations, decontaminate, html_extract, lexical, minhash, oracle, packing, sharding, simhash, substring_dedup,
                         suffix_dedup, token_store, toxicity)


def queries():
    return {
        "op1_suffix_array_dedup": suffix_dedup.op1,
        "op2_benchmark_decontamination": decontaminate.op2,
        "op3_document_fingerprints": minhash.op3,
        "op4_simhash_near_dedup": simhash.op4,
        "op5_best_fit_packing": packing.op5,
        "op6_sharding": sharding.op6,
        "op7_html_extraction": html_extract.op7,
        "op8_token_files": token_store.op8,
        "op9_toxicity": toxicity.op9,
        "op10_substring_dedup": substring_dedup.op10,
        "op11_conversation_repair": conversations.op11,
        "op12_ranked_lexical_search": lexical.op12,
        "op13_byte_level_bpe": bpe.op13,
    }


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
