"""The registered queries of this subpackage and their DuckDB SQL (None: none)."""

from __future__ import annotations

from . import ann, conversations, decontaminate, fingerprints, neardup, pieces, pii, quality, substring_dedup, suffix_dedup, token_store, variants, warc

QUERIES = {
    "op1_pii": (pii.op1_pii, None),
    "op2_warc": (warc.op2_warc, warc.ORACLE_SQL),
    "op3_quality_rules": (quality.op3_quality_rules, None),
    "op4_suffix_dedup": (suffix_dedup.op4_suffix_dedup, suffix_dedup.ORACLE_SQL),
    "op5_sentencepiece": (pieces.op5_sentencepiece, None),
    "op6_token_store": (token_store.op6_token_store, None),
    "op7_benchmark_decontamination": (decontaminate.op7_benchmark_decontamination, decontaminate.ORACLE_SQL),
    "op8_multi_index_ann": (ann.op8_multi_index_ann, None),
    "op9_neardup": (neardup.op9_neardup, None),
    "op10_substring_dedup": (substring_dedup.op10_substring_dedup, substring_dedup.ORACLE_SQL),
    "op11_conversation_repair": (conversations.op11_conversation_repair, conversations.ORACLE_SQL),
    "op12_document_fingerprints": (fingerprints.op12_document_fingerprints, fingerprints.ORACLE_SQL),
    "op13_spelling_variants": (variants.op13_spelling_variants, variants.ORACLE_SQL),
}
