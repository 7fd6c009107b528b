"""Queries of the llm operators, and SQL for those that SQL can express."""

from __future__ import annotations

from gneiss.llm import decontamination, fingerprints, html, licenses, near_dedup, pieces, quality, scoring, sharding, surrogates

QUERIES = {
    "op1_minhash_dedup": near_dedup.op1_minhash_dedup,
    "op2_pii_surrogates": surrogates.op2_pii_surrogates,
    "op3_extendible_sharding": sharding.op3_extendible_sharding,
    "op4_quality_classifier": quality.op4_quality_classifier,
    "op5_sentencepiece": pieces.op5_sentencepiece,
    "op6_license_scan": licenses.op6_license_scan,
    "op7_decontamination": decontamination.op7_decontamination,
    "op8_html_extraction": html.op8_html_extraction,
    "op9_fingerprints": fingerprints.op9_fingerprints,
    "op10_lm_scoring": scoring.op10_lm_scoring,
}

ORACLES = {
    "op3_extendible_sharding": sharding.ORACLE_SQL,
    "op6_license_scan": licenses.ORACLE_SQL,
    "op7_decontamination": decontamination.ORACLE_SQL,
}
