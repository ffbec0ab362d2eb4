"""The registered queries of the corpus operators, and their SQL."""

from __future__ import annotations

from texloam.llm import (
    bpe,
    exact_dedup,
    language_id,
    licenses,
    line_dedup,
    merkle,
    order_minhash,
    packing,
    quality,
    secrets,
    sharding,
    simhash_trie,
    whitening,
)

QUERIES = {
    "op1_exact_dedup": exact_dedup.query,
    "op2_secret_scan": secrets.query,
    "op3_line_dedup": line_dedup.query,
    "op4_byte_bpe": bpe.query,
    "op5_license_scan": licenses.query,
    "op6_quality_classifier": quality.query,
    "op7_order_minhash": order_minhash.query,
    "op8_language_id": language_id.query,
    "op9_simhash_trie": simhash_trie.query,
    "op10_best_fit_packing": packing.query,
    "op11_embedding_whitening": whitening.query,
    "op12_merkle_manifest": merkle.query,
    "op13_kd_sharding": sharding.query,
}

ORACLES = {
    "op1_exact_dedup": exact_dedup.SQL,
    "op3_line_dedup": line_dedup.SQL,
    "op12_merkle_manifest": merkle.SQL,
}
