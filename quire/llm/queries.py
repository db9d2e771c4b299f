"""What the entry module registers for this subpackage."""

from __future__ import annotations

from quire.llm import bpe, language, media, merkle, neardup, packing, periodic, pii, repeats, resampling, secrets, shinglejoin, toxicity

QUERIES = {
    "op1_suffix_dedup": repeats.query,
    "op2_media_columns": media.query,
    "op3_language_id": language.query,
    "op4_minhash_neardup": neardup.query,
    "op5_merkle_fingerprints": merkle.query,
    "op6_bpe": bpe.query,
    "op7_secret_scans": secrets.query,
    "op8_toxicity": toxicity.query,
    "op9_packing": packing.query,
    "op10_pii": pii.query,
    "op11_importance_resampling": resampling.query,
    "op12_shingle_join": shinglejoin.query,
    "op13_periodic_runs": periodic.query,
}

ORACLES: dict[str, str] = {"op5_merkle_fingerprints": merkle.ORACLE, "op11_importance_resampling": resampling.ORACLE}
