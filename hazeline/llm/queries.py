"""One query per operator, over whole tables with production parameters, and their SQL."""

from __future__ import annotations

from hazeline.llm import (
    byte_bpe, licences, merkle, minhash, oracles, outliers, packing, periodic_runs, projections, quality,
    sentence_spans, simhash, tag_paths, toxicity,
)

QUERIES = {
    "op1_simhash_near_dedup": simhash.query,
    "op2_tag_paths": tag_paths.query,
    "op3_robust_outliers": outliers.query,
    "op4_projection_links": projections.query,
    "op5_lexical_packing": packing.query,
    "op6_byte_bpe": byte_bpe.query,
    "op7_licence_scan": licences.query,
    "op8_ordinal_quality": quality.query,
    "op9_sentence_spans": sentence_spans.query,
    "op10_toxicity": toxicity.query,
    "op11_periodic_runs": periodic_runs.query,
    "op12_merkle_manifest": merkle.query,
    "op13_minhash_fingerprints": minhash.query,
}

ORACLES: dict[str, str] = {"op12_merkle_manifest": oracles.merkle()}
