"""The registered queries of the training-data operators and their oracle SQL."""

from __future__ import annotations

from . import (decontaminate, exact_dedup, fingerprints, language_id, line_dedup, merkle, near_dedup, packing, quality, substring_dedup,
               token_counts, warc, whitening)

QUERIES = {
    "op1_language_id": language_id.query,
    "op2_line_dedup": line_dedup.query,
    "op3_exact_dedup": exact_dedup.query,
    "op4_decontamination": decontaminate.query,
    "op5_quality": quality.query,
    "op6_packing": packing.query,
    "op7_near_dedup": near_dedup.query,
    "op8_substring_dedup": substring_dedup.query,
    "op9_warc": warc.query,
    "op10_token_counts": token_counts.query,
    "op11_fingerprints": fingerprints.query,
    "op12_whitening": whitening.query,
    "op13_merkle": merkle.query,
}

ORACLES = {
    "op2_line_dedup": line_dedup.SQL,
    "op3_exact_dedup": exact_dedup.SQL,
    "op7_near_dedup": near_dedup.SQL,
    "op8_substring_dedup": substring_dedup.SQL,
    "op9_warc": warc.SQL,
    "op11_fingerprints": fingerprints.SQL,
    "op13_merkle": merkle.SQL,
}
