"""Queries of this package and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from lakestrata.llm import (decontamination, hard_negatives, language_id, lattice_lm, license_scan, line_dedup, packing, quality_rules, secret_scan,
                            simhash, spelling_variants, substring_dedup, token_counts)

QUERIES = {
    "op1_quality_rules": quality_rules.query,
    "op2_token_counts": token_counts.query,
    "op3_best_fit_packing": packing.query,
    "op4_license_scan": license_scan.query,
    "op5_language_id": language_id.query,
    "op6_line_dedup": line_dedup.query,
    "op7_simhash": simhash.query,
    "op8_lattice_lm": lattice_lm.query,
    "op9_decontamination": decontamination.query,
    "op10_substring_dedup": substring_dedup.query,
    "op11_spelling_variants": spelling_variants.query,
    "op12_hard_negatives": hard_negatives.query,
    "op13_secret_scan": secret_scan.query,
    "pipeline": corpus_pipeline.run,
}

SQL: dict[str, str] = {
    "op4_license_scan": license_scan.sql(),
    "op6_line_dedup": line_dedup.sql(),
    "op12_hard_negatives": hard_negatives.sql(),
}

if corpus_pipeline.ORACLE_SQL is not None:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
