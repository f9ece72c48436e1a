"""Queries of this subpackage, and the SQL that checks them."""

from __future__ import annotations

from tablex.llm import decontaminate, fim, language_id, license_scan, line_dedup, mixing, near_dedup, quality_classifier, quality_rules, spelling, token_files, toxicity, warc

MODULES = (quality_rules, decontaminate, mixing, quality_classifier, language_id, license_scan, line_dedup, warc, near_dedup, token_files, fim, spelling, toxicity)

QUERIES = {name: run for module in MODULES for name, run in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
