"""Queries of the training-data operators and their SQL."""

from __future__ import annotations

import corpus_pipeline
from retentio.llm import (byte_bpe, chat, decontamination, fill_in_middle, license_scan, line_dedup, merkle_manifest,
                          ngram_join, packing, quality_ranking, quality_rules, substring_dedup, url_filter)

QUERIES = {
    "op1_line_dedup": line_dedup.query,
    "op2_substring_dedup": substring_dedup.query,
    "op3_benchmark_decontamination": decontamination.query,
    "op4_ngram_join": ngram_join.query,
    "op5_quality_ranking": quality_ranking.query,
    "op6_best_fit_packing": packing.query,
    "op7_license_scan": license_scan.query,
    "op8_chat_formatting": chat.query,
    "op9_quality_rules": quality_rules.query,
    "op10_url_filter": url_filter.query,
    "op11_merkle_manifest": merkle_manifest.query,
    "op12_fill_in_middle": fill_in_middle.query,
    "op13_byte_bpe": byte_bpe.query,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op1_line_dedup": line_dedup.SQL,
    "op2_substring_dedup": substring_dedup.SQL,
    "op4_ngram_join": ngram_join.SQL,
    "op7_license_scan": license_scan.SQL,
    "op8_chat_formatting": chat.SQL,
    "op9_quality_rules": quality_rules.SQL,
    "op11_merkle_manifest": merkle_manifest.SQL,
    "op12_fill_in_middle": fill_in_middle.SQL,
}

if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
