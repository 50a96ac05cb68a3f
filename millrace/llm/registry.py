"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from . import decontamination, line_dedup, packing, paragraph_dedup, quality, simhash, suffix_dedup, token_files, toxicity, zip_archive

QUERIES = [paragraph_dedup.op1_paragraph_dedup, suffix_dedup.op5_suffix_dedup, toxicity.op6_toxicity, zip_archive.op2_zip_warc, line_dedup.op8_line_dedup, decontamination.op9_decontamination, simhash.op3_simhash, packing.op4_best_two_fit, token_files.op7_token_files, quality.op10_quality]
SQL: dict[str, str] = {"op10_quality": quality.SQL, "op9_decontamination": decontamination.SQL, "op2_zip_warc": zip_archive.SQL}


def queries() -> dict:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
