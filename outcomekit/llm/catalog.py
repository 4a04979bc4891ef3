"""Registered queries of the text operators: name -> callable, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from outcomekit.llm import (concat_cut, content_sort, feistel_pii, filter_audit, licence_scan, mixing,
                            ordinal_quality, packing, parity_join, repair_tokens, toxicity, vertical_scan, winnowing)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": packing.query,
    "op2_licence_scan": licence_scan.query,
    "op3_winnowing": winnowing.query,
    "op4_parity_sketch_join": parity_join.query,
    "op5_ordinal_quality": ordinal_quality.query,
    "op6_feistel_pii": feistel_pii.query,
    "op7_toxicity_grammar": toxicity.query,
    "op8_repair_tokens": repair_tokens.query,
    "op9_sainte_lague_mix": mixing.query,
    "op10_content_sort_dedup": content_sort.query,
    "op11_vertical_scan": vertical_scan.query,
    "op12_filter_audit": filter_audit.query,
    "op13_concat_cut": concat_cut.query,
}
ORACLE: dict[str, str] = {
    "op10_content_sort_dedup": content_sort.SQL,
    "op11_vertical_scan": vertical_scan.SQL,
    "op12_filter_audit": filter_audit.SQL,
}
