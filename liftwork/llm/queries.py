"""Queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

MODULES = {
    "op1_language_id": "language_id",
    "op2_best_fit_packing": "packing",
    "op3_license_scan": "license_scan",
    "op4_secret_ledger": "secret_ledger",
    "op5_sentencepiece": "sentencepiece_unigram",
    "op6_quality_rules": "quality_rules",
    "op7_suffix_dedup": "suffix_dedup",
    "op8_ann_scan": "ann_scan",
    "op9_chat_format": "chat_format",
    "op10_near_dedup": "near_dedup",
    "op11_block_max_search": "block_max_search",
    "op12_source_mix": "source_mix",
    "op13_filter_audit": "filter_audit",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: getattr(import_module(f"liftwork.llm.{module}"), name) for name, module in MODULES.items()}


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, module in MODULES.items():
        sql = getattr(import_module(f"liftwork.llm.{module}"), "ORACLE_SQL", None)
        if sql:
            out[name] = sql
    return out
