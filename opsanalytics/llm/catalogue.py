"""Registry of the corpus queries and their SQL twins."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

MODULES = (
    "op1_exact_dedup",
    "op2_language_id",
    "op3_quality_crf",
    "op4_run_index",
    "op5_latent_decontamination",
    "op6_pieces",
    "op7_jaccard_join",
    "op8_suffix_trees",
    "op9_chat_format",
    "op10_toxicity",
    "op11_spelling_variants",
    "op12_secret_scan",
    "op13_laesa_clusters",
)


def corpus_query(name: str, sql: str | None = None):
    def register(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return register


def load_all() -> None:
    for module in MODULES:
        importlib.import_module(f"opsanalytics.llm.{module}")
