"""All registered queries and the flagship."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import aggregate_queries, extraction_queries, incremental_queries, ledger_queries, record_queries, resolution_queries, retrieval_queries, rule_queries, source_queries, text_queries, workflow_queries  # noqa: F401
from .catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "flagship"]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["hybrid_search"](spark, sf_dir)
