"""All queries of the feature-screening engine and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

PLANS = ("features", "splits", "metrics", "tables", "funnels", "selections", "monitoring", "models", "artifacts", "families")


def _all(name: str) -> dict:
    return {k: v for plan in PLANS for k, v in getattr(import_module(f"liftwork.plans.{plan}"), name).items()}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _all("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _all("SQL")
