"""Imports every query module so the registry is complete."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dailyseries.plans import q_explore, q_metrics, q_models, q_pipeline, q_scoring, q_sources, q_windows  # noqa: F401
from dailyseries.plans.registry import EXACT, ORACLE, QUERIES


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leak-safe regression feature pipeline (one table with split,
    target and 142 scaled features)."""
    return EXACT["pipeline_regression"](spark, sf_dir)


__all__ = ["ORACLE", "QUERIES", "flagship"]
