"""Query registry: name -> (Spark callable, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dailyseries.functions.scalar import round6

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}
EXACT: dict[str, QueryFn] = {}  # the same queries with unrounded doubles


def query(name: str, sql: str | None = None, rounded: bool = True):
    """Register ``fn(spark, sf_dir) -> DataFrame``; doubles are rounded to 6
    decimals on output (the oracle SQL rounds the same columns)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(spark, sf_dir)
            return round_doubles(df) if rounded else df

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        EXACT[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def round_doubles(df: DataFrame) -> DataFrame:
    return df.select(*[round6(c).alias(c) if t in ("double", "float") else F.col(c)
                       for c, t in df.dtypes])
