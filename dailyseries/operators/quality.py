"""Data-quality reports (A1-A3) and schema contracts.

A report is ONE aggregation per table (null counts of every column in a
single ``agg``) plus one grouping over all columns for duplicate rows;
column kinds come from the schema without a job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType, StringType

from dailyseries.plans.ranking import join_groups


def _missing(df: DataFrame, c: str):
    x = F.col(c)
    t = df.schema[c].dataType
    miss = x.isNull() | F.isnan(x) if isinstance(t, (DoubleType, FloatType)) else x.isNull()
    return F.sum(F.when(miss, 1).otherwise(0))


def quality_report(df: DataFrame, name: str) -> DataFrame:
    """A1: rows, columns, missing cells (NaN counts), missing %, duplicate rows
    (nulls equal), numeric and text column counts -- one row."""
    cols = df.columns
    numeric = sum(isinstance(f.dataType, NumericType) for f in df.schema.fields)
    text = sum(isinstance(f.dataType, StringType) for f in df.schema.fields)
    base = df.agg(F.count(F.lit(1)).alias("rows"),
                  sum((_missing(df, c) for c in cols), F.lit(0)).cast("long").alias("missing_values"))
    dup = (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_c"))
             .agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("long").alias("duplicate_rows")))
    cells = F.col("rows") * len(cols)
    out = join_groups(base, dup, [])  # two one-row aggregates
    return out.select(F.lit(name).alias("dataset"), "rows", F.lit(len(cols)).alias("columns"), "missing_values",
                      F.when(cells > 0, F.col("missing_values") / cells * 100).alias("missing_percentage"),
                      "duplicate_rows", F.lit(numeric).alias("numeric_columns"),
                      F.lit(text).alias("categorical_columns"))


def quality_reports(tables: Mapping[str, DataFrame]) -> DataFrame:
    """A1 over a dict of tables (the reference's dataset dict), one row each."""
    out = None
    for name, df in tables.items():
        r = quality_report(df, name)
        out = r if out is None else out.unionByName(r)
    return out


def player_quality(df: DataFrame, key: str = "player_id") -> DataFrame:
    """A2: distinct ids (nulls excluded) and duplicated ids (null counts once)."""
    return df.agg(
        F.count_distinct(key).alias("unique_players"),
        (F.count(F.lit(1)) - F.count_distinct(key)
         - F.max(F.when(F.col(key).isNull(), 1).otherwise(0))).cast("long").alias("duplicate_players"))


def draft_quality(df: DataFrame, label: str = "drafted") -> DataFrame:
    """A3: draft rate (mean * 100, nulls excluded) with the label counts."""
    rate = df.agg((F.avg(label) * 100).alias("draft_rate"))
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    return join_groups(counts, rate, [])


def ensure_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> None:
    """Raise if any (given) column is not numeric; booleans are not."""
    cols = list(columns) if columns is not None else df.columns
    bad = [c for c in cols if not isinstance(df.schema[c].dataType, NumericType)]
    if bad:
        raise ValueError(f"Non-numeric columns found in X: {bad}")


def split_contract(df: DataFrame, label: str, split_col: str = "split") -> DataFrame:
    """Rows per split and rows whose label is missing (must be 0 for
    train and val) -- one grouped job."""
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("rows"),
                                     F.count_if(F.col(label).isNull()).alias("missing_labels"))


def validate_shapes(train: DataFrame, val: DataFrame, test: DataFrame) -> None:
    """Equal feature counts across X frames (schema only)."""
    n = len(train.columns)
    for nm, d in (("X_val", val), ("X_test", test)):
        if len(d.columns) != n:
            raise ValueError(f"Feature dimension mismatch: X_train has {n} features, {nm} has {len(d.columns)}")
