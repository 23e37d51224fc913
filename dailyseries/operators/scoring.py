"""Scoring helpers: labels, confidence, top-k, model ranking, class
weight, baselines and submission frames (O2, O4, M8, M9, M11, M12, A5, S6)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dailyseries.plans.ranking import join_groups


def predict_labels(df: DataFrame, p: str = "p", threshold: float = 0.5, out: str = "pred") -> DataFrame:
    """label = p >= threshold."""
    return df.withColumn(out, (F.col(p) >= threshold).cast("int"))


def label_counts(df: DataFrame, pred: str = "pred") -> DataFrame:
    """How many rows got each label."""
    return df.groupBy(pred).agg(F.count(F.lit(1)).alias("count"))


def confidence(df: DataFrame, p: str = "p", out: str = "confidence") -> DataFrame:
    """Distance from 0.5, scaled to [0, 1]."""
    return df.withColumn(out, F.abs(F.col(p) - 0.5) * 2)


def top_predictions(df: DataFrame, p: str = "p", key: str = "player_id", k: int = 10,
                    out: str = "draft_probability") -> DataFrame:
    """O2: the k highest scores, ties by key (a top-k report: the limit is the feature).
    Plans as ``TakeOrderedAndProject``: each task keeps k rows."""
    return df.select(key, F.col(p).alias(out)).orderBy(F.col(out).desc(), F.col(key).asc()).limit(k)


def compare_models(metrics: DataFrame, sort_col: str = "auc_score") -> DataFrame:
    """One row per model sorted by ``sort_col`` descending, nulls last."""
    if sort_col not in metrics.columns:
        return metrics
    return metrics.orderBy(F.col(sort_col).desc_nulls_last(), F.col("model_name"))


def scale_pos_weight(df: DataFrame, y: str = "y", by: Sequence[str] = ()) -> DataFrame:
    """A5: negatives / positives; 1.0 when there is no positive."""
    pos = F.sum(F.when(F.col(y) == 1, 1).otherwise(0))
    neg = F.sum(F.when(F.col(y) == 0, 1).otherwise(0))
    return df.groupBy(*by).agg(F.when(pos == 0, F.lit(1.0)).otherwise(neg / pos).alias("scale_pos_weight"))


def stack_models(df: DataFrame, scores: Mapping[str, Column], keep: Sequence[str] = ("y",)) -> DataFrame:
    """Long (model_name, keep..., p) frame from several score columns, so all
    models are evaluated by ONE grouped metric job."""
    arr = F.array(*[F.struct(F.lit(name).alias("model_name"), c.cast("double").alias("p"))
                    for name, c in scores.items()])
    return df.select(*keep, F.inline(arr))


def mean_predictor(df: DataFrame, target: str, split_col: str = "split", out: str = "pred_mean") -> DataFrame:
    """M8: predict the training mean everywhere."""
    m = df.where(F.col(split_col) == "train").agg(F.avg(target).alias(out))
    return join_groups(df, m, [])


def majority_predictor(df: DataFrame, y: str = "y", split_col: str = "split", out: str = "p_major") -> DataFrame:
    """M9: most frequent training class (ties -> smallest) as a 0/1 probability."""
    c = (df.where(F.col(split_col) == "train").groupBy(y).agg(F.count(F.lit(1)).alias("_n"))
           .agg(F.max_by(F.col(y), F.struct(F.col("_n"), -F.col(y))).cast("double").alias(out)))
    return join_groups(df, c, [])


def submission(df: DataFrame, p: str = "p", key: str = "player_id") -> DataFrame:
    """``player_id, drafted`` where ``drafted`` holds the probability."""
    return df.select(key, F.col(p).cast("double").alias("drafted"))
