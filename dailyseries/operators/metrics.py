"""Evaluation metrics (G1-G11) as DataFrame aggregations.

Every metric reads a ``(y, p[, pred])`` table and takes optional group
columns ``by`` so many models, splits or folds score in one job.  Curve
metrics (AUC, ROC, average precision) collapse rows to distinct scores
first and use the bucketed ``running_sum`` -- never a single-partition
window -- so they hold when scores are nearly unique.  They are exact and
tie-aware (half credit for tied scores).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dailyseries.plans.ranking import join_groups, quantile_row, running_sum
from dailyseries.session import checkpoint_dir

# fixed values: report bands and analysis cut-offs of the reference
BANDS = ((0.9, "Excellent"), (0.8, "Good"), (0.7, "Fair"))
HIGH_CONFIDENCE, LOW_CONFIDENCE = 0.8, 0.2
ANALYSIS_PERCENTILES = (10, 25, 50, 75, 90, 95, 99)


def _div(a: Column, b: Column, zero: float | None = 0.0) -> Column:
    """a / b with the metric libraries' zero-division rule (0 by default)."""
    return F.when(b != 0, a / b).otherwise(F.lit(zero).cast("double"))


def score_counts(df: DataFrame, y: str = "y", p: str = "p", by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score (partial + final aggregate)."""
    return df.groupBy(*by, p).agg(
        F.sum(F.when(F.col(y) == 1, 1).otherwise(0)).cast("long").alias("pos"),
        F.sum(F.when(F.col(y) == 0, 1).otherwise(0)).cast("long").alias("neg"))


def roc_auc(df: DataFrame, y: str = "y", p: str = "p", by: Sequence[str] = ()) -> DataFrame:
    """G1: area under the ROC curve with ties at half credit; null when one
    class is absent (the reference raises)."""
    c = running_sum(score_counts(df, y, p, by), p, ["neg"], by)
    a = c.groupBy(*by).agg(
        F.sum(F.col("pos") * (F.col("neg_before") + 0.5 * F.col("neg"))).alias("_s"),
        F.sum("pos").alias("_P"), F.sum("neg").alias("_N"))
    return a.select(*by, F.when((F.col("_P") > 0) & (F.col("_N") > 0),
                                F.col("_s") / (F.col("_P").cast("double") * F.col("_N"))).alias("auc_score"))


def _cumulative(df: DataFrame, y: str, p: str, by: Sequence[str], prev: bool = False) -> DataFrame:
    """Per distinct score: pos, neg, tps/fps (scores >= p), totals P, N."""
    c = score_counts(df, y, p, by)
    rs = running_sum(c, p, ["pos", "neg"], by, prev_cols=["pos", "neg"] if prev else ())
    # totals are named _tp/_tn: Spark resolves names case-insensitively ("P" vs "p")
    tot = c.groupBy(*by).agg(F.sum("pos").alias("_tp"), F.sum("neg").alias("_tn"))
    j = join_groups(rs, tot, by)
    return j.withColumns({"tps": F.col("_tp") - F.col("pos_before"), "fps": F.col("_tn") - F.col("neg_before")})


def roc_curve(df: DataFrame, y: str = "y", p: str = "p", by: Sequence[str] = ()) -> DataFrame:
    """ROC points (fpr, tpr, threshold) with collinear points dropped and
    the (0, 0, +inf) origin prepended."""
    c = _cumulative(df, y, p, by, prev=True)
    is_max = ((F.col("pos_before") + F.col("pos") == F.col("_tp"))
              & (F.col("neg_before") + F.col("neg") == F.col("_tn")))
    keep = (F.col("_prev_pos").isNull() | is_max | (F.col("_prev_pos") != F.col("pos"))
            | (F.col("_prev_neg") != F.col("neg")))
    pts = c.where(keep).select(*by, _div(F.col("fps"), F.col("_tn"), None).alias("fpr"),
                               _div(F.col("tps"), F.col("_tp"), None).alias("tpr"),
                               F.col(p).cast("double").alias("threshold"))
    # one origin row per group, from the (already aggregated) distinct-score table
    origin = c.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).select(
        *by, F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"), F.lit(float("inf")).alias("threshold"))
    return pts.unionByName(origin)


def average_precision(df: DataFrame, y: str = "y", p: str = "p", by: Sequence[str] = ()) -> DataFrame:
    """Sum over thresholds of (R_n - R_{n-1}) * P_n."""
    c = _cumulative(df, y, p, by)
    term = F.col("pos") / F.col("_tp") * (F.col("tps") / (F.col("tps") + F.col("fps")))
    return c.groupBy(*by).agg(F.sum(F.when(F.col("_tp") > 0, term)).alias("average_precision"))


def confusion(df: DataFrame, y: str = "y", pred: str = "pred", by: Sequence[str] = ()) -> DataFrame:
    yy, pp = F.col(y), F.col(pred)
    cnt = lambda cond: F.sum(F.when(cond, 1).otherwise(0)).cast("long")
    return df.groupBy(*by).agg(cnt((yy == 1) & (pp == 1)).alias("tp"), cnt((yy == 0) & (pp == 1)).alias("fp"),
                               cnt((yy == 1) & (pp == 0)).alias("fn"), cnt((yy == 0) & (pp == 0)).alias("tn"))


def f1_accuracy(df: DataFrame, y: str = "y", pred: str = "pred", by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 (zero division -> 0) and accuracy of the positive class."""
    c = confusion(df, y, pred, by)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    prec, rec = _div(tp, tp + fp), _div(tp, tp + fn)
    return c.select(*by, prec.alias("precision"), rec.alias("recall"),
                    _div(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
                    _div(tp + tn, tp + fp + fn + tn).alias("accuracy"))


def classification_report(df: DataFrame, y: str = "y", pred: str = "pred", by: Sequence[str] = ()) -> DataFrame:
    """Per-class precision/recall/F1/support, accuracy, macro and weighted averages."""
    c = confusion(df, y, pred, by)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    # class 1 counts as positive; for class 0 the roles swap
    p1, r1, f1 = _div(tp, tp + fp), _div(tp, tp + fn), _div(2 * tp, 2 * tp + fp + fn)
    p0, r0, f0 = _div(tn, tn + fn), _div(tn, tn + fp), _div(2 * tn, 2 * tn + fn + fp)
    s1, s0 = tp + fn, tn + fp
    rows = F.array(
        F.struct(F.lit("0").alias("label"), p0.alias("precision"), r0.alias("recall"), f0.alias("f1_score"), s0.alias("support")),
        F.struct(F.lit("1").alias("label"), p1.alias("precision"), r1.alias("recall"), f1.alias("f1_score"), s1.alias("support")),
        F.struct(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), _div(tp + tn, n).alias("f1_score"), n.alias("support")),
        F.struct(F.lit("macro avg").alias("label"), ((p0 + p1) / 2).alias("precision"), ((r0 + r1) / 2).alias("recall"),
                 ((f0 + f1) / 2).alias("f1_score"), n.alias("support")),
        F.struct(F.lit("weighted avg").alias("label"), _div(p0 * s0 + p1 * s1, n).alias("precision"),
                 _div(r0 * s0 + r1 * s1, n).alias("recall"), _div(f0 * s0 + f1 * s1, n).alias("f1_score"),
                 n.alias("support")))
    return c.select(*by, F.inline(rows))


def regression_metrics(df: DataFrame, y: str, yhat: str, by: Sequence[str] = ()) -> DataFrame:
    """RMSE, MAE, R^2 (= 1 - SSE/SST; constant y gives 1 if perfect else 0)."""
    e = F.col(y) - F.col(yhat)
    a = df.where(F.col(y).isNotNull() & F.col(yhat).isNotNull()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.sum(e * e).alias("_sse"), F.sum(F.abs(e)).alias("_sae"),
        F.avg(y).alias("_mean"), F.var_pop(y).alias("_var"))
    sst = F.col("_var") * F.col("n")
    r2 = (F.when(sst != 0, 1 - F.col("_sse") / sst)
           .when(F.col("_sse") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    return a.select(*by, "n", F.sqrt(F.col("_sse") / F.col("n")).alias("rmse"),
                    (F.col("_sae") / F.col("n")).alias("mae"), r2.alias("r2"))


def score_stats(df: DataFrame, p: str = "p", by: Sequence[str] = ()) -> DataFrame:
    """Mean, population std, min, max, exact median of the scores."""
    a = df.groupBy(*by).agg(F.avg(p).alias("mean"), F.stddev_pop(p).alias("std"),
                            F.min(p).cast("double").alias("min"), F.max(p).cast("double").alias("max"))
    med = quantile_row(df, p, [0.5], ["median"], by)
    return join_groups(a, med, by)


def class_analysis(df: DataFrame, y: str = "y", p: str = "p", pred: str = "pred",
                   by: Sequence[str] = ()) -> DataFrame:
    """Mean score of positives / negatives (the reference calls them
    true/false positive rate), predicted-label counts, % predicted zero."""
    return df.groupBy(*by).agg(
        F.avg(F.when(F.col(y) == 1, F.col(p))).alias("true_positive_rate"),
        F.avg(F.when(F.col(y) == 0, F.col(p))).alias("false_positive_rate"),
        F.sum(F.when(F.col(pred) == 0, 1).otherwise(0)).cast("long").alias("pred_0_count"),
        F.sum(F.when(F.col(pred) == 1, 1).otherwise(0)).cast("long").alias("pred_1_count"),
        (F.avg(F.when(F.col(pred) == 0, 1.0).otherwise(0.0)) * 100).alias("zero_predictions_percentage"))


def performance_band(auc: Column) -> Column:
    e = F.when(auc > BANDS[0][0], BANDS[0][1])
    for t, name in BANDS[1:]:
        e = e.when(auc > t, name)
    return e.otherwise("Poor")


def score_table(df: DataFrame, y: str = "y", p: str = "p", pred: str = "pred", by: Sequence[str] = ()) -> DataFrame:
    """Rows per (score, label, predicted label) as ``_n``: all that the metrics of a
    model need, in as many rows as there are distinct scores."""
    return df.groupBy(*by, p, y, pred).agg(F.count(F.lit(1)).alias("_n"))


def evaluation_report(df: DataFrame, y: str = "y", p: str = "p", pred: str = "pred",
                      model_name: str = "Model", by: Sequence[str] = ()) -> DataFrame:
    """AUC, score statistics, class analysis and summary in one row per group.

    The source is read once, for the score table; counts and means are weighted
    sums over it, and AUC, median and deviation share one running sum over
    its distinct scores.  A null score counts as a row, and as the lowest for
    the AUC, and in no statistic of the scores."""
    by = list(by)
    checkpoint_dir(df.sparkSession)
    table = score_table(df, y, p, pred, by).checkpoint(eager=True)
    n, held = F.col("_n"), F.col(p).isNotNull()

    def rows(cond: Column) -> Column:
        return F.sum(F.when(cond, n).otherwise(0)).cast("long")

    def mean_of(cond: Column) -> Column:
        return _div(F.sum(F.when(cond, F.col(p) * n)), rows(cond & held), None)

    total = F.sum("_n")
    head = table.groupBy(*by).agg(
        F.coalesce(total, F.lit(0)).alias("total_samples"), rows(F.col(y) == 1).alias("positive_samples"),
        rows(F.col(y) == 0).alias("negative_samples"), (rows(F.col(y) == 1) / total * 100).alias("positive_rate"),
        rows(held).alias("_k"), mean_of(held).alias("mean"), F.min(p).cast("double").alias("min"), F.max(p).cast("double").alias("max"),
        mean_of(F.col(y) == 1).alias("true_positive_rate"), mean_of(F.col(y) == 0).alias("false_positive_rate"),
        rows(F.col(pred) == 0).alias("pred_0_count"), rows(F.col(pred) == 1).alias("pred_1_count"),
        (rows(F.col(pred) == 0) / total * 100).alias("zero_predictions_percentage"))
    scores = table.groupBy(*by, p).agg(rows(F.col(y) == 1).alias("pos"), rows(F.col(y) == 0).alias("neg"), rows(held).alias("_n"))
    cum = join_groups(running_sum(scores, p, ["neg", "_n"], by), head.select(*by, "_k", "mean"), by)
    middle = [F.max(F.when((F.col("_n_before") <= k) & (k < F.col("_n_before") + n), F.col(p)))
              for k in (F.floor((F.col("_k") - 1) / 2), F.ceil((F.col("_k") - 1) / 2))]
    curve = cum.groupBy(*by).agg(
        F.sum(F.col("pos") * (F.col("neg_before") + 0.5 * F.col("neg"))).alias("_s"), F.sum("pos").alias("_tp"),
        F.sum("neg").alias("_tn"), ((middle[0] + middle[1]) / 2).cast("double").alias("median"),
        F.sqrt(_div(F.sum(n * (F.col(p) - F.col("mean")) * (F.col(p) - F.col("mean"))), F.max("_k"), None)).alias("std"))
    auc = F.when((F.col("_tp") > 0) & (F.col("_tn") > 0), F.col("_s") / (F.col("_tp").cast("double") * F.col("_tn")))
    out = join_groups(head, curve, by).withColumn("auc_score", auc)
    return out.select(F.lit(model_name).alias("model_name"), *by, *[c for c in (
        "total_samples", "positive_samples", "negative_samples", "positive_rate", "auc_score", "mean", "std", "min", "max",
        "median", "true_positive_rate", "false_positive_rate", "pred_0_count", "pred_1_count", "zero_predictions_percentage")],
        performance_band(F.col("auc_score")).alias("model_performance"))


def prediction_analysis(df: DataFrame, p: str = "p", by: Sequence[str] = ()) -> DataFrame:
    """Unlabelled score analysis with exact percentiles 10..99."""
    x = F.col(p)
    a = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_predictions"), F.avg(x).alias("mean_probability"),
        F.stddev_pop(x).alias("std_probability"), F.min(x).cast("double").alias("min_probability"),
        F.max(x).cast("double").alias("max_probability"),
        F.count_if(x > HIGH_CONFIDENCE).alias("high_confidence_predictions"),
        F.count_if(x < LOW_CONFIDENCE).alias("low_confidence_predictions"),
        F.count_if((x >= LOW_CONFIDENCE) & (x <= HIGH_CONFIDENCE)).alias("uncertain_predictions"))
    probs = [0.5] + [q / 100 for q in ANALYSIS_PERCENTILES]
    names = ["median_probability"] + [f"percentile_{q}" for q in ANALYSIS_PERCENTILES]
    q = quantile_row(df, p, probs, names, by)
    return join_groups(a, q, by)


def validate_predictions(df: DataFrame, p: str = "p", by: Sequence[str] = ()) -> DataFrame:
    """True when no score is NaN/null, infinite or outside [0, 1]; empty is valid.

    NaN is tested first: in Spark NaN compares greater than every number."""
    x = F.col(p)
    bad_nan = x.isNull() | F.isnan(x)
    bad = bad_nan | (~bad_nan & ((x < 0) | (x > 1)))
    return df.groupBy(*by).agg((F.count_if(bad) == 0).alias("is_valid"))
