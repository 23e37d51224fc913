"""Registered queries: evaluation metrics and scoring (G*, O*, M8-M12, A5, S6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from dailyseries.operators import metrics as mt
from dailyseries.operators import scoring as sc
from dailyseries.operators import windows as win
from dailyseries.plans import fixtures as fx
from dailyseries.plans import oracle as o
from dailyseries.plans.registry import query

SCORED = o.SCORED_SQL
R = o.r

COUNTS = """SELECT p, CAST(sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS pos,
  CAST(sum(CASE WHEN y = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS neg FROM scored GROUP BY p"""
CUM = """SELECT p, pos, neg,
  sum(pos) OVER (ORDER BY p DESC ROWS UNBOUNDED PRECEDING) AS tps,
  sum(neg) OVER (ORDER BY p DESC ROWS UNBOUNDED PRECEDING) AS fps,
  coalesce(sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb,
  lead(pos) OVER (ORDER BY p DESC) AS npos, lead(neg) OVER (ORDER BY p DESC) AS nneg,
  row_number() OVER (ORDER BY p DESC) AS i,
  sum(pos) OVER () AS tot_pos, sum(neg) OVER () AS tot_neg FROM c"""
PRED = "SELECT *, CAST(p >= 0.5 AS INTEGER) AS pred FROM scored"


def scored_pred(spark, sf):
    return sc.predict_labels(fx.scored(spark, sf))


@query("roc_auc", o.with_ctes(
    f"SELECT {R('CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(pos * (nb + 0.5 * neg)) / (sum(pos) * sum(neg)) END')} AS auc_score FROM w",
    scored=SCORED, c=COUNTS, w=CUM))
def q_roc_auc(spark, sf):
    """G1: tie-aware ROC AUC over all scored rows."""
    return mt.roc_auc(fx.scored(spark, sf))


@query("roc_curve", o.with_ctes(f"""
SELECT {R('fps / tot_neg')} AS fpr, {R('tps / tot_pos')} AS tpr, {R('p')} AS threshold FROM w
WHERE i = 1 OR npos IS NULL OR npos <> pos OR nneg <> neg
UNION ALL SELECT 0.0::DOUBLE, 0.0::DOUBLE, CAST('inf' AS DOUBLE)""", scored=SCORED, c=COUNTS, w=CUM))
def q_roc_curve(spark, sf):
    """ROC points with collinear points dropped and the origin added."""
    return mt.roc_curve(fx.scored(spark, sf))


@query("average_precision", o.with_ctes(
    f"SELECT {R('sum(CASE WHEN tot_pos > 0 THEN pos / tot_pos * (tps / (tps + fps)) END)')} AS average_precision FROM w",
    scored=SCORED, c=COUNTS, w=CUM))
def q_average_precision(spark, sf):
    """Step-wise average precision."""
    return mt.average_precision(fx.scored(spark, sf))


CONF = """SELECT CAST(sum(CASE WHEN y = 1 AND pred = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS tp,
  CAST(sum(CASE WHEN y = 0 AND pred = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS fp,
  CAST(sum(CASE WHEN y = 1 AND pred = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS fn,
  CAST(sum(CASE WHEN y = 0 AND pred = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS tn FROM scored_pred"""


def d(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) <> 0 THEN ({a}) / ({b}) ELSE 0.0 END"


@query("f1_accuracy", o.with_ctes(f"""
SELECT {R(d('tp', 'tp + fp'))} AS precision, {R(d('tp', 'tp + fn'))} AS recall,
  {R(d('2 * tp', '2 * tp + fp + fn'))} AS f1_score, {R(d('tp + tn', 'tp + fp + fn + tn'))} AS accuracy FROM cf""",
    scored=SCORED, scored_pred=PRED, cf=CONF))
def q_f1_accuracy(spark, sf):
    """Precision, recall, F1 and accuracy at threshold 0.5."""
    return mt.f1_accuracy(scored_pred(spark, sf))


def _report_sql() -> str:
    p1, r1, f1 = d("tp", "tp + fp"), d("tp", "tp + fn"), d("2 * tp", "2 * tp + fp + fn")
    p0, r0, f0 = d("tn", "tn + fn"), d("tn", "tn + fp"), d("2 * tn", "2 * tn + fn + fp")
    n = "(tp + fp + fn + tn)"
    rows = [
        ("'0'", p0, r0, f0, "tn + fp"), ("'1'", p1, r1, f1, "tp + fn"),
        ("'accuracy'", "NULL", "NULL", d("tp + tn", n), n),
        ("'macro avg'", f"(({p0}) + ({p1})) / 2", f"(({r0}) + ({r1})) / 2", f"(({f0}) + ({f1})) / 2", n),
        ("'weighted avg'", d(f"({p0}) * (tn + fp) + ({p1}) * (tp + fn)", n),
         d(f"({r0}) * (tn + fp) + ({r1}) * (tp + fn)", n), d(f"({f0}) * (tn + fp) + ({f1}) * (tp + fn)", n), n),
    ]
    body = "\nUNION ALL ".join(
        f"SELECT {lab} AS label, {R(pp)} AS precision, {R(rr)} AS recall, {R(ff)} AS f1_score, "
        f"CAST({ss} AS BIGINT) AS support FROM cf" for lab, pp, rr, ff, ss in rows)
    return o.with_ctes(body, scored=SCORED, scored_pred=PRED, cf=CONF)


@query("classification_report", _report_sql())
def q_classification_report(spark, sf):
    """Per-class report with accuracy, macro and weighted averages."""
    return mt.classification_report(scored_pred(spark, sf))


REG_SQL = o.with_ctes(f"""
SELECT series_key, count(*) AS n, {R('sqrt(sum((y - yhat) * (y - yhat)) / count(*))')} AS rmse,
  {R('sum(abs(y - yhat)) / count(*)')} AS mae,
  {R('CASE WHEN var_pop(y) * count(*) <> 0 THEN 1 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(*)) '
     'WHEN sum((y - yhat) * (y - yhat)) = 0 THEN 1.0 ELSE 0.0 END')} AS r2
FROM (SELECT series_key, y, yhat FROM (
  SELECT series_key, time,
    lead(precipitation_sum, 1) OVER (PARTITION BY series_key ORDER BY time) + lead(precipitation_sum, 2) OVER (PARTITION BY series_key ORDER BY time)
      + lead(precipitation_sum, 3) OVER (PARTITION BY series_key ORDER BY time) AS y,
    sum(precipitation_sum) OVER (PARTITION BY series_key ORDER BY time ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS yhat
  FROM daily_weather) t WHERE y IS NOT NULL AND yhat IS NOT NULL) u GROUP BY series_key""",
    daily_weather=o.daily_weather_sql(nulls=True))


@query("regression_metrics", REG_SQL)
def q_regression_metrics(spark, sf):
    """RMSE, MAE, R^2 of the trailing-3-day persistence forecast, per series (one job)."""
    dw = fx.daily_weather(spark, sf, nulls=True)
    w = win.series_window()
    t = win.regression_target(dw.withColumn("yhat", F.sum("precipitation_sum").over(win.trailing(w, 3))))
    return mt.regression_metrics(t, "precip_3day_next", "yhat", by=["series_key"])


@query("score_stats", o.with_ctes(
    f"SELECT {R('avg(p)')} AS mean, {R('stddev_pop(p)')} AS std, min(p) AS min, max(p) AS max, "
    f"{R('quantile_cont(p, 0.5)')} AS median FROM scored", scored=SCORED))
def q_score_stats(spark, sf):
    """Mean, population std, min, max, exact median of scores."""
    return mt.score_stats(fx.scored(spark, sf))


CLASS_SQL = (f"SELECT {R('avg(CASE WHEN y = 1 THEN p END)')} AS true_positive_rate, "
             f"{R('avg(CASE WHEN y = 0 THEN p END)')} AS false_positive_rate, "
             "CAST(sum(CASE WHEN pred = 0 THEN 1 ELSE 0 END) AS BIGINT) AS pred_0_count, "
             "CAST(sum(CASE WHEN pred = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pred_1_count, "
             f"{R('avg(CASE WHEN pred = 0 THEN 1.0 ELSE 0.0 END) * 100')} AS zero_predictions_percentage "
             "FROM scored_pred")


@query("class_analysis", o.with_ctes(CLASS_SQL, scored=SCORED, scored_pred=PRED))
def q_class_analysis(spark, sf):
    """Mean score per true class, predicted label counts, % zeros."""
    return mt.class_analysis(scored_pred(spark, sf))


@query("evaluation_report", o.with_ctes(f"""
SELECT 'Model' AS model_name, s.*, a.auc_score, st.*, ca.*,
  CASE WHEN a.auc_score > 0.9 THEN 'Excellent' WHEN a.auc_score > 0.8 THEN 'Good'
       WHEN a.auc_score > 0.7 THEN 'Fair' ELSE 'Poor' END AS model_performance
FROM (SELECT count(*) AS total_samples, CAST(sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS positive_samples,
        CAST(sum(CASE WHEN y = 0 THEN 1 ELSE 0 END) AS BIGINT) AS negative_samples,
        {R('avg(CASE WHEN y = 1 THEN 1.0 ELSE 0.0 END) * 100')} AS positive_rate FROM scored) s,
     (SELECT {R('CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(pos * (nb + 0.5 * neg)) / (sum(pos) * sum(neg)) END')} AS auc_score FROM w) a,
     (SELECT {R('avg(p)')} AS mean, {R('stddev_pop(p)')} AS std, min(p) AS min, max(p) AS max,
        {R('quantile_cont(p, 0.5)')} AS median FROM scored) st,
     ({CLASS_SQL}) ca""", scored=SCORED, scored_pred=PRED, c=COUNTS, w=CUM))
def q_evaluation_report(spark, sf):
    """AUC + statistics + class analysis + band in one row."""
    return mt.evaluation_report(scored_pred(spark, sf))


@query("prediction_analysis", o.with_ctes(
    "SELECT count(*) AS total_predictions, " + R("avg(p)") + " AS mean_probability, "
    + R("stddev_pop(p)") + " AS std_probability, min(p) AS min_probability, max(p) AS max_probability, "
    "count_if(p > 0.8) AS high_confidence_predictions, count_if(p < 0.2) AS low_confidence_predictions, "
    "count_if(p >= 0.2 AND p <= 0.8) AS uncertain_predictions, "
    + R("quantile_cont(p, 0.5)") + " AS median_probability, "
    + ", ".join(f"{R(f'quantile_cont(p, {q / 100})')} AS percentile_{q}" for q in mt.ANALYSIS_PERCENTILES)
    + " FROM scored", scored=SCORED))
def q_prediction_analysis(spark, sf):
    """Unlabelled score analysis with exact percentiles."""
    return mt.prediction_analysis(fx.scored(spark, sf))


VALID_SQL = """SELECT name, count_if(p IS NULL OR isnan(p) OR p < 0 OR p > 1) = 0 AS is_valid FROM (
  SELECT 'p' AS name, p FROM scored
  UNION ALL SELECT 'p_scaled', p * 1.5 FROM scored
  UNION ALL SELECT 'p_nan', CASE WHEN y = 1 THEN p ELSE CAST('nan' AS DOUBLE) END FROM scored) t GROUP BY name"""


@query("validate_predictions", o.with_ctes(VALID_SQL, scored=SCORED))
def q_validate_predictions(spark, sf):
    """Validity of three score columns (valid, out of range, NaN)."""
    s = fx.scored(spark, sf)
    long = sc.stack_models(s, {"p": F.col("p"), "p_scaled": F.col("p") * 1.5,
                               "p_nan": F.when(F.col("y") == 1, F.col("p")).otherwise(F.lit(float("nan")))},
                           keep=[]).withColumnRenamed("model_name", "name")
    return mt.validate_predictions(long, by=["name"])


# ------------------------------------------------------------------ O2, O4, M11-M13, A5, S6
@query("top_predictions", o.with_ctes(
    "SELECT player_id, p AS draft_probability FROM scored ORDER BY p DESC, player_id LIMIT 10", scored=SCORED))
def q_top_predictions(spark, sf):
    """O2: top-10 scores (ties by id)."""
    return sc.top_predictions(fx.scored(spark, sf))


MODELS_SQL = """SELECT y, 'price_score' AS model_name, p FROM scored
  UNION ALL SELECT y, 'inverted', 1 - p FROM scored
  UNION ALL SELECT y, 'coarse', floor(p * 10) / 10 FROM scored"""


def _models(spark, sf):
    s = fx.scored(spark, sf)
    return sc.stack_models(s, {"price_score": F.col("p"), "inverted": 1 - F.col("p"),
                               "coarse": F.floor(F.col("p") * 10) / 10})


@query("compare_models", o.with_ctes(f"""
SELECT a.model_name, a.auc_score, ap.average_precision FROM
 (SELECT model_name, {R('CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(pos * (nb + 0.5 * neg)) / (sum(pos) * sum(neg)) END')} AS auc_score
  FROM (SELECT *, coalesce(sum(neg) OVER (PARTITION BY model_name ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb
        FROM (SELECT model_name, p, CAST(sum(y) AS DOUBLE) AS pos, CAST(sum(1 - y) AS DOUBLE) AS neg FROM m GROUP BY 1, 2) c) w
  GROUP BY model_name) a
JOIN (SELECT model_name, {R('sum(CASE WHEN tot_pos > 0 THEN pos / tot_pos * (tps / (tps + fps)) END)')} AS average_precision
  FROM (SELECT *, sum(pos) OVER (PARTITION BY model_name ORDER BY p DESC ROWS UNBOUNDED PRECEDING) AS tps,
          sum(neg) OVER (PARTITION BY model_name ORDER BY p DESC ROWS UNBOUNDED PRECEDING) AS fps,
          sum(pos) OVER (PARTITION BY model_name) AS tot_pos
        FROM (SELECT model_name, p, CAST(sum(y) AS DOUBLE) AS pos, CAST(sum(1 - y) AS DOUBLE) AS neg FROM m GROUP BY 1, 2) c) w
  GROUP BY model_name) ap ON a.model_name = ap.model_name""", scored=SCORED, m=MODELS_SQL))
def q_compare_models(spark, sf):
    """Three scorers evaluated by ONE grouped metric job, ranked by AUC."""
    long = _models(spark, sf)
    m = mt.roc_auc(long, by=["model_name"]).join(mt.average_precision(long, by=["model_name"]), "model_name")
    return sc.compare_models(m)


@query("predict_labels", o.with_ctes("SELECT player_id, p, pred FROM scored_pred", scored=SCORED, scored_pred=PRED))
def q_predict_labels(spark, sf):
    """0/1 labels at threshold 0.5."""
    return scored_pred(spark, sf).select("player_id", "p", "pred")


@query("label_counts", o.with_ctes("SELECT pred, count(*) AS count FROM scored_pred GROUP BY pred",
                                   scored=SCORED, scored_pred=PRED))
def q_label_counts(spark, sf):
    """Number of rows per predicted label."""
    return sc.label_counts(scored_pred(spark, sf))


@query("predict_confidence", o.with_ctes(
    f"SELECT player_id, p, {R('abs(p - 0.5) * 2')} AS confidence FROM scored", scored=SCORED))
def q_predict_confidence(spark, sf):
    """confidence = |p - 0.5| * 2."""
    return sc.confidence(fx.scored(spark, sf)).select("player_id", "p", "confidence")


@query("scale_pos_weight", o.with_ctes(
    "SELECT CASE WHEN sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) = 0 THEN 1.0 ELSE "
    + R("sum(CASE WHEN y = 0 THEN 1 ELSE 0 END) / sum(CASE WHEN y = 1 THEN 1 ELSE 0 END)")
    + " END AS scale_pos_weight FROM scored", scored=SCORED))
def q_scale_pos_weight(spark, sf):
    """A5: class weight negatives / positives."""
    return sc.scale_pos_weight(fx.scored(spark, sf))
