"""Registered queries: model fitting, tuning and baselines.

Scores of fitted trees differ from engine to engine, so these queries return
what SQL can check as well: keys, labels, sizes, ranks, and that scores are
probabilities.  The scores themselves are the operators' results; property
tests cover them.  The model-free baselines and the overfit report are
SQL-checked in full.  The reference's searches are functions (``SEARCHES``),
not registered queries.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from dailyseries.operators import metrics as mt
from dailyseries.operators import models as md
from dailyseries.operators import scoring as sc
from dailyseries.operators import splits as spl
from dailyseries.operators import windows as win
from dailyseries.plans import fixtures as fx
from dailyseries.plans import oracle as o
from dailyseries.plans.pipeline import feature_pipeline
from dailyseries.plans.q_pipeline import CODES, MEASURES, SEASONS, WF_SQL, _rolling_items, _split_sql
from dailyseries.plans.q_windows import PLAIN, _advanced_items
from dailyseries.plans.registry import query

R = o.r
DW = o.daily_weather_sql(nulls=True)
# fixed values: the reference's parameters and search spaces
BASE = {"n_estimators": 300, "num_leaves": 31, "learning_rate": 0.1}
WALK = {"n_estimators": 500, "max_depth": 6, "learning_rate": 0.05, "subsample": 0.8, "colsample_bytree": 0.8}
REG_SPACE = {"n_estimators": list(range(200, 1000, 100)), "max_depth": list(range(3, 10)),
             "learning_rate": [round(0.01 * k, 2) for k in range(1, 31)], "subsample": [0.6, 0.7, 0.8, 0.9, 1.0],
             "colsample_bytree": [0.6, 0.7, 0.8, 0.9, 1.0], "gamma": [5 * k / 9 for k in range(10)],
             "reg_alpha": [0, 0.01, 0.1, 1, 10], "reg_lambda": [0.1, 1, 10, 50]}
CLS_SPACE = {"n_estimators": [200, 500, 800], "max_depth": [3, 5, 7], "learning_rate": [0.01, 0.05, 0.1],
             "subsample": [0.6, 0.8, 1.0], "colsample_bytree": [0.6, 0.8, 1.0], "gamma": [0, 1, 5]}


def _members(y):
    """The four members of the soft vote, unweighted as in the reference."""
    from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
    cols = {"labelCol": y, "featuresCol": "features", "seed": md.SEED}
    gbt = {"xgb": {**WALK, "gamma": 2}, "lgb": {**WALK, "num_leaves": 31},
           "gb": {"n_estimators": 300, "max_depth": 6, "learning_rate": 0.05, "subsample": 0.8}}
    out = {name: GBTClassifier(**cols, **md.spark_params(p)) for name, p in gbt.items()}
    return out | {"rf": RandomForestClassifier(**cols, numTrees=300, maxDepth=8, minInstancesPerNode=2)}


def _cls_table(spark, sf):
    df, feats, target = feature_pipeline(fx.daily_weather(spark, sf, nulls=True), task="classification")
    return df, feats, target


CLS_ROWS = f"""SELECT *, CAST(coalesce(CAST(rain_in_future > 0.1 AS INTEGER), 0) AS INTEGER) AS target_rain FROM (
  SELECT *, lead(rain_sum, 7) {PLAIN} AS rain_in_future FROM daily_weather) a WHERE rain_in_future IS NOT NULL"""
REG_ROWS = f"""SELECT * FROM (SELECT *, lead(precipitation_sum, 1) {PLAIN} + lead(precipitation_sum, 2) {PLAIN}
  + lead(precipitation_sum, 3) {PLAIN} AS precip_3day_next FROM daily_weather) a WHERE precip_3day_next IS NOT NULL"""
TEST_SQL = o.with_ctes("SELECT series_key, time, target_rain, true AS p_valid FROM s WHERE split = 'test'",
                       daily_weather=DW, c=CLS_ROWS, s=_split_sql("c"))


def _checked(scored, y):
    return scored.select("series_key", "time", y, F.col("p").between(0, 1).alias("p_valid"))


@query("train_gbt_scores", TEST_SQL)
def q_train_gbt_scores(spark, sf):
    """Class-weighted boosted trees stopped on the validation AUC; test rows scored."""
    df, feats, y = _cls_table(spark, sf)
    model, _ = md.train_gbt(df, feats, y, params=BASE, max_iter=300, patience=30)
    return _checked(md.score(model, df.where(F.col("split") == "test")), y)


def _features_sql(total: str) -> str:
    """Every feature once, with what holds of its importance."""
    names = [*MEASURES, "year", "month", *[f"lag{n}" for n in (1, 2, 3, 7)], *[n for n, _ in _rolling_items()],
             *[n for n, _ in _advanced_items(lambda e: e)], *[f"weather_code_{c}" for c in CODES],
             *[f"season_{x}" for x in SEASONS]]
    return f"SELECT feature, true AS valid, {total} FROM (SELECT unnest({names!r}) AS feature) f"


def _importance(df, name: str):
    return df.select("feature", (F.col("importance") >= 0).alias("valid"), name)


@query("feature_importance", _features_sql("CAST(1 AS DOUBLE) AS total"))
def q_feature_importance(spark, sf):
    """Normalised gain of each feature; all add up to one."""
    df, feats, y = _cls_table(spark, sf)
    model, _ = md.train_gbt(df, feats, y, params=BASE, max_iter=300, patience=30)
    found = md.feature_importance(model, feats)
    total = found.agg(F.sum("importance").alias("total")).scalar()
    return _importance(found.withColumn("total", total), "total")


@query("feature_importance_splits", _features_sql("true AS adds_up"))
def q_feature_importance_splits(spark, sf):
    """Splits per feature, as the reference's library counts them; they add up
    to the inner nodes of all trees (a binary tree of n nodes has n // 2)."""
    df, feats, y = _cls_table(spark, sf)
    model, _ = md.train_gbt(df, feats, y, params=BASE, max_iter=300, patience=30)
    found = md.split_counts(model, feats)
    inner = sum(t.numNodes // 2 for t in model.stages[-1].trees)
    total = found.agg((F.sum("importance") == inner).alias("ok")).scalar()
    return _importance(found.withColumn("adds_up", total), "adds_up")


def _train_folds(spark, sf):
    df, feats, y = _cls_table(spark, sf)
    tr = df.where(F.col("split") == "train")
    return spl.stratified_folds(tr, y, 5, order_key=["time", "series_key"]), feats, y


def _ledger(spark, path):
    return md.Ledger(spark, path) if path else None


def q_grid_search_table(spark, sf, ledger: str | None = None):
    """M2/O3: cross-validated AUC over the default grid, ranked (stratified folds);
    ``ledger`` is a folder in which finished fits are kept."""
    data, feats, y = _train_folds(spark, sf)
    return md.grid_search(data, feats, y, "fold", md.DEFAULT_GRID, ledger=_ledger(spark, ledger))[0]


def q_topk_refit(spark, sf, ledger: str | None = None):
    """M6: refit the 10 best grid points with early stopping; val AUC and % zeros."""
    data, feats, y = _train_folds(spark, sf)
    table = md.grid_search(data, feats, y, "fold", md.DEFAULT_GRID, ledger=_ledger(spark, ledger))[0]
    return md.topk_refit(_cls_table(spark, sf)[0], feats, y, table, 10, max_iter=300, patience=30)


def q_random_search_regression(spark, sf, ledger: str | None = None):
    """M3: seeded random search of boosted regression trees, 3-fold RMSE."""
    df, feats, y = feature_pipeline(fx.daily_weather(spark, sf, nulls=True), task="regression")
    tr = spl.kfold(df.where(F.col("split") == "train"), 3)
    return md.random_search_regression(tr, feats, y, "fold", REG_SPACE, n_iter=30, ledger=_ledger(spark, ledger))


def q_random_search_classification(spark, sf):
    """M5: 20 draws of a 729-point space, fitted on train, ranked by val AUC."""
    df, feats, y = _cls_table(spark, sf)
    draws = md.sample_params(CLS_SPACE, 20)
    fits = md.fit_many(df, feats, y, draws, patience=0, weighted=False)
    ev = md.evaluate_models(df, {str(d): m for d, (m, _) in zip(draws, fits)}, y)
    return ev.orderBy(F.col("val_auc").desc_nulls_last())


@query("train_rf_scores", TEST_SQL)
def q_train_rf_scores(spark, sf):
    """M4: random forest with fixed parameters; test-split scores."""
    df, feats, y = _cls_table(spark, sf)
    m = md.train_random_forest(df, feats, y, num_trees=300, max_depth=8, min_instances=2)
    return _checked(md.score(m, df.where(F.col("split") == "test")), y)


@query("ensemble_scores", TEST_SQL)
def q_ensemble_scores(spark, sf):
    """M7: soft vote of three boosted models and a random forest on the test split."""
    df, feats, y = _cls_table(spark, sf)
    fits = md.fit_members(df, feats, _members(y))
    return _checked(md.soft_vote(df.where(F.col("split") == "test"), list(fits.values())), y)


@query("model_comparison", "SELECT unnest(['gb', 'lgb', 'rf', 'xgb']) AS model_name, true AS valid, "
       "unnest([1, 2, 3, 4]) AS place")
def q_model_comparison(spark, sf):
    """The four members of the vote by validation AUC, from one metric job."""
    df, feats, y = _cls_table(spark, sf)
    fits = md.fit_members(df, feats, _members(y))
    out = sc.compare_models(md.evaluate_models(df, fits, y).withColumnRenamed("val_auc", "auc_score"))
    by_name = Window.orderBy("model_name")  # four rows
    return out.select("model_name", (F.col("auc_score").between(0, 1) & F.col("percent_zeros_on_val").between(0, 100))
                      .alias("valid"), F.row_number().over(by_name).alias("place"))


# ------------------------------------------------------------------ model-free, SQL-checked
BASE_REG_SQL = o.with_ctes(f"""
SELECT predictor, split, count(*) AS n, {R('sqrt(sum((y - yhat) * (y - yhat)) / count(*))')} AS rmse,
  {R('sum(abs(y - yhat)) / count(*)')} AS mae,
  {R('CASE WHEN var_pop(y) * count(*) <> 0 THEN 1 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(*)) '
     'WHEN sum((y - yhat) * (y - yhat)) = 0 THEN 1.0 ELSE 0.0 END')} AS r2
FROM (SELECT 'mean' AS predictor, split, precip_3day_next AS y, (SELECT avg(precip_3day_next) FROM s WHERE split = 'train') AS yhat FROM s
      UNION ALL SELECT 'persistence', split, precip_3day_next, lag1 FROM s) u
WHERE y IS NOT NULL AND yhat IS NOT NULL GROUP BY 1, 2""", daily_weather=DW,
    t=f"""SELECT *, lag(precip_3day_next, 1) {PLAIN} AS lag1 FROM (SELECT *, lead(precipitation_sum, 1) {PLAIN}
  + lead(precipitation_sum, 2) {PLAIN} + lead(precipitation_sum, 3) {PLAIN} AS precip_3day_next FROM daily_weather) a
  WHERE precip_3day_next IS NOT NULL""", s=_split_sql("t"))


@query("baseline_regression", BASE_REG_SQL)
def q_baseline_regression(spark, sf):
    """M8: train-mean and persistence (lag1) forecasts scored per split in one job."""
    t = win.regression_target(fx.daily_weather(spark, sf, nulls=True))
    t = t.withColumn("lag1", F.lag("precip_3day_next", 1).over(win.series_window()))
    s = sc.mean_predictor(spl.chrono_split(t), "precip_3day_next")
    long = s.select("split", F.col("precip_3day_next").alias("y"), F.inline(F.array(
        F.struct(F.lit("mean").alias("predictor"), F.col("pred_mean").alias("yhat")),
        F.struct(F.lit("persistence").alias("predictor"), F.col("lag1").alias("yhat")))))
    return mt.regression_metrics(long, "y", "yhat", by=["predictor", "split"])


BASE_MAJ_SQL = o.with_ctes(f"""
SELECT split, (SELECT maj FROM m) AS majority_class, {R('avg(CASE WHEN target_rain = (SELECT maj FROM m) THEN 1.0 ELSE 0.0 END)')} AS accuracy,
  CASE WHEN count_if(target_rain = 1) > 0 AND count_if(target_rain = 0) > 0 THEN CAST(0.5 AS DOUBLE) END AS auc_score
FROM s GROUP BY split""", daily_weather=DW,
    c=f"""SELECT *, CAST(coalesce(CAST(rain_in_future > 0.1 AS INTEGER), 0) AS INTEGER) AS target_rain FROM (
  SELECT *, lead(rain_sum, 7) {PLAIN} AS rain_in_future FROM daily_weather) a WHERE rain_in_future IS NOT NULL""",
    s=_split_sql("c"),
    m="SELECT CAST(target_rain AS DOUBLE) AS maj FROM (SELECT target_rain, count(*) AS n FROM s WHERE split = 'train' "
      "GROUP BY 1) t ORDER BY n DESC, target_rain LIMIT 1")


@query("baseline_majority", BASE_MAJ_SQL)
def q_baseline_majority(spark, sf):
    """M9: majority-class predictor (probability 0 or 1) per split."""
    c = spl.chrono_split(win.classification_target(fx.daily_weather(spark, sf, nulls=True)))
    s = sc.majority_predictor(c, "target_rain")
    acc = s.groupBy("split").agg(F.first("p_major").alias("majority_class"),
                                 F.avg(F.when(F.col("target_rain") == F.col("p_major"), 1.0).otherwise(0.0)).alias("accuracy"))
    auc = mt.roc_auc(s, "target_rain", "p_major", by=["split"])
    return acc.join(auc, "split")


OVERFIT_SQL = o.with_ctes(f"""
SELECT model_name, {R('tr')} AS train_auc, {R('va')} AS val_auc, {R('tr - va')} AS gap, (tr - va) > 0.05 AS overfit FROM (
  SELECT model_name, max(CASE WHEN split = 'train' THEN auc END) AS tr, max(CASE WHEN split = 'val' THEN auc END) AS va FROM (
    SELECT model_name, split, sum(pos * (nb + 0.5 * neg)) / (sum(pos) * sum(neg)) AS auc FROM (
      SELECT *, coalesce(sum(neg) OVER (PARTITION BY model_name, split ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb
      FROM (SELECT model_name, split, p, CAST(sum(y) AS DOUBLE) AS pos, CAST(sum(1 - y) AS DOUBLE) AS neg FROM m GROUP BY 1, 2, 3) c) w
    GROUP BY 1, 2) a GROUP BY 1) b""", scored=o.SCORED_SQL, s=_split_sql("scored", "player_id"),
    m="SELECT y, split, 'price_score' AS model_name, p FROM s UNION ALL SELECT y, split, 'coarse', floor(p * 10) / 10 FROM s")


@query("overfit_gap", OVERFIT_SQL)
def q_overfit_gap(spark, sf):
    """Train - validation AUC gap per model and the > 0.05 overfit flag."""
    s = spl.chrono_split(fx.scored(spark, sf), order_cols=["player_id"])
    long = s.select("y", "split", F.inline(F.array(
        F.struct(F.lit("price_score").alias("model_name"), F.col("p").alias("p")),
        F.struct(F.lit("coarse").alias("model_name"), (F.floor(F.col("p") * 10) / 10).alias("p")))))
    a = mt.roc_auc(long.where(F.col("split").isin("train", "val")), by=["model_name", "split"])
    piv = a.groupBy("model_name").agg(F.max(F.when(F.col("split") == "train", F.col("auc_score"))).alias("train_auc"),
                                      F.max(F.when(F.col("split") == "val", F.col("auc_score"))).alias("val_auc"))
    gap = F.col("train_auc") - F.col("val_auc")
    return piv.select("model_name", "train_auc", "val_auc", gap.alias("gap"), (gap > 0.05).alias("overfit"))


def _cv_sql() -> str:
    from dailyseries.plans.q_pipeline import _strat_sql
    folds = _strat_sql(5)
    m = ("SELECT f.y, f.fold, 'price_score' AS model_name, s.p FROM folds f JOIN scored s ON f.player_id = s.player_id "
         "UNION ALL SELECT f.y, f.fold, 'coarse', floor(s.p * 10) / 10 FROM folds f JOIN scored s ON f.player_id = s.player_id")
    fa = ("SELECT model_name, fold, sum(pos * (nb + 0.5 * neg)) / (sum(pos) * sum(neg)) AS auc FROM ("
          "SELECT *, coalesce(sum(neg) OVER (PARTITION BY model_name, fold ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING "
          "AND 1 PRECEDING), 0) AS nb FROM (SELECT model_name, fold, p, CAST(sum(y) AS DOUBLE) AS pos, "
          "CAST(sum(1 - y) AS DOUBLE) AS neg FROM m GROUP BY 1, 2, 3) c) w GROUP BY 1, 2")
    base = "(SELECT avg(auc) FROM fa WHERE model_name = 'coarse')"
    body = (f"SELECT model_name, {R('m')} AS cv_mean, {R('s')} AS cv_std, {R('m - 2 * s')} AS cv_low, "
            f"{R('m + 2 * s')} AS cv_high, {R(f'(m - {base}) / {base} * 100')} AS improvement_pct "
            "FROM (SELECT model_name, avg(auc) AS m, stddev_pop(auc) AS s FROM fa GROUP BY 1) z")
    return o.with_ctes(body, scored=o.SCORED_SQL, folds=folds, m=m, fa=fa)


@query("cv_summary", _cv_sql())
def q_cv_summary(spark, sf):
    """Per-model AUC over 5 stratified folds in one grouped job; mean +/- 2 std
    (population) and the improvement over a base model."""
    s = spl.stratified_folds(fx.scored(spark, sf), "y", 5)
    long = s.select("y", "fold", F.inline(F.array(
        F.struct(F.lit("price_score").alias("model_name"), F.col("p").alias("p")),
        F.struct(F.lit("coarse").alias("model_name"), (F.floor(F.col("p") * 10) / 10).alias("p")))))
    fa = mt.roc_auc(long, by=["model_name", "fold"])
    per = fa.groupBy("model_name").agg(F.avg("auc_score").alias("m"), F.stddev_pop("auc_score").alias("s"))
    base = per.where(F.col("model_name") == "coarse").select(F.col("m").alias("_b"))
    from dailyseries.plans.ranking import join_groups
    j = join_groups(per, base, [])
    return j.select("model_name", F.col("m").alias("cv_mean"), F.col("s").alias("cv_std"),
                    (F.col("m") - 2 * F.col("s")).alias("cv_low"), (F.col("m") + 2 * F.col("s")).alias("cv_high"),
                    ((F.col("m") - F.col("_b")) / F.col("_b") * 100).alias("improvement_pct"))



WF_GBT_SQL = o.with_ctes("""
SELECT fold, n, (SELECT max(time) FROM placed WHERE _p < train_end) AS train_end_time, test_end_time, true AS valid FROM (
  SELECT fold, count(*) AS n, min(train_end) AS train_end, max(time) AS test_end_time FROM folds
  WHERE fold IS NOT NULL GROUP BY fold) f""", daily_weather=DW, persistence=REG_ROWS, folds=WF_SQL,
    placed="SELECT time, row_number() OVER (ORDER BY time, series_key) - 1 AS _p FROM persistence")


@query("walk_forward_gbt", WF_GBT_SQL)
def q_walk_forward_gbt(spark, sf):
    """L2 with a model: boosted regression trees refitted on each expanding
    training window (60 % then 10 % steps), RMSE/MAE/R^2 per fold in one job,
    with the last training date and last test date of every fold."""
    from pyspark.ml.regression import GBTRegressor
    df, feats, y = feature_pipeline(fx.daily_weather(spark, sf, nulls=True), task="regression")
    f = spl.walk_forward_folds(df)
    est = GBTRegressor(labelCol=y, featuresCol="features", seed=md.SEED, **md.spark_params(WALK))
    scored = md.fold_fit_score(f, feats, y, est, keep=["time"])
    m = mt.regression_metrics(scored, "y", "p", by=["fold"])
    begun = Window.orderBy("fold").rowsBetween(Window.unboundedPreceding, 0)  # one row per fold
    ends = (f.where(F.col("train_from").isNotNull()).groupBy(F.col("train_from").alias("fold")).agg(F.max("time").alias("last"))
            .select("fold", F.max("last").over(begun).alias("train_end_time")))
    test_end = f.where(F.col("fold").isNotNull()).groupBy("fold").agg(F.max("time").alias("test_end_time"))
    valid = (F.col("mae") >= 0) & (F.col("rmse") >= F.col("mae") - 1e-9) & (F.col("r2") <= 1)
    return (m.join(ends, "fold").join(test_end, "fold")
            .select("fold", "n", "train_end_time", "test_end_time", valid.alias("valid")))


def q_time_series_cv(spark, sf):
    """L3 with a model: five expanding-window folds of the four-member vote,
    AUC per fold and mean +/- 2 std (population) in one grouped job."""
    df, feats, y = _cls_table(spark, sf)
    tr = df.where(F.col("split") == "train")
    f = spl.time_series_folds(tr, 5)
    scored = md.fold_fit_score(f, feats, y, list(_members(y).values()))
    per = mt.roc_auc(scored, by=["fold"])
    summ = per.agg(F.avg("auc_score").alias("cv_mean"), F.stddev_pop("auc_score").alias("cv_std"))
    from dailyseries.plans.ranking import join_groups
    out = join_groups(per, summ, []).withColumns({"cv_low": F.col("cv_mean") - 2 * F.col("cv_std"),
                                                  "cv_high": F.col("cv_mean") + 2 * F.col("cv_std")})
    n = f.where(F.col("fold").isNotNull()).groupBy("fold").agg(F.count("*").alias("n"))
    valid = F.col("auc_score").between(0, 1) & F.col("cv_mean").between(F.col("cv_low"), F.col("cv_high"))
    return out.join(n, "fold").select("fold", "n", valid.alias("valid"))


# The reference's searches in full.  A single machine needs hours to days for them (README), so they are
# no registered queries; with a ledger in the shared folder they can be stopped and go on.
SEARCHES = {"grid_search_table": q_grid_search_table, "topk_refit": q_topk_refit,
            "random_search_regression": q_random_search_regression,
            "random_search_classification": q_random_search_classification, "time_series_cv": q_time_series_cv}
