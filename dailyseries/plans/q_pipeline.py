"""Registered queries: the full pipeline (R6), preparation (R1-R5) and
splits (L1-L6, A17)."""

from __future__ import annotations

from pyspark.sql import functions as F

from dailyseries.operators import features as feat
from dailyseries.operators import prepare as prep
from dailyseries.operators import splits as spl
from dailyseries.operators import windows as win
from dailyseries.plans import fixtures as fx
from dailyseries.plans import oracle as o
from dailyseries.plans.pipeline import feature_pipeline
from dailyseries.plans.q_windows import PLAIN, TEMPORAL_SQL, _advanced_items, rows
from dailyseries.plans.registry import query

R = o.r
DW = o.daily_weather_sql(nulls=True)
MEASURES = ["temperature_2m_max", "temperature_2m_min", "apparent_temperature_max", "apparent_temperature_min",
            "precipitation_sum", "rain_sum", "snowfall_sum", "precipitation_hours", "wind_speed_10m_max",
            "wind_gusts_10m_max", "wind_direction_10m_dominant", "shortwave_radiation_sum",
            "et0_fao_evapotranspiration", "sunshine_duration", "daylight_duration"]
# fixed values: weather codes the daily-weather stand-in produces (all present at sf0.01)
CODES = [0, 1, 2, 3, 51, 61, 63]
SEASONS = ["Summer", "Autumn", "Winter", "Spring"]


def _rolling_items():
    items = []
    x = "precipitation_sum"
    for n in win.ROLLING_WINDOWS:
        fr = rows(n)
        items += [(f"precip_{n}d_sum", f"sum({x}) {fr}"), (f"precip_{n}d_avg", f"avg({x}) {fr}"),
                  (f"precip_{n}d_std", f"stddev_samp({x}) {fr}"), (f"precip_{n}d_max", f"max({x}) {fr}"),
                  (f"rain_days_{n}d", f"CASE WHEN count({x}) {fr} > 0 THEN CAST(sum(CASE WHEN {x} > 0 THEN 1 ELSE 0 END) {fr} AS DOUBLE) END")]
    return items


def _split_sql(src: str, order: str = "time, series_key", tr: float = 0.7, va: float = 0.15) -> str:
    return f"""SELECT * EXCLUDE (_pos, _n), CASE WHEN _pos < floor(CAST(_n AS DOUBLE) * {tr}) THEN 'train'
  WHEN _pos < floor(CAST(_n AS DOUBLE) * {tr}) + floor(CAST(_n AS DOUBLE) * {va}) THEN 'val' ELSE 'test' END AS split
FROM (SELECT *, row_number() OVER (ORDER BY {order}) - 1 AS _pos, count(*) OVER () AS _n FROM {src}) z"""


def pipeline_sql(task: str, leak_safe: bool) -> str:
    if task == "regression":
        target = "precip_3day_next"
        tgt = (f"SELECT * FROM (SELECT *, lead(precipitation_sum, 1) {PLAIN} + lead(precipitation_sum, 2) {PLAIN} "
               f"+ lead(precipitation_sum, 3) {PLAIN} AS {target} FROM daily_weather) q WHERE {target} IS NOT NULL")
        back = 2 if leak_safe else 0
        lags = [(f"lag{n}", f"lag({target}, {n + back}) {PLAIN}") for n in (1, 2)]
        extra = []
    else:
        target = "target_rain"
        tgt = (f"SELECT *, CAST(coalesce(CAST(rain_in_future > 0.1 AS INTEGER), 0) AS INTEGER) AS {target} FROM ("
               f"SELECT *, lead(rain_sum, 7) {PLAIN} AS rain_in_future FROM daily_weather) q WHERE rain_in_future IS NOT NULL")
        lags = [(f"lag{n}", f"lag(rain_sum, {n}) {PLAIN}") for n in (1, 2, 3, 7)]
        extra = [] if leak_safe else ["rain_in_future"]
    temporal = TEMPORAL_SQL.replace("FROM daily_weather", "FROM tgt")
    adv = _advanced_items(lambda e: e)
    feat_items = lags + _rolling_items() + adv
    base_cols = MEASURES + extra + ["year", "month"]
    wide = (f"SELECT series_key, time, {target}, weather_code, season, {', '.join(base_cols)},\n  "
            f"{o.select_list(feat_items)}\nFROM cal")
    dummies = ([(f"weather_code_{c}", f"CASE WHEN weather_code = {c} THEN 1 ELSE 0 END") for c in CODES]
               + [(f"season_{s}", f"CASE WHEN season = '{s}' THEN 1 ELSE 0 END") for s in SEASONS])
    features = base_cols + [n for n, _ in feat_items] + [n for n, _ in dummies]
    oh = f"SELECT * EXCLUDE (weather_code, season), {o.select_list(dummies)} FROM wide"
    fit1 = "SELECT " + ", ".join(f"avg({c}) AS m_{c}" for c in features) + " FROM sp WHERE split = 'train'"
    imp = ("SELECT series_key, time, split, " + target + ", "
           + ", ".join(f"coalesce(CAST({c} AS DOUBLE), m_{c}) AS {c}" for c in features) + " FROM sp, fit1")
    fit2 = ("SELECT " + ", ".join(f"avg({c}) AS a_{c}, stddev_pop({c}) AS s_{c}" for c in features)
            + " FROM imp WHERE split = 'train'")
    tcol = R(target) if task == "regression" else target
    final = ("SELECT series_key, time, split, " + tcol + f" AS {target}, "
             + ", ".join(R(f"({c} - a_{c}) / CASE WHEN s_{c} = 0 OR s_{c} IS NULL THEN 1 ELSE s_{c} END") + f" AS {c}"
                         for c in features) + " FROM imp, fit2")
    return o.with_ctes(final, daily_weather=DW, tgt=tgt, cal=temporal, wide=wide, oh=oh,
                       sp=_split_sql("oh"), fit1=fit1, imp=imp, fit2=fit2)


def _pipeline(task: str, leak_safe: bool):
    def run(spark, sf):
        dw = fx.daily_weather(spark, sf, nulls=True)
        return feature_pipeline(dw, task=task, leak_safe=leak_safe)[0]
    return run


def pipeline_many_sql() -> str:
    return pipeline_sql("regression", True).replace(o.daily_weather_sql(nulls=True), o.daily_weather_sql(None, nulls=True))


@query("pipeline_many_series", pipeline_many_sql())
def q_pipeline_many_series(spark, sf):
    """R6 over one series per supplier (many series, leak-safe regression)."""
    dw = fx.daily_weather(spark, sf, n_series=None, nulls=True)
    return feature_pipeline(dw, task="regression", leak_safe=True)[0]


for _task in ("regression", "classification"):
    for _safe in (True, False):
        _name = f"pipeline_{_task}" + ("" if _safe else "_parity")
        query(_name, pipeline_sql(_task, _safe))(_pipeline(_task, _safe))


# ------------------------------------------------------------------ L1, A17, L2, L3, L4, L6
SPLIT_SQL = o.with_ctes("SELECT series_key, time, split FROM (" + _split_sql("daily_weather") + ") s", daily_weather=DW)


@query("chrono_split", SPLIT_SQL)
def q_chrono_split(spark, sf):
    """L1: 70/15/15 chronological split over (time, series_key)."""
    dw = fx.daily_weather(spark, sf, nulls=True)
    return spl.chrono_split(dw).select("series_key", "time", "split")


@query("split_date_ranges", o.with_ctes(
    "SELECT split, min(time) AS min_time, max(time) AS max_time, count(*) AS n_rows FROM ("
    + _split_sql("daily_weather") + ") s GROUP BY split", daily_weather=DW))
def q_split_date_ranges(spark, sf):
    """Date range and size of each split."""
    dw = spl.chrono_split(fx.daily_weather(spark, sf, nulls=True))
    return dw.groupBy("split").agg(F.min("time").alias("min_time"), F.max("time").alias("max_time"),
                                   F.count(F.lit(1)).alias("n_rows"))


@query("chrono_split_per_series", o.with_ctes(
    "SELECT series_key, time, split FROM (" + _split_sql("daily_weather", "time").replace(
        "row_number() OVER (ORDER BY time)", "row_number() OVER (PARTITION BY series_key ORDER BY time)").replace(
        "count(*) OVER ()", "count(*) OVER (PARTITION BY series_key)") + ") s", daily_weather=DW))
def q_chrono_split_per_series(spark, sf):
    """L1 per-series mode: each series split 70/15/15 on its own."""
    dw = fx.daily_weather(spark, sf, nulls=True)
    return spl.chrono_split(dw, per_series=True).select("series_key", "time", "split")


PERSIST_SQL = f"""SELECT series_key, time, precip_3day_next AS y, lag(precip_3day_next, 1) {PLAIN} AS yhat
FROM (SELECT * FROM (SELECT series_key, time, lead(precipitation_sum, 1) {PLAIN} + lead(precipitation_sum, 2) {PLAIN}
  + lead(precipitation_sum, 3) {PLAIN} AS precip_3day_next FROM daily_weather) a WHERE precip_3day_next IS NOT NULL) b"""


def _persistence(spark, sf):
    dw = win.regression_target(fx.daily_weather(spark, sf, nulls=True))
    return dw.select("series_key", "time", F.col("precip_3day_next").alias("y"),
                     F.lag("precip_3day_next", 1).over(win.series_window()).alias("yhat"))


def _fold_metrics_sql(fold_sql: str) -> str:
    return f"""SELECT fold, min(train_end) AS train_end, count(*) AS n,
  {R('sqrt(sum((y - yhat) * (y - yhat)) / count(*))')} AS rmse, {R('sum(abs(y - yhat)) / count(*)')} AS mae,
  {R('CASE WHEN var_pop(y) * count(*) <> 0 THEN 1 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(*)) '
     'WHEN sum((y - yhat) * (y - yhat)) = 0 THEN 1.0 ELSE 0.0 END')} AS r2
FROM ({fold_sql}) f WHERE fold IS NOT NULL AND y IS NOT NULL AND yhat IS NOT NULL GROUP BY fold"""


def _fold_metrics(df):
    from dailyseries.operators.metrics import regression_metrics
    f = df.where(F.col("fold").isNotNull())
    m = regression_metrics(f, "y", "yhat", by=["fold"])
    te = f.groupBy("fold").agg(F.min("train_end").alias("train_end"))
    return m.join(te, "fold").select("fold", "train_end", "n", "rmse", "mae", "r2")


WF_SQL = """SELECT *, CASE WHEN _pos >= _e0 AND _s > 0 AND _e0 + (floor((_pos - _e0) / _s) + 1) * _s <= _n
  THEN CAST(floor((_pos - _e0) / _s) AS INTEGER) END AS fold,
  CAST(_e0 + floor((_pos - _e0) / _s) * _s AS BIGINT) AS train_end FROM (
  SELECT *, floor(CAST(_n AS DOUBLE) * 0.6) AS _e0, floor(CAST(_n AS DOUBLE) * 0.1) AS _s FROM (
    SELECT *, row_number() OVER (ORDER BY time, series_key) - 1 AS _pos, count(*) OVER () AS _n FROM persistence) a) b"""


@query("walk_forward_folds", o.with_ctes(_fold_metrics_sql(WF_SQL), daily_weather=DW, persistence=PERSIST_SQL))
def q_walk_forward_folds(spark, sf):
    """L2: walk-forward folds (60 % initial, 10 % steps) scored with the persistence forecast."""
    return _fold_metrics(spl.walk_forward_folds(_persistence(spark, sf)))


TS_SQL = """SELECT *, CASE WHEN _pos >= _n - 5 * _ts AND _ts > 0 THEN CAST(floor((_pos - (_n - 5 * _ts)) / _ts) AS INTEGER) END AS fold,
  CAST(_n - 5 * _ts + floor((_pos - (_n - 5 * _ts)) / _ts) * _ts AS BIGINT) AS train_end FROM (
  SELECT *, _n // 6 AS _ts FROM (
    SELECT *, row_number() OVER (ORDER BY time, series_key) - 1 AS _pos, count(*) OVER () AS _n FROM persistence) a) b"""


@query("time_series_folds", o.with_ctes(_fold_metrics_sql(TS_SQL), daily_weather=DW, persistence=PERSIST_SQL))
def q_time_series_folds(spark, sf):
    """L3: five expanding-window folds scored with the persistence forecast."""
    return _fold_metrics(spl.time_series_folds(_persistence(spark, sf)))


@query("kfold", o.with_ctes("""
SELECT fold, count(*) AS n, min(time) AS min_time, max(time) AS max_time FROM (
  SELECT *, CAST(CASE WHEN _pos < (_n % 3) * (_n // 3 + 1) THEN _pos // (_n // 3 + 1)
     ELSE (_n % 3) + (_pos - (_n % 3) * (_n // 3 + 1)) // (_n // 3) END AS INTEGER) AS fold FROM (
    SELECT *, row_number() OVER (ORDER BY time, series_key) - 1 AS _pos, count(*) OVER () AS _n FROM daily_weather) a) b
GROUP BY fold""", daily_weather=DW))
def q_kfold(spark, sf):
    """Unshuffled 3-fold sizes and date ranges."""
    k = spl.kfold(fx.daily_weather(spark, sf, nulls=True), 3)
    return k.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.min("time").alias("min_time"),
                                 F.max("time").alias("max_time"))


def _strat_sql(k: int = 5) -> str:
    def cnt(m: str, i: int) -> str:
        return f"greatest(0, ({m} - {i} + {k - 1}) // {k})"
    parts, cum = [], []
    for i in range(k):
        cum.append(f"({cnt('_b', i)} - {cnt('_a', i)})")
        parts.append(f"WHEN _r < {' + '.join(cum)} THEN {i}")
    return f"""SELECT player_id, y, CAST(CASE {' '.join(parts)} END AS INTEGER) AS fold FROM (
  SELECT *, _a + _nc AS _b, row_number() OVER (PARTITION BY y ORDER BY player_id) - 1 AS _r FROM (
    SELECT s.*, c._a, c._nc FROM scored s JOIN (
      SELECT y, _nc, coalesce(sum(_nc) OVER (ORDER BY y ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _a
      FROM (SELECT y, count(*) AS _nc FROM scored GROUP BY y) q) c ON s.y = c.y) a) b"""


@query("stratified_folds", o.with_ctes(_strat_sql(), scored=o.SCORED_SQL))
def q_stratified_folds(spark, sf):
    """L4: unshuffled stratified 5-fold assignment of every scored row."""
    return spl.stratified_folds(fx.scored(spark, sf), "y", 5).select("player_id", "y", "fold")


# ------------------------------------------------------------------ R1-R5
IMPUTE_COLS = ["temperature_2m_min", "precipitation_sum", "rain_sum"]
SPLIT_CTE = _split_sql("daily_weather")


def _impute_sql(stat: str) -> str:
    fits = ", ".join(f"{stat.format(c=c)} AS f_{c}" for c in IMPUTE_COLS)
    cols = ", ".join(f"{R(f'coalesce(CAST({c} AS DOUBLE), f_{c})')} AS {c}" for c in IMPUTE_COLS)
    return o.with_ctes(f"SELECT series_key, time, split, {cols} FROM sp, fit", daily_weather=DW, sp=SPLIT_CTE,
                       fit=f"SELECT {fits} FROM sp WHERE split = 'train'")


def _impute_query(strategy: str):
    def run(spark, sf):
        dw = spl.chrono_split(fx.daily_weather(spark, sf, nulls=True))
        return prep.impute(dw, IMPUTE_COLS, strategy).select("series_key", "time", "split", *IMPUTE_COLS)
    return run


query("impute_mean", _impute_sql("avg({c})"))(_impute_query("mean"))
query("impute_median", _impute_sql("quantile_cont({c}, 0.5)"))(_impute_query("median"))
def _mode_sql() -> str:
    mcs = {f"mc_{c}": (f"SELECT {c} AS v, count(*) AS n FROM sp WHERE split = 'train' AND {c} IS NOT NULL "
                       "GROUP BY 1 ORDER BY n DESC, v ASC LIMIT 1") for c in IMPUTE_COLS}
    fit = "SELECT " + ", ".join(f"mc_{c}.v AS f_{c}" for c in IMPUTE_COLS) + " FROM " + ", ".join(mcs)
    cols = ", ".join(f"{R(f'coalesce(CAST({c} AS DOUBLE), f_{c})')} AS {c}" for c in IMPUTE_COLS)
    sql = o.with_ctes(f"SELECT series_key, time, split, {cols} FROM sp, fit", daily_weather=DW, sp=SPLIT_CTE,
                      **mcs, fit=fit)
    return sql.replace("sp AS (", "sp AS MATERIALIZED (", 1)


query("impute_mode", _mode_sql())(_impute_query("most_frequent"))

SCALE_COLS = ["temperature_2m_max", "wind_speed_10m_max", "precipitation_sum", "snowfall_sum", "weather_code"]


def _scale_sql(method: str) -> str:
    if method == "standard":
        fits = ", ".join(f"avg({c}) AS a_{c}, stddev_pop({c}) AS b_{c}" for c in SCALE_COLS)
    else:
        fits = ", ".join(f"CAST(min({c}) AS DOUBLE) AS a_{c}, CAST(max({c}) - min({c}) AS DOUBLE) AS b_{c}"
                         for c in SCALE_COLS)
    cols = ", ".join(R(f"({c} - a_{c}) / CASE WHEN b_{c} = 0 OR b_{c} IS NULL THEN 1 ELSE b_{c} END") + f" AS {c}"
                     for c in SCALE_COLS)
    return o.with_ctes(f"SELECT series_key, time, split, {cols} FROM sp, fit", daily_weather=DW, sp=SPLIT_CTE,
                       fit=f"SELECT {fits} FROM sp WHERE split = 'train'")


def _scale_query(method: str):
    def run(spark, sf):
        dw = spl.chrono_split(fx.daily_weather(spark, sf, nulls=True))
        return prep.scale(dw, SCALE_COLS, method).select("series_key", "time", "split", *SCALE_COLS)
    return run


query("scale_standard", _scale_sql("standard"))(_scale_query("standard"))
query("scale_minmax", _scale_sql("minmax"))(_scale_query("minmax"))


@query("one_hot", o.with_ctes(
    "SELECT series_key, time, " + ", ".join(
        [f"CAST(CASE WHEN weather_code = {c} THEN 1 ELSE 0 END AS INTEGER) AS weather_code_{c}" for c in CODES]
        + [f"CAST(CASE WHEN season = '{s}' THEN 1 ELSE 0 END AS INTEGER) AS season_{s}" for s in SEASONS])
    + " FROM (" + TEMPORAL_SQL + ") t", daily_weather=DW))
def q_one_hot(spark, sf):
    """One-hot of weather code (observed, sorted) and season (all four)."""
    dw = feat.temporal_features(fx.daily_weather(spark, sf, nulls=True))
    out = prep.one_hot(dw, ["weather_code", "season", "not_a_column"])
    return out.select("series_key", "time", *[c for c in out.columns if c.startswith(("weather_code_", "season_"))])


@query("missing_after_impute", o.with_ctes(
    "SELECT " + ", ".join(f"count_if({c} IS NULL) AS {c}_before" for c in IMPUTE_COLS) + ", "
    + ", ".join(f"count_if(coalesce(CAST({c} AS DOUBLE), f_{c}) IS NULL) AS {c}_after" for c in IMPUTE_COLS)
    + " FROM sp, fit", daily_weather=DW, sp=SPLIT_CTE,
    fit="SELECT " + ", ".join(f"avg({c}) AS f_{c}" for c in IMPUTE_COLS) + " FROM sp WHERE split = 'train'"))
def q_missing_after_impute(spark, sf):
    """Missing cells per column before and after train-mean imputation (one job)."""
    dw = spl.chrono_split(fx.daily_weather(spark, sf, nulls=True))
    imp = prep.impute(dw, IMPUTE_COLS, "mean")
    before = dw.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_before") for c in IMPUTE_COLS])
    after = imp.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_after") for c in IMPUTE_COLS])
    from dailyseries.plans.ranking import join_groups
    return join_groups(before, after, [])
