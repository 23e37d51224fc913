"""Registered queries: data quality (A1-A3, P1, P13) and exploration
(A4-A16, P8, P9, P16, O6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from dailyseries.operators import explore as ex
from dailyseries.operators import features as feat
from dailyseries.operators import quality as qa
from dailyseries.operators import splits as spl
from dailyseries.operators import windows as win
from dailyseries.plans import fixtures as fx
from dailyseries.plans import oracle as o
from dailyseries.plans.q_pipeline import MEASURES, _split_sql
from dailyseries.plans.q_windows import PLAIN, TEMPORAL_SQL
from dailyseries.plans.registry import query

R = o.r
DW = o.daily_weather_sql(nulls=True)
DW_COLS = ["series_key", "time", "weather_code"] + MEASURES
TARGET_SQL = f"""SELECT * FROM (SELECT *, lead(precipitation_sum, 1) {PLAIN} + lead(precipitation_sum, 2) {PLAIN}
  + lead(precipitation_sum, 3) {PLAIN} AS precip_3day_next FROM daily_weather) a WHERE precip_3day_next IS NOT NULL"""
CLS_SQL = f"""SELECT *, CAST(coalesce(CAST(rain_in_future > 0.1 AS INTEGER), 0) AS INTEGER) AS target_rain FROM (
  SELECT *, lead(rain_sum, 7) {PLAIN} AS rain_in_future FROM daily_weather) a WHERE rain_in_future IS NOT NULL"""


def _target(spark, sf):
    return win.regression_target(fx.daily_weather(spark, sf, nulls=True))


def _cls(spark, sf):
    return feat.temporal_features(win.classification_target(fx.daily_weather(spark, sf, nulls=True)))


# ------------------------------------------------------------------ A1-A3
def _q_sql(name: str, table: str, cols: list[str], doubles: list[str], numeric: int, text: int) -> str:
    miss = " + ".join(f"count_if({c} IS NULL{' OR isnan(' + c + ')' if c in doubles else ''})" for c in cols)
    return f"""SELECT '{name}' AS dataset, r.rows, CAST({len(cols)} AS INTEGER) AS columns, r.missing_values,
  {R(f"CASE WHEN r.rows * {len(cols)} > 0 THEN r.missing_values / (r.rows * {len(cols)}) * 100 END")} AS missing_percentage,
  d.duplicate_rows, CAST({numeric} AS INTEGER) AS numeric_columns, CAST({text} AS INTEGER) AS categorical_columns
FROM (SELECT count(*) AS rows, CAST({miss} AS BIGINT) AS missing_values FROM {table}) r,
     (SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS duplicate_rows FROM (
        SELECT count(*) AS c FROM {table} GROUP BY {', '.join(cols)}) g) d"""


QUALITY_SQL = o.with_ctes(
    _q_sql("players", "players", ["player_id", "year", "p_retailprice", "p_brand", "ht", "drafted"],
           ["p_retailprice"], 4, 2)
    + "\nUNION ALL " + _q_sql("scored", "scored", ["player_id", "y", "p"], ["p"], 3, 0)
    + "\nUNION ALL " + _q_sql("daily_weather", "daily_weather", DW_COLS, MEASURES, 17, 0),
    players=o.PLAYERS_RAW_SQL, scored=o.SCORED_SQL, daily_weather=DW)


@query("quality_report", QUALITY_SQL)
def q_quality_report(spark, sf):
    """A1: quality report of three tables (one row each)."""
    return qa.quality_reports({"players": fx.players_raw(spark, sf), "scored": fx.scored(spark, sf),
                               "daily_weather": fx.daily_weather(spark, sf, nulls=True)})


@query("quality_players", """SELECT count(DISTINCT o_custkey) AS unique_players,
  CAST(count(*) - count(DISTINCT o_custkey) - max(CASE WHEN o_custkey IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS duplicate_players
FROM orders""")
def q_quality_players(spark, sf):
    """A2: distinct and duplicated ids (customers of orders repeat)."""
    from dailyseries.sources.tables import read_table
    return qa.player_quality(read_table(spark, sf, "orders").select(F.col("o_custkey").alias("player_id")))


@query("quality_draft", o.with_ctes(
    f"SELECT drafted, count(*) AS count, (SELECT {R('avg(drafted) * 100')} FROM players) AS draft_rate "
    "FROM players WHERE drafted IS NOT NULL GROUP BY drafted", players=o.PLAYERS_RAW_SQL))
def q_quality_draft(spark, sf):
    """A3: draft rate and label counts."""
    return qa.draft_quality(fx.players_raw(spark, sf))


@query("prepare_features", o.with_ctes(
    "SELECT CASE WHEN split = 'test' THEN player_id END AS player_id, p_retailprice, p_brand, ht, drafted, split "
    "FROM (" + _split_sql("players", "year, player_id") + ") s", players=o.PLAYERS_RAW_SQL))
def q_prepare_features(spark, sf):
    """Drop year; player_id kept only as the test rows' key."""
    p = spl.chrono_split(fx.players_raw(spark, sf), order_cols=("year", "player_id"))
    return feat.prepare_features(p)


@query("split_contract", o.with_ctes(
    "SELECT split, count(*) AS rows, count_if(target_rain IS NULL) AS missing_labels FROM ("
    + _split_sql("c") + ") s GROUP BY split", daily_weather=DW, c=CLS_SQL))
def q_split_contract(spark, sf):
    """Rows per split and missing labels in one grouped job."""
    c = spl.chrono_split(win.classification_target(fx.daily_weather(spark, sf, nulls=True)))
    return qa.split_contract(c, "target_rain")


# ------------------------------------------------------------------ A4-A16
@query("class_distribution", o.with_ctes(
    "SELECT target_rain, count(*) AS count, round(count(*) / (SELECT count(*) FROM c) * 100, 2) AS percent "
    "FROM c GROUP BY target_rain", daily_weather=DW, c=CLS_SQL))
def q_class_distribution(spark, sf):
    """A4: class counts and percentages of the 7-day rain target."""
    return ex.class_distribution(_cls(spark, sf), "target_rain")


@query("monthly_mean", o.with_ctes(
    "SELECT series_key, CAST(month(time) AS INTEGER) AS month, " + ", ".join(
        f"{R(f'avg({c})')} AS {c}" for c in ("precipitation_sum", "rain_sum", "temperature_2m_max"))
    + " FROM daily_weather GROUP BY 1, 2", daily_weather=DW))
def q_monthly_mean(spark, sf):
    """Monthly means per series."""
    dw = fx.daily_weather(spark, sf, nulls=True).withColumn("month", F.month("time"))
    return ex.group_means(dw, ["series_key", "month"], ["precipitation_sum", "rain_sum", "temperature_2m_max"])


@query("rate_by_category", o.with_ctes(
    "SELECT category, value, " + R("avg(target_rain)") + " AS rate, count(*) AS n FROM ("
    "SELECT target_rain, 'weather_code' AS category, CAST(weather_code AS VARCHAR) AS value FROM c "
    "UNION ALL SELECT target_rain, 'month', CAST(month AS VARCHAR) FROM c "
    "UNION ALL SELECT target_rain, 'season', season FROM c) t GROUP BY 1, 2",
    daily_weather=DW, cl=CLS_SQL, c=TEMPORAL_SQL.replace("FROM daily_weather", "FROM cl")))
def q_rate_by_category(spark, sf):
    """Rain rate by weather code, month and season in one shuffle."""
    return ex.rate_by_category(_cls(spark, sf), "target_rain", ["weather_code", "month", "season"])


@query("pivot_year_month", o.with_ctes(
    "SELECT series_key, CAST(year(time) AS INTEGER) AS year, " + ", ".join(
        f"{R(f'avg(CASE WHEN month(time) = {m} THEN precipitation_sum END)')} AS m{m:02d}" for m in range(1, 13))
    + " FROM daily_weather GROUP BY 1, 2", daily_weather=DW))
def q_pivot_year_month(spark, sf):
    """Year x month pivot of mean precipitation per series."""
    return ex.pivot_year_month(fx.daily_weather(spark, sf, nulls=True), "precipitation_sum", by=["series_key"])


@query("describe_target", o.with_ctes(
    "SELECT count(precip_3day_next) AS count, " + R("avg(precip_3day_next)") + " AS mean, "
    + R("stddev_samp(precip_3day_next)") + " AS std, min(precip_3day_next) AS min, max(precip_3day_next) AS max, "
    + ", ".join(f"{R(f'quantile_cont(precip_3day_next, {q})')} AS p{int(round(q * 100))}" for q in ex.DESCRIBE_PERCENTILES)
    + " FROM t", daily_weather=DW, t=TARGET_SQL))
def q_describe_target(spark, sf):
    """Describe with percentiles .25 .5 .75 .9 .95 .99 (exact, linear)."""
    return ex.describe(_target(spark, sf), "precip_3day_next")


BOX_SQL = f"""SELECT month, whisker_low, whisker_high, outliers, n, {R('q1')} AS q1, {R('median')} AS median,
  {R('q3')} AS q3, {R('lo_fence')} AS lo_fence, {R('hi_fence')} AS hi_fence FROM (
  SELECT q.month, min(CASE WHEN x >= lo_fence AND x <= hi_fence THEN x END) AS whisker_low,
    max(CASE WHEN x >= lo_fence AND x <= hi_fence THEN x END) AS whisker_high,
    count_if(NOT (x >= lo_fence AND x <= hi_fence)) AS outliers, count(*) AS n,
    any_value(q1) AS q1, any_value(median) AS median, any_value(q3) AS q3,
    any_value(lo_fence) AS lo_fence, any_value(hi_fence) AS hi_fence
  FROM (SELECT CAST(month(time) AS INTEGER) AS month, precipitation_sum AS x FROM daily_weather WHERE precipitation_sum IS NOT NULL) d
  JOIN (SELECT *, q1 - 1.5 * (q3 - q1) AS lo_fence, q3 + 1.5 * (q3 - q1) AS hi_fence FROM (
          SELECT CAST(month(time) AS INTEGER) AS month, quantile_cont(precipitation_sum, 0.25) AS q1,
            quantile_cont(precipitation_sum, 0.5) AS median, quantile_cont(precipitation_sum, 0.75) AS q3
          FROM daily_weather GROUP BY 1) a) q ON d.month = q.month GROUP BY q.month) z"""


@query("boxplot_stats", o.with_ctes(BOX_SQL, daily_weather=DW))
def q_boxplot_stats(spark, sf):
    """A10: box-plot statistics of daily precipitation by month."""
    dw = fx.daily_weather(spark, sf, nulls=True).withColumn("month", F.month("time"))
    return ex.boxplot_stats(dw, "precipitation_sum", ["month"])


def _hist_sql(src: str, col: str, by: str | None) -> str:
    g = f"{by}, " if by else ""
    on = f"ON d.{by} = r.{by}" if by else "ON TRUE"
    sel = f"d.{by}, " if by else ""
    w = "((_hi - _lo) / 50)"
    return f"""SELECT {g}bin, {R(f'_lo + bin * {w}')} AS bin_start, {R(f'_lo + (bin + 1) * {w}')} AS bin_end, count(*) AS count,
  {R(f'CASE WHEN {w} > 0 THEN count(*) / (_n * {w}) END')} AS density FROM (
  SELECT {sel}_lo, _hi, _n, CAST(CASE WHEN (_hi - _lo) / 50 > 0 THEN least(floor((x - _lo) / ((_hi - _lo) / 50)), 49) ELSE 0 END AS INTEGER) AS bin
  FROM (SELECT {g}{col} AS x FROM {src} WHERE {col} IS NOT NULL) d
  JOIN (SELECT {g}min({col}) AS _lo, max({col}) AS _hi, count({col}) AS _n FROM {src} {'GROUP BY ' + by if by else ''}) r {on}) b
GROUP BY {g}bin, _lo, _hi, _n"""


@query("histogram", o.with_ctes(_hist_sql("t", "precip_3day_next", None), daily_weather=DW, t=TARGET_SQL))
def q_histogram(spark, sf):
    """50-bin histogram of the 3-day target."""
    return ex.histogram(_target(spark, sf), "precip_3day_next", 50)


@query("histogram_by_class", o.with_ctes(_hist_sql("scored", "p", "y"), scored=o.SCORED_SQL))
def q_histogram_by_class(spark, sf):
    """Per-class 50-bin score densities."""
    return ex.histogram(fx.scored(spark, sf), "p", 50, by=["y"])


def _driver_sql() -> str:
    found = ex.find_climate_columns(DW_COLS)
    parts = [f"SELECT '{lg}' AS driver, '{c}' AS column, {R(f'corr(precip_3day_next, {c})')} AS pearson_r, count(*) AS n "
             f"FROM t WHERE precip_3day_next IS NOT NULL AND {c} IS NOT NULL"
             for lg, cols in found.items() for c in cols]
    return o.with_ctes("SELECT * FROM (" + "\nUNION ALL ".join(parts) + ") u WHERE n >= 4", daily_weather=DW, t=TARGET_SQL)


@query("driver_correlations", _driver_sql())
def q_driver_correlations(spark, sf):
    """Discovered climate drivers correlated with the target (one job)."""
    return ex.driver_correlations(_target(spark, sf), "precip_3day_next")


@query("lag_correlation", o.with_ctes(
    f"SELECT series_key, {R('corr(precipitation_sum, l1)')} AS corr_lag1, {R('corr(precipitation_sum, l2)')} AS corr_lag2 "
    f"FROM (SELECT series_key, precipitation_sum, lag(precipitation_sum, 1) {PLAIN} AS l1, "
    f"lag(precipitation_sum, 2) {PLAIN} AS l2 FROM daily_weather) a GROUP BY series_key", daily_weather=DW))
def q_lag_correlation(spark, sf):
    """Correlation of precipitation with its lags 1 and 2, per series."""
    return ex.lag_correlation(fx.daily_weather(spark, sf, nulls=True), "precipitation_sum")


ACF_SQL = o.with_ctes(f"""
SELECT r.series_key, h.lag, {R('CASE WHEN any_value(c0) > 0 THEN coalesce(sum((a.value - m) * (b.value - m)), 0) / any_value(c0) END')} AS autocorr
FROM st r CROSS JOIN (SELECT CAST(range AS INTEGER) AS lag FROM range(1, 61)) h
LEFT JOIN rk a ON a.series_key = r.series_key
LEFT JOIN rk b ON b.series_key = a.series_key AND b.rn = a.rn + h.lag
GROUP BY r.series_key, h.lag""", s=o.ORDERS_DAILY_SQL,
    rk="SELECT series_key, value, row_number() OVER (PARTITION BY series_key ORDER BY time) AS rn FROM s",
    st="SELECT series_key, avg(value) AS m, sum((value - (SELECT avg(value) FROM s)) * (value - (SELECT avg(value) FROM s))) AS c0 FROM s GROUP BY series_key")


@query("autocorrelation", ACF_SQL)
def q_autocorrelation(spark, sf):
    """Autocorrelation at lags 1..60 of one long series (orders per day),
    computed on 500-row buckets with a 60-row halo (X3)."""
    return ex.autocorrelation(fx.orders_daily(spark, sf), "value", 60, strategy="bucketed", bucket_rows=500)


@query("lag_pairs", o.with_ctes(
    f"SELECT * FROM (SELECT series_key, time, precipitation_sum AS x_t, lead(precipitation_sum, 1) {PLAIN} AS x_next "
    "FROM daily_weather) a WHERE x_next IS NOT NULL", daily_weather=DW))
def q_lag_pairs(spark, sf):
    """(x_t, x_t+1) pairs."""
    return ex.lag_pairs(fx.daily_weather(spark, sf, nulls=True), "precipitation_sum")


@query("distinct_codes", o.with_ctes("SELECT DISTINCT weather_code FROM daily_weather", daily_weather=DW))
def q_distinct_codes(spark, sf):
    """Distinct weather codes."""
    return ex.distinct_values(fx.daily_weather(spark, sf, nulls=True), "weather_code")


@query("zero_nonzero_counts", o.with_ctes(
    "SELECT series_key, count_if(precip_3day_next = 0) AS zero_rows, count_if(precip_3day_next > 0) AS positive_rows "
    "FROM t GROUP BY series_key", daily_weather=DW, t=TARGET_SQL))
def q_zero_nonzero_counts(spark, sf):
    """Dry and wet 3-day windows per series."""
    return ex.zero_nonzero_counts(_target(spark, sf), "precip_3day_next", ["series_key"])


@query("extreme_rows", o.with_ctes(
    "SELECT series_key, time, precip_3day_next FROM t WHERE precip_3day_next >= "
    "(SELECT quantile_cont(precip_3day_next, 0.99) FROM t)", daily_weather=DW, t=TARGET_SQL))
def q_extreme_rows(spark, sf):
    """The wettest 1 % of 3-day windows (exact 0.99 quantile)."""
    return ex.extreme_rows(_target(spark, sf), "precip_3day_next").select("series_key", "time", "precip_3day_next")


@query("sample_rows", o.with_ctes(
    "SELECT series_key, time, precip_3day_next FROM t "
    "ORDER BY md5(concat_ws('|', CAST(series_key AS VARCHAR), CAST(time AS VARCHAR), '42')), series_key, time LIMIT 12000",
    daily_weather=DW, t=TARGET_SQL))
def q_sample_rows(spark, sf):
    """Seeded sample of 12 000 rows (sampling is the feature)."""
    return ex.sample_rows(_target(spark, sf).select("series_key", "time", "precip_3day_next"), 12000)


@query("union_splits", o.with_ctes(
    "SELECT series_key, time, split FROM s WHERE split = 'train' UNION ALL "
    "SELECT series_key, time, split FROM s WHERE split = 'val'", daily_weather=DW, s=_split_sql("daily_weather")))
def q_union_splits(spark, sf):
    """Train and validation rows stacked (UNION ALL)."""
    s = spl.chrono_split(fx.daily_weather(spark, sf, nulls=True)).select("series_key", "time", "split")
    return s.where(F.col("split") == "train").unionByName(s.where(F.col("split") == "val"))
