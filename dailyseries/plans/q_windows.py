"""Registered queries: series windows and features (W*, F*, J2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from dailyseries.functions.height import height_to_cm
from dailyseries.operators import features as feat
from dailyseries.operators import windows as win
from dailyseries.plans import fixtures as fx
from dailyseries.plans import oracle as o
from dailyseries.plans.registry import query

W = "OVER (PARTITION BY series_key ORDER BY time {})"


def rows(n: int) -> str:
    return W.format(f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW")


def rows_between(lo: int, hi: int) -> str:
    f = lambda v: "CURRENT ROW" if v == 0 else (f"{-v} PRECEDING" if v < 0 else f"{v} FOLLOWING")
    return W.format(f"ROWS BETWEEN {f(lo)} AND {f(hi)}")


PLAIN = W.format("")
DW = o.daily_weather_sql(nulls=True)
DW_FULL = o.daily_weather_sql(nulls=False)


def full(agg: str, x: str, frame: str, n: int) -> str:
    return f"CASE WHEN count({x}) {frame} = {n} THEN {agg} {frame} END"


# ------------------------------------------------------------------ W4-W8
def _rolling_precip_sql() -> str:
    items = []
    x = "precipitation_sum"
    for n in win.ROLLING_WINDOWS:
        fr = rows(n)
        items += [
            (f"precip_{n}d_sum", o.r(f"sum({x}) {fr}")),
            (f"precip_{n}d_avg", o.r(f"avg({x}) {fr}")),
            (f"precip_{n}d_std", o.r(f"stddev_samp({x}) {fr}")),
            (f"precip_{n}d_max", o.r(f"max({x}) {fr}")),
            (f"rain_days_{n}d", o.r(f"CASE WHEN count({x}) {fr} > 0 THEN sum(CASE WHEN {x} > 0 THEN 1 ELSE 0 END) {fr} END")),
        ]
    return o.with_ctes(f"SELECT series_key, time,\n  {o.select_list(items)}\nFROM daily_weather",
                       daily_weather=DW)


@query("rolling_precip", _rolling_precip_sql())
def q_rolling_precip(spark, sf):
    """Rolling sum/mean/std/max/rain-days of precipitation, min_periods=1."""
    dw = fx.daily_weather(spark, sf, nulls=True)
    out = win.rolling_features(dw)
    return out.select("series_key", "time", *win.rolling_precip_cols(win.series_window()).keys())


# ------------------------------------------------------------------ W1 / W2 / W3
@query("target_regression", o.with_ctes(f"""
SELECT series_key, time, precipitation_sum, precip_3day_next FROM (
  SELECT series_key, time, precipitation_sum,
    {o.r(f"lead(precipitation_sum, 1) {PLAIN} + lead(precipitation_sum, 2) {PLAIN} + lead(precipitation_sum, 3) {PLAIN}")} AS precip_3day_next
  FROM daily_weather) t WHERE precip_3day_next IS NOT NULL""", daily_weather=DW))
def q_target_regression(spark, sf):
    """Next-3-day precipitation; rows with any null among them dropped."""
    dw = fx.daily_weather(spark, sf, nulls=True)
    return win.regression_target(dw).select("series_key", "time", "precipitation_sum", "precip_3day_next")


@query("target_classification", o.with_ctes(f"""
SELECT series_key, time, rain_in_future,
  CAST(coalesce(CAST(rain_in_future > 0.1 AS INTEGER), 0) AS INTEGER) AS target_rain FROM (
  SELECT series_key, time, lead(rain_sum, 7) {PLAIN} AS rain_in_future FROM daily_weather) t
WHERE rain_in_future IS NOT NULL""", daily_weather=DW))
def q_target_classification(spark, sf):
    """Rain 7 days ahead above 0.1 mm; null futures dropped."""
    dw = fx.daily_weather(spark, sf, nulls=True)
    return win.classification_target(dw).select("series_key", "time", "rain_in_future", "target_rain")


@query("lag_features", o.with_ctes(
    "SELECT series_key, time, " + ", ".join(f"lag(precipitation_sum, {n}) {PLAIN} AS lag{n}" for n in (1, 2, 3, 7))
    + " FROM daily_weather", daily_weather=DW))
def q_lag_features(spark, sf):
    """Lags 1, 2, 3, 7 of precipitation."""
    dw = fx.daily_weather(spark, sf, nulls=True)
    return win.lag_features(dw, "precipitation_sum", [1, 2, 3, 7]).select(
        "series_key", "time", "lag1", "lag2", "lag3", "lag7")


# ------------------------------------------------------------------ W9-W11, F2-F19
def _rolling_weather_items(rnd=o.r):
    items = []
    for c in win.ADVANCED_ROLLING_COLUMNS:
        for n in win.ROLLING_WINDOWS:
            fr = rows(n)
            items += [(f"{c}_{n}d_mean", rnd(f"avg({c}) {fr}")), (f"{c}_{n}d_std", rnd(f"stddev_samp({c}) {fr}")),
                      (f"{c}_{n}d_max", rnd(f"max({c}) {fr}")), (f"{c}_{n}d_min", rnd(f"min({c}) {fr}"))]
    return items


def _weather_lag_items():
    items = []
    for n in win.ADVANCED_LAGS:
        items += [(f"temp_max_lag{n}", f"lag(temperature_2m_max, {n}) {PLAIN}"),
                  (f"wind_speed_lag{n}", f"lag(wind_speed_10m_max, {n}) {PLAIN}"),
                  (f"radiation_lag{n}", f"lag(shortwave_radiation_sum, {n}) {PLAIN}")]
    return items


def _derived_items(rnd=o.r):
    msin, mcos = "sin(2 * pi() * month / 12)", "cos(2 * pi() * month / 12)"
    return [
        ("humidity_proxy", rnd("abs(apparent_temperature_max - temperature_2m_max)")),
        ("storm_potential", rnd("wind_speed_10m_max * wind_gusts_10m_max / 100")),
        ("atmospheric_instability", rnd("(temperature_2m_max - temperature_2m_min) * wind_speed_10m_max")),
        ("month_sin", rnd(msin)), ("month_cos", rnd(mcos)),
        ("temp_season_interaction", rnd(f"temperature_2m_max * {msin}")),
        ("wind_season_interaction", rnd(f"wind_speed_10m_max * {mcos}")),
        ("pressure_proxy", rnd("shortwave_radiation_sum / NULLIF(et0_fao_evapotranspiration + 1, 0)")),
        ("energy_balance", rnd("shortwave_radiation_sum - et0_fao_evapotranspiration")),
        ("wind_dir_sin", rnd("sin(2 * pi() * wind_direction_10m_dominant / 360)")),
        ("wind_dir_cos", rnd("cos(2 * pi() * wind_direction_10m_dominant / 360)")),
        ("weather_code_cloudy", "CAST(coalesce(CAST(weather_code >= 2 AS INTEGER), 0) AS INTEGER)"),
        ("weather_code_rainy", "CAST(coalesce(CAST(weather_code >= 61 AS INTEGER), 0) AS INTEGER)"),
    ]


def _advanced_items(rnd=o.r):
    return ([("temp_range", rnd("temperature_2m_max - temperature_2m_min")),
             ("apparent_temp_range", rnd("apparent_temperature_max - apparent_temperature_min")),
             ("temp_anomaly", rnd(f"temperature_2m_max - avg(temperature_2m_max) {rows(30)}"))]
            + _rolling_weather_items(rnd) + _derived_items(rnd) + _weather_lag_items())


TEMPORAL_SQL = """SELECT *, CASE WHEN month IN (12, 1, 2) THEN 'Summer' WHEN month IN (3, 4, 5) THEN 'Autumn'
  WHEN month IN (6, 7, 8) THEN 'Winter' ELSE 'Spring' END AS season FROM (
  SELECT *, CAST(year(time) AS INTEGER) AS year, CAST(month(time) AS INTEGER) AS month FROM daily_weather) t"""


@query("rolling_weather", o.with_ctes(
    f"SELECT series_key, time,\n  {o.select_list(_rolling_weather_items())}\nFROM daily_weather", daily_weather=DW))
def q_rolling_weather(spark, sf):
    """64 rolling mean/std/max/min columns over one window spec."""
    dw = fx.daily_weather(spark, sf, nulls=True)
    cols = win.rolling_weather_cols(win.series_window())
    return win.series_frame(dw, win.rolling_weather_cols, back=29).select("series_key", "time", *cols)


@query("temp_anomaly", o.with_ctes(
    f"SELECT series_key, time, {o.r(f'temperature_2m_max - avg(temperature_2m_max) {rows(30)}')} AS temp_anomaly "
    "FROM daily_weather", daily_weather=DW))
def q_temp_anomaly(spark, sf):
    """Max temperature minus its 30-row mean."""
    dw = fx.daily_weather(spark, sf, nulls=True)
    return dw.select("series_key", "time", win.temp_anomaly_col(win.series_window()).alias("temp_anomaly"))


@query("weather_lags", o.with_ctes(
    f"SELECT series_key, time,\n  {o.select_list(_weather_lag_items())}\nFROM daily_weather", daily_weather=DW))
def q_weather_lags(spark, sf):
    """Lags 1, 2, 3, 7 of temperature, wind and radiation."""
    dw = fx.daily_weather(spark, sf, nulls=True)
    lags = win.weather_lag_cols(win.series_window())
    return win.series_frame(dw, win.weather_lag_cols, back=7).select("series_key", "time", *lags)


@query("temporal_features", o.with_ctes(
    "SELECT series_key, time, year, month, season FROM (" + TEMPORAL_SQL + ") s", daily_weather=DW))
def q_temporal_features(spark, sf):
    """Year, month, southern-hemisphere season."""
    dw = fx.daily_weather(spark, sf, nulls=True)
    return feat.temporal_features(dw).select("series_key", "time", "year", "month", "season")


@query("weather_derived", o.with_ctes(
    f"SELECT series_key, time, {o.r('temperature_2m_max - temperature_2m_min')} AS temp_range, "
    f"{o.r('apparent_temperature_max - apparent_temperature_min')} AS apparent_temp_range,\n  "
    f"{o.select_list(_derived_items())}\nFROM ({TEMPORAL_SQL}) s", daily_weather=DW))
def q_weather_derived(spark, sf):
    """Ranges, proxies, cyclical month and wind direction, code flags."""
    dw = feat.temporal_features(fx.daily_weather(spark, sf, nulls=True))
    d = feat.derived_cols()
    return dw.select("series_key", "time",
                     (F.col("temperature_2m_max") - F.col("temperature_2m_min")).alias("temp_range"),
                     (F.col("apparent_temperature_max") - F.col("apparent_temperature_min")).alias("apparent_temp_range"),
                     *[c.alias(n) for n, c in d.items()])


@query("advanced_features", o.with_ctes(
    f"SELECT series_key, time,\n  {o.select_list(_advanced_items())}\nFROM ({TEMPORAL_SQL}) s", daily_weather=DW))
def q_advanced_features(spark, sf):
    """the 92-column advanced block in one window pass."""
    dw = feat.temporal_features(fx.daily_weather(spark, sf, nulls=True))
    names = list(feat.advanced_cols(win.series_window()))
    return feat.advanced_features(dw).select("series_key", "time", *names)


# ------------------------------------------------------------------ W12-W18, J2, F16, F18
def _full_items():
    x = "precipitation_sum"
    items = [(f"precip_{n}d_sum", o.r(full(f"sum({x})", x, rows(n), n))) for n in (3, 7, 14, 30)]
    items += [(f"precip_{n}d_avg", o.r(full(f"avg({x})", x, rows(n), n))) for n in (7, 30)]
    items += [("precip_7d_std", o.r(full(f"stddev_samp({x})", x, rows(7), 7))),
              ("rain_days_7d", o.r(full(f"sum(CASE WHEN {x} > 0 THEN 1 ELSE 0 END)", x, rows(7), 7)))]
    return items


@query("rolling_full_window", o.with_ctes(
    f"SELECT series_key, time,\n  {o.select_list(_full_items())}\nFROM daily_weather", daily_weather=DW))
def q_rolling_full_window(spark, sf):
    """Full-window (min_periods = n) rolling precipitation statistics."""
    dw = fx.daily_weather(spark, sf, nulls=True)
    cols = win.full_window_cols(win.series_window())
    return win.series_frame(dw, win.full_window_cols, back=29).select("series_key", "time", *cols)


@query("rolling_range", o.with_ctes(
    f"""SELECT series_key, time,
  {o.r(full('max(precipitation_sum)', 'precipitation_sum', rows(7), 7) + ' - ' + full('min(precipitation_sum)', 'precipitation_sum', rows(7), 7))} AS precip_7d_range,
  {o.r(full('max(precipitation_sum)', 'precipitation_sum', rows(7), 7))} AS precip_7d_max
FROM daily_weather""", daily_weather=DW))
def q_rolling_range(spark, sf):
    """7-row range and max of precipitation (full windows)."""
    dw = fx.daily_weather(spark, sf, nulls=True)
    return win.series_frame(dw, win.rolling_range_cols, back=6).select(
        "series_key", "time", "precip_7d_range", "precip_7d_max")


@query("precip_trend", o.with_ctes(
    f"""SELECT series_key, time,
  {o.r(full('sum(precipitation_sum)', 'precipitation_sum', rows(3), 3) + ' - ' + full('sum(precipitation_sum)', 'precipitation_sum', rows_between(-5, -3), 3))} AS precip_trend_3d
FROM daily_weather""", daily_weather=DW))
def q_precip_trend(spark, sf):
    """Last 3 rows' sum minus the 3 before."""
    dw = fx.daily_weather(spark, sf, nulls=True)
    return dw.select("series_key", "time", win.precip_trend_col(win.series_window()).alias("precip_trend_3d"))


@query("lagged_rolling_sum", o.with_ctes(
    f"""SELECT series_key, time,
  {o.r(full('sum(precipitation_sum)', 'precipitation_sum', rows_between(-13, -7), 7))} AS precip_7d_sum_lag1,
  {o.r(full('sum(precipitation_sum)', 'precipitation_sum', rows_between(-59, -30), 30))} AS precip_30d_sum_lag1
FROM daily_weather""", daily_weather=DW))
def q_lagged_rolling_sum(spark, sf):
    """The full 7- and 30-row sums as they were 7 and 30 rows ago."""
    dw = fx.daily_weather(spark, sf, nulls=True)
    return win.series_frame(dw, win.lagged_rolling_cols, back=59).select(
        "series_key", "time", "precip_7d_sum_lag1", "precip_30d_sum_lag1")


@query("rolling_excl_today", o.with_ctes(
    f"""SELECT series_key, time,
  {o.r(f"sum(rain_sum) {rows_between(-3, -1)}")} AS rain_last_3d,
  {o.r(f"sum(rain_sum) {rows_between(-7, -1)}")} AS rain_last_7d,
  {o.r(f"sum(precipitation_sum) {rows_between(-3, -1)}")} AS precip_last_3d,
  {o.r(f"sum(precipitation_sum) {rows_between(-7, -1)}")} AS precip_last_7d,
  lag(rain_sum, 1) {PLAIN} AS rain_lag1, lag(precipitation_sum, 1) {PLAIN} AS precip_lag1
FROM daily_weather""", daily_weather=DW))
def q_rolling_excl_today(spark, sf):
    """Sums of the previous 3 / 7 rows and yesterday's values."""
    dw = fx.daily_weather(spark, sf, nulls=True)
    return win.series_frame(dw, win.excl_today_cols, back=7).select(
        "series_key", "time", "rain_last_3d", "rain_last_7d", "precip_last_3d", "precip_last_7d",
        "rain_lag1", "precip_lag1")


@query("monthly_climatology", o.with_ctes(
    "SELECT series_key, time, " + o.r("avg(precipitation_sum) OVER (PARTITION BY series_key, month(time))")
    + " AS precip_month_mean FROM daily_weather", daily_weather=DW))
def q_monthly_climatology(spark, sf):
    """The series' monthly mean broadcast back to each day."""
    dw = fx.daily_weather(spark, sf, nulls=True)
    return dw.select("series_key", "time", win.monthly_climatology_col().alias("precip_month_mean"))


@query("climatology_anomaly", o.with_ctes(
    "SELECT series_key, time, " + o.r(full("sum(precipitation_sum)", "precipitation_sum", rows(30), 30)
    + " - avg(precipitation_sum) OVER (PARTITION BY series_key, month(time))") + " AS precip_30d_anomaly FROM daily_weather",
    daily_weather=DW))
def q_climatology_anomaly(spark, sf):
    """Full 30-row sum minus the monthly mean."""
    dw = fx.daily_weather(spark, sf, nulls=True)
    return dw.select("series_key", "time", win.climatology_anomaly_col(win.series_window()).alias("precip_30d_anomaly"))


@query("rain_flags", o.with_ctes(
    f"""SELECT series_key, time,
  CAST(coalesce(CAST({full('sum(precipitation_sum)', 'precipitation_sum', rows(3), 3)} > 0 AS INTEGER), 0) AS INTEGER) AS rain_flag_3d,
  CAST(coalesce(CAST({full('sum(precipitation_sum)', 'precipitation_sum', rows(7), 7)} > 0 AS INTEGER), 0) AS INTEGER) AS rain_flag_7d
FROM daily_weather""", daily_weather=DW))
def q_rain_flags(spark, sf):
    """F16: 0/1 flags of the full 3- and 7-row sums being positive (null -> 0)."""
    dw = fx.daily_weather(spark, sf, nulls=True)
    fw = win.full_window_cols(win.series_window())
    return dw.select("series_key", "time",
                     win.threshold_flag(fw["precip_3d_sum"], 0).alias("rain_flag_3d"),
                     win.threshold_flag(fw["precip_7d_sum"], 0).alias("rain_flag_7d"))


@query("log1p_columns", o.with_ctes(
    f"SELECT series_key, time, {o.r('ln(1 + precipitation_sum)')} AS precipitation_sum_log1p, "
    f"{o.r('ln(1 + rain_sum)')} AS rain_sum_log1p FROM daily_weather", daily_weather=DW))
def q_log1p_columns(spark, sf):
    """log1p of the rain columns."""
    from dailyseries.functions.scalar import log1p_columns
    dw = fx.daily_weather(spark, sf, nulls=True)
    return log1p_columns(dw, ["precipitation_sum", "rain_sum"]).select(
        "series_key", "time", "precipitation_sum_log1p", "rain_sum_log1p")


@query("sequences", o.with_ctes(f"""
SELECT series_key, time, label, CAST(len(seq) AS INTEGER) AS seq_len,
  {o.r('list_sum(list_transform(seq, lambda s: s.precipitation_sum))')} AS seq_precip_sum,
  {o.r('list_sum(list_transform(seq, lambda s: s.temperature_2m_max))')} AS seq_temp_sum,
  {', '.join(f"{o.r(f'seq[{i}].precipitation_sum')} AS precip_{i}, {o.r(f'seq[{i}].temperature_2m_max')} AS temp_{i}"
             for i in range(1, 8))}
FROM (SELECT series_key, time, CAST(coalesce(CAST(rain_sum > 0.1 AS INTEGER), 0) AS INTEGER) AS label,
        list(struct_pack(precipitation_sum := precipitation_sum, temperature_2m_max := temperature_2m_max))
        {rows_between(-7, -1)} AS seq FROM daily_weather) t
WHERE len(seq) = 7""", daily_weather=DW_FULL))
def q_sequences(spark, sf):
    """The 7 previous rows as a sequence with today's label, position by position."""
    dw = fx.daily_weather(spark, sf).withColumn("label", win.threshold_flag(F.col("rain_sum"), 0.1))
    s = win.sequences(dw, ["precipitation_sum", "temperature_2m_max"], "label", 7)
    return s.select("series_key", "time", "label", F.size("sequence").alias("seq_len"),
                    F.aggregate("sequence", F.lit(0.0), lambda a, e: a + e["precipitation_sum"]).alias("seq_precip_sum"),
                    F.aggregate("sequence", F.lit(0.0), lambda a, e: a + e["temperature_2m_max"]).alias("seq_temp_sum"),
                    *[F.col("sequence")[i - 1]["precipitation_sum"].alias(f"precip_{i}") for i in range(1, 8)],
                    *[F.col("sequence")[i - 1]["temperature_2m_max"].alias(f"temp_{i}") for i in range(1, 8)])


# ------------------------------------------------------------------ F1, P2-P4, P10, P14
@query("height_to_cm", o.with_ctes(
    f"SELECT player_id, ht, {o.r(o.HEIGHT_SQL)} AS height_cm FROM players", players=o.PLAYERS_RAW_SQL))
def q_height_to_cm(spark, sf):
    """text heights (feet'inches'' or D-MMM) to centimetres."""
    p = fx.players_raw(spark, sf)
    return p.select("player_id", "ht", height_to_cm("ht").alias("height_cm"))


@query("keep_columns", o.with_ctes(
    "SELECT time, precipitation_sum, rain_sum, year, month, season FROM (" + TEMPORAL_SQL + ") s", daily_weather=DW))
def q_keep_columns(spark, sf):
    """Keep list plus the calendar columns; unknown names ignored."""
    dw = fx.daily_weather(spark, sf, nulls=True)
    return feat.temporal_features(dw, keep_columns=["precipitation_sum", "rain_sum", "no_such_column"])


@query("select_features", o.with_ctes(
    "SELECT series_key, time, temperature_2m_max, wind_speed_10m_max, rain_sum FROM daily_weather", daily_weather=DW))
def q_select_features(spark, sf):
    """Strict named projection."""
    dw = fx.daily_weather(spark, sf, nulls=True)
    return feat.select_features(dw, ["series_key", "time", "temperature_2m_max", "wind_speed_10m_max", "rain_sum"])


@query("drop_leakage", o.with_ctes(
    "SELECT * EXCLUDE (precipitation_sum, rain_sum, precipitation_hours) FROM daily_weather", daily_weather=DW))
def q_drop_leakage(spark, sf):
    """Drop the same-day rain columns, ignoring absent names."""
    dw = fx.daily_weather(spark, sf, nulls=True)
    return feat.drop_columns(dw, list(feat.LEAKAGE_COLUMNS) + ["not_there"])


INF_SQL = """SELECT series_key, time,
  CASE WHEN precipitation_sum > 40 THEN CAST('inf' AS DOUBLE) WHEN precipitation_sum = 0 THEN CAST('nan' AS DOUBLE)
       ELSE precipitation_sum END AS a,
  CASE WHEN temperature_2m_max < 10 THEN CAST('-inf' AS DOUBLE) ELSE temperature_2m_max END AS b,
  weather_code FROM daily_weather"""


def _with_inf(dw):
    return dw.select(
        "series_key", "time",
        F.when(F.col("precipitation_sum") > 40, F.lit(float("inf")))
         .when(F.col("precipitation_sum") == 0, F.lit(float("nan"))).otherwise(F.col("precipitation_sum")).alias("a"),
        F.when(F.col("temperature_2m_max") < 10, F.lit(float("-inf"))).otherwise(F.col("temperature_2m_max")).alias("b"),
        "weather_code")


@query("inf_to_null", o.with_ctes(
    "SELECT series_key, time, CASE WHEN isnan(a) OR isinf(a) THEN NULL ELSE a END AS a, "
    "CASE WHEN isnan(b) OR isinf(b) THEN NULL ELSE b END AS b, weather_code FROM x",
    daily_weather=DW, x=INF_SQL))
def q_inf_to_null(spark, sf):
    """P10: NaN and +/-inf to NULL in every floating column."""
    from dailyseries.functions.scalar import inf_to_null
    return inf_to_null(_with_inf(fx.daily_weather(spark, sf, nulls=True)))


@query("coerce_numeric", o.with_ctes(
    "SELECT player_id, TRY_CAST(ht AS DOUBLE) AS ht_num, TRY_CAST(p_brand AS DOUBLE) AS brand_num, "
    "TRY_CAST(CAST(year AS VARCHAR) AS DOUBLE) AS year_num, "
    "TRY_CAST(regexp_extract(p_brand, '(\\d+)', 1) AS DOUBLE) AS brand_digits FROM players",
    players=o.PLAYERS_RAW_SQL))
def q_coerce_numeric(spark, sf):
    """Text to number, unparsable to null."""
    p = fx.players_raw(spark, sf)
    return p.select("player_id", F.col("ht").try_cast("double").alias("ht_num"),
                    F.col("p_brand").try_cast("double").alias("brand_num"),
                    F.col("year").cast("string").try_cast("double").alias("year_num"),
                    F.regexp_extract("p_brand", r"(\d+)", 1).try_cast("double").alias("brand_digits"))


def _range_sql() -> str:
    full = _rolling_precip_sql()
    body = full[full.rindex("SELECT series_key, time,"):]
    return o.with_ctes(f"SELECT * FROM ({body}) x WHERE time BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'",
                       daily_weather=DW)


@query("features_date_range", _range_sql())
def q_features_date_range(spark, sf):
    """Rolling precipitation features for 1996 only, computed on the
    per-series halo (29 rows back) instead of the whole history."""
    from dailyseries.plans.halo import window_for_range
    dw = fx.daily_weather(spark, sf, nulls=True)
    out = window_for_range(dw, win.rolling_precip_cols, "1996-01-01", "1996-12-31", back=29)
    return out.select("series_key", "time", *win.rolling_precip_cols(win.series_window()).keys())
