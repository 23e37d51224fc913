import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from dailyseries.operators import windows as win
from dailyseries.plans.longseries import bucketed_series_frame


def frame(spark, values, key=1, start=dt.date(2020, 1, 1), gap_after=None):
    rows = []
    d = start
    for i, v in enumerate(values):
        rows.append((key, d, None if v is None else float(v)))
        d = d + dt.timedelta(days=2 if gap_after is not None and i == gap_after else 1)
    return spark.createDataFrame(rows, "series_key bigint, time date, precipitation_sum double")


def test_regression_target_drops_null_windows(spark):
    vals = [1, 2, 3, 4, None, 6, 7, 8, 9, 10]
    out = win.regression_target(frame(spark, vals)).orderBy("time").collect()
    kept = [r["precipitation_sum"] for r in out]
    assert kept == [1.0, None, 6.0, 7.0]
    assert [r["precip_3day_next"] for r in out] == [9.0, 21.0, 24.0, 27.0]


def test_classification_target_interior_null(spark):
    vals = [1, 0, 0, 0, None, 0.5, 0, 0, 2, 0]
    df = frame(spark, vals).withColumnRenamed("precipitation_sum", "rain_sum")
    out = win.classification_target(df, horizon=2).orderBy("time").collect()
    assert len(out) == 7  # 2 tail rows and the row whose future is null are gone
    assert [r["target_rain"] for r in out] == [0, 0, 1, 0, 0, 1, 0]


def _pandas_rolling(x, n):
    s = pd.Series(x, dtype="float64")
    r = s.rolling(n, min_periods=1)
    return {
        f"precip_{n}d_sum": r.sum(), f"precip_{n}d_avg": r.mean(), f"precip_{n}d_std": r.std(),
        f"precip_{n}d_max": r.max(),
        f"rain_days_{n}d": s.rolling(n, min_periods=1).apply(lambda a: (a > 0).sum(), raw=True),
    }


@pytest.mark.parametrize("seed", [0, 1])
def test_rolling_matches_pandas(spark, seed):
    rng = np.random.default_rng(seed)
    vals = [None if rng.random() < 0.15 else float(rng.integers(0, 5)) for _ in range(45)]
    df = win.rolling_features(frame(spark, vals, gap_after=10)).orderBy("time").toPandas()
    for n in win.ROLLING_WINDOWS:
        for name, ref in _pandas_rolling(vals, n).items():
            np.testing.assert_allclose(df[name].astype(float).to_numpy(), ref.to_numpy(), rtol=1e-9,
                                       atol=1e-12, equal_nan=True, err_msg=name)


def test_full_window_matches_pandas(spark):
    rng = np.random.default_rng(3)
    vals = [None if rng.random() < 0.1 else float(rng.integers(0, 4)) for _ in range(70)]
    out = win.series_frame(frame(spark, vals), win.full_window_cols).orderBy("time").toPandas()
    s = pd.Series(vals, dtype="float64")
    np.testing.assert_allclose(out["precip_7d_sum"].astype(float), s.rolling(7).sum(), equal_nan=True)
    np.testing.assert_allclose(out["precip_30d_avg"].astype(float), s.rolling(30).mean(), equal_nan=True)
    np.testing.assert_allclose(out["precip_7d_std"].astype(float), s.rolling(7).std(), equal_nan=True, rtol=1e-9)
    trend = win.series_frame(frame(spark, vals), lambda w: {"t": win.precip_trend_col(w)}).orderBy("time").toPandas()
    np.testing.assert_allclose(trend["t"].astype(float), s.rolling(3).sum() - s.shift(3).rolling(3).sum(),
                               equal_nan=True)


def test_single_row_std_is_null(spark):
    out = win.rolling_features(frame(spark, [3.0])).collect()[0]
    assert out["precip_3d_std"] is None and out["precip_3d_sum"] == 3.0


def test_bucketed_equals_plain_window(spark):
    rng = np.random.default_rng(7)
    rows = []
    for key in (1, 2):
        d = dt.date(2000, 1, 1)
        for i in range(260 if key == 1 else 40):
            rows.append((key, d, float(rng.integers(0, 9))))
            d += dt.timedelta(days=1 + (i % 5 == 0))
    df = spark.createDataFrame(rows, "series_key bigint, time date, precipitation_sum double")

    def build(w):
        out = win.rolling_precip_cols(w, windows=(3, 30))
        out["lead7"] = F.lead("precipitation_sum", 7).over(w)
        out["lag2"] = F.lag("precipitation_sum", 2).over(w)
        return out

    plain = win.series_frame(df, build).orderBy("series_key", "time").toPandas()
    buck = bucketed_series_frame(df, build, "series_key", "time", back=29, fwd=7, bucket_rows=50)
    buck = buck.orderBy("series_key", "time").toPandas()
    assert len(plain) == len(buck)
    for c in plain.columns:
        if c == "time":
            continue
        np.testing.assert_allclose(plain[c].astype(float), buck[c].astype(float), equal_nan=True, err_msg=c)


def test_halo_range_equals_full_history(spark):
    from dailyseries.plans.halo import window_for_range
    rng = np.random.default_rng(11)
    rows = []
    for key in (1, 2, 3):
        d = dt.date(2000, 1, 1)
        for i in range(120):
            rows.append((key, d, None if rng.random() < 0.1 else float(rng.integers(0, 6))))
            d += dt.timedelta(days=1 + int(rng.integers(0, 3)))  # gaps: rows, not days, count
    df = spark.createDataFrame(rows, "series_key bigint, time date, precipitation_sum double")

    def build(w):
        out = win.rolling_precip_cols(w, windows=(3, 14))
        out["lead3"] = F.lead("precipitation_sum", 3).over(w)
        return out

    full = (win.series_frame(df, build).where("time BETWEEN DATE '2000-03-01' AND DATE '2000-05-31'")
            .orderBy("series_key", "time").toPandas())
    part = (window_for_range(df, build, "2000-03-01", "2000-05-31", back=13, fwd=3)
            .orderBy("series_key", "time").toPandas())
    assert len(full) == len(part) > 0
    for c in full.columns:
        if c != "time":
            np.testing.assert_allclose(full[c].astype(float), part[c].astype(float), equal_nan=True, err_msg=c)


@pytest.mark.parametrize("task", ["regression", "classification"])
def test_pipeline_bucketed_strategy_equals_series(spark, monkeypatch, task):
    from conftest import SF0001
    monkeypatch.setattr(win, "BUCKET_ROWS", 60)  # many buckets per series, halos on every edge
    from dailyseries.plans import fixtures as fx
    from dailyseries.plans.pipeline import build_features
    dw = fx.daily_weather(spark, SF0001, n_series=2, nulls=True)
    a, target = build_features(dw, task=task, leak_safe=False, strategy="series")
    b, _ = build_features(dw, task=task, leak_safe=False, strategy="bucketed")
    cols = ["series_key", "time", target, "lag1", "lag2", "precip_30d_std", "temp_anomaly", "radiation_lag7",
            "temperature_2m_min_30d_min"]
    pa = a.select(*cols).orderBy("series_key", "time").toPandas()
    pb = b.select(*cols).orderBy("series_key", "time").toPandas()
    assert len(pa) == len(pb) > 0
    for c in cols[2:]:
        np.testing.assert_allclose(pa[c].astype(float), pb[c].astype(float), equal_nan=True, err_msg=c)


@pytest.mark.parametrize("task", ["regression", "classification"])
def test_leak_safe_features_ignore_the_future(spark, task):
    from conftest import SF0001
    from dailyseries.plans import fixtures as fx
    from dailyseries.plans.pipeline import build_features
    dw = fx.daily_weather(spark, SF0001, nulls=True)
    cut = dt.date(1997, 6, 30)
    future = F.col("time") > F.lit(cut)
    bumped = dw.withColumns({c: F.when(future, F.col(c) * 3 + 1).otherwise(F.col(c))
                             for c in ("precipitation_sum", "rain_sum", "temperature_2m_max", "wind_speed_10m_max")})
    a, target = build_features(dw, task=task, leak_safe=True)
    b, _ = build_features(bumped, task=task, leak_safe=True)
    feats = [c for c in a.columns if c not in ("series_key", "time", target, "season")]
    past = F.col("time") <= F.lit(cut)
    pa = a.where(past).select("series_key", "time", *feats).orderBy("series_key", "time").toPandas()
    pb = b.where(past).select("series_key", "time", *feats).orderBy("series_key", "time").toPandas()
    assert len(pa) == len(pb) > 0
    for c in feats:
        np.testing.assert_allclose(pa[c].astype(float), pb[c].astype(float), equal_nan=True, err_msg=c)
    # the parity mode leaks: its regression lags read the target, i.e. the future
    if task == "regression":
        pa2, _ = build_features(dw, task=task, leak_safe=False)
        pb2, _ = build_features(bumped, task=task, leak_safe=False)
        x = pa2.where(past).select("series_key", "time", "lag1").orderBy("series_key", "time").toPandas()
        y = pb2.where(past).select("series_key", "time", "lag1").orderBy("series_key", "time").toPandas()
        assert not np.allclose(x["lag1"].astype(float), y["lag1"].astype(float), equal_nan=True)


def test_bucketed_windows_equal_plain_ones_on_null_keys_and_gaps(spark):
    rows = []
    for key in (1, None):
        d = dt.date(2001, 1, 1)
        for i in range(70):
            rows.append((key, d, float(i * i % 17)))
            d += dt.timedelta(days=1 + i % 4)
    df = spark.createDataFrame(rows, "series_key bigint, time date, precipitation_sum double")

    def build(w):
        return {**win.rolling_precip_cols(w, windows=(3, 7)), "next": F.lead("precipitation_sum", 2).over(w)}

    a = win.series_frame(df, build, back=6, fwd=2)
    b = win.series_frame(df, build, back=6, fwd=2, strategy="bucketed", bucket_rows=9)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())) and a.count() == 140


def test_halo_keeps_null_series(spark):
    from dailyseries.plans.halo import window_for_range
    rows = [(None, dt.date(2000, 1, i), 1.0) for i in range(1, 11)]
    df = spark.createDataFrame(rows, "series_key bigint, time date, x double")
    out = window_for_range(df, lambda w: {"s": F.sum("x").over(win.trailing(w, 3))}, "2000-01-05", "2000-01-06", back=2)
    assert [r.s for r in out.orderBy("time").collect()] == [3.0, 3.0]


def test_rolling_statistics_by_batches_equal_the_window_functions(spark):
    import random
    rng = random.Random(3)
    rows = [(k, i, rng.choice([None, 0.0, 0.1, round(rng.uniform(-5, 50), 2)]), 0.1 if k == 2 else rng.random())
            for k, n in ((None, 40), (0, 1), (1, 70), (2, 45), (3, 33)) for i in range(n)]
    df = spark.createDataFrame(rows, "series_key long, time int, precipitation_sum double, temperature_2m_max double")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")  # frames reach over several batches
    try:
        stats = win.rolling_precip_stats() + win.rolling_weather_stats(["temperature_2m_max"])
        got = win.trailing_stats(df.repartition(7), stats).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    w = win.series_window()
    want = df.withColumns(win.rolling_precip_cols(w) | win.rolling_weather_cols(w, ["temperature_2m_max"])).collect()
    of = {(r["series_key"], r["time"]): r.asDict() for r in got}
    assert len(of) == len(got) == len(want)
    for r in want:
        assert of[r["series_key"], r["time"]] == pytest.approx(r.asDict(), abs=1e-9)
    assert max(r["temperature_2m_max_30d_std"] or 0.0 for r in got if r["series_key"] == 2) == 0
