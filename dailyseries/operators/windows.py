"""Keyed daily-series window operators (lags, leads, rolling statistics).

Frames count **rows**, not calendar days: ``rolling(n)`` is
``rowsBetween(-(n-1), 0)`` over ``partitionBy(key).orderBy(time)``, so a
gap in the dates is not filled.  All expressions built here share one
window specification, so Catalyst plans one exchange on the key and one
sort for all of them (``CollapseWindow``).

Each ``*_cols`` builder returns ``{name: Column}`` for a given spec, so the
caller can put many of them into a single ``withColumns``; the DataFrame
level functions wrap that.  ``series_frame`` runs a builder either on the
plain per-series window or, for very long series, on the bucketed halo
plan of ``dailyseries.plans.longseries``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

KEY, TIME = "series_key", "time"

# fixed values: the reference's rolling sizes and measure names
ROLLING_WINDOWS = (3, 7, 14, 30)
ADVANCED_ROLLING_COLUMNS = ("temperature_2m_max", "temperature_2m_min",
                            "wind_speed_10m_max", "wind_gusts_10m_max")
ADVANCED_LAGS = (1, 2, 3, 7)


def series_window(key: str | Iterable[str] = KEY, time: str = TIME) -> WindowSpec:
    keys = [key] if isinstance(key, str) else list(key)
    return Window.partitionBy(*keys).orderBy(time)


def trailing(w: WindowSpec, n: int) -> WindowSpec:
    """The last ``n`` rows including the current one."""
    return w.rowsBetween(-(n - 1), 0)


def full_window(agg: Column, x: Column, w: WindowSpec, n: int) -> Column:
    """pandas' default ``min_periods = n``: a value only when all n rows are non-null."""
    return F.when(F.count(x).over(w) == n, agg)


# rows per bucket in the bucketed strategy (must exceed every frame's reach)
BUCKET_ROWS = 100_000


def series_frame(df: DataFrame, builder: Callable[[WindowSpec], dict[str, Column]],
                 key: str = KEY, time: str = TIME, back: int = 0, fwd: int = 0,
                 strategy: str = "series", bucket_rows: int | None = None) -> DataFrame:
    """Add the columns of ``builder(w)``.

    ``strategy="series"``: one window partition per series (a daily series
    holds at most one row per day).  ``strategy="bucketed"``: split every
    series into row buckets with ``back``/``fwd`` halo rows copied from the
    neighbours (needed when one series is a large share of all rows).
    Both give the same rows.
    """
    if strategy == "series":
        return df.withColumns(builder(series_window(key, time)))
    if strategy == "bucketed":
        from dailyseries.plans.longseries import bucketed_series_frame
        return bucketed_series_frame(df, builder, key=key, time=time, back=back,
                                     fwd=fwd, bucket_rows=bucket_rows or BUCKET_ROWS)
    raise ValueError(f"unknown strategy {strategy!r}")


# --------------------------------------------------------------- rolling statistics by batches
def rolling_stats(rolling: Iterable[tuple[str, str, str, int]], key: str):
    """The ``mapInArrow`` function of :func:`trailing_stats`: rows come sorted by series
    and time, and the last rows of a batch are kept for the next."""
    rolling = list(rolling)
    reach = max(n for *_, n in rolling)
    by_column: dict[str, list[tuple[str, str, int]]] = {}
    for name, column, stat, n in rolling:
        by_column.setdefault(column, []).append((name, stat, n))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail, last, past = None, None, 0  # values of the rows before, the series they end in, its rows so far
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            keys = batch.column(key)
            codes = keys.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            new = np.r_[last is None or not keys[0].equals(last), codes[1:] != codes[:-1]]
            begun = np.maximum.accumulate(np.where(new, np.arange(rows), -past))
            age = np.arange(rows) - begun  # rows of the series before this one
            last, past = keys[rows - 1], min(int(age[-1]) + 1, reach)
            back = np.arange(reach - 1, -1, -1)[None, :] <= age[:, None]
            values, kept = {}, {}
            for column, wanted in by_column.items():
                x = batch.column(column).cast(pa.float64())
                held = np.r_[tail[column][1] if tail else np.zeros(reach - 1, bool), x.is_valid().to_numpy(zero_copy_only=False)]
                x = np.r_[tail[column][0] if tail else np.zeros(reach - 1), x.fill_null(0.0).to_numpy(zero_copy_only=False)]
                kept[column] = x[rows:], held[rows:]
                x, held = (np.lib.stride_tricks.sliding_window_view(v, reach) for v in (x, held))
                held = held & back
                for n in sorted({n for *_, n in wanted}):
                    w, on = x[:, reach - n:], held[:, reach - n:]
                    count = on.sum(1)
                    some = np.maximum(count, 1)
                    total = np.where(on, w, 0.0).sum(1)
                    mean = total / some
                    high, low = np.where(on, w, -np.inf).max(1), np.fmin.reduce(np.where(on, w, np.inf), 1)
                    for name, stat, m in wanted:
                        if m != n:
                            continue
                        least = 1
                        if stat == "std":
                            out = np.sqrt(np.where(on, (w - mean[:, None]) ** 2, 0.0).sum(1) / np.maximum(count - 1, 1))
                            out, least = np.where(high == low, 0.0, out), 2
                        elif stat == "wet":
                            out = (on & ~(w <= 0)).sum(1).astype(float)
                        else:
                            out = {"sum": total, "mean": mean, "max": high, "min": low}[stat]
                        values[name] = pa.array(out, pa.float64(), mask=count < least)
            tail = kept
            yield pa.RecordBatch.from_arrays([*batch.columns, *[values[name] for name, *_ in rolling]],
                                             [*batch.schema.names, *[name for name, *_ in rolling]])

    return run


def trailing_stats(df: DataFrame, rolling: Iterable[tuple[str, str, str, int]], key: str = KEY, time: str = TIME) -> DataFrame:
    """Add (name, column, stat, n): ``stat`` of the last ``n`` rows of the series, today included.

    Stats are those of ``rolling_precip_cols`` and ``rolling_weather_cols``: sum,
    mean, std (sample), max, min and wet (rows above 0); null without values.
    A window function goes through its frame anew for each row and each
    aggregate; here tasks take a batch of sorted rows, of any number of series, at once."""
    rolling = list(rolling)
    schema = StructType([*df.schema.fields, *[StructField(name, DoubleType()) for name, *_ in rolling]])
    df.select(*[column for _, column, *_ in rolling])  # an unknown column raises here
    ordered = df.repartition(key).sortWithinPartitions(key, time)
    return ordered.mapInArrow(rolling_stats(rolling, key), schema)


def rolling_precip_stats(col: str = "precipitation_sum", windows: Iterable[int] = ROLLING_WINDOWS) -> list[tuple[str, str, str, int]]:
    """``rolling_precip_cols`` for :func:`trailing_stats`."""
    names = {"sum": "precip_{n}d_sum", "mean": "precip_{n}d_avg", "std": "precip_{n}d_std", "max": "precip_{n}d_max", "wet": "rain_days_{n}d"}
    return [(name.format(n=n), col, stat, n) for n in windows for stat, name in names.items()]


def rolling_weather_stats(columns: Iterable[str] = ADVANCED_ROLLING_COLUMNS,
                          windows: Iterable[int] = ROLLING_WINDOWS) -> list[tuple[str, str, str, int]]:
    """``rolling_weather_cols`` for :func:`trailing_stats`."""
    windows = list(windows)
    return [(f"{c}_{n}d_{stat}", c, stat, n) for c in columns for n in windows for stat in ("mean", "std", "max", "min")]


# --------------------------------------------------------------- W1 / W2
def regression_target(df: DataFrame, source: str = "precipitation_sum",
                      name: str = "precip_3day_next", horizon: int = 3,
                      key: str = KEY, time: str = TIME, strategy: str = "series") -> DataFrame:
    """x[t+1] + ... + x[t+h]; any null among them drops the row.

    A sum of ``lead``s, not ``sum().rowsBetween(1, h)``: the windowed sum
    would skip nulls and keep the tail rows.
    """
    def build(w):
        total = F.lead(source, 1).over(w)
        for i in range(2, horizon + 1):
            total = total + F.lead(source, i).over(w)
        return {name: total}
    return series_frame(df, build, key, time, fwd=horizon, strategy=strategy).dropna(subset=[name])


def classification_target(df: DataFrame, source: str = "rain_sum", name: str = "target_rain",
                          threshold: float = 0.1, horizon: int = 7, keep_future: bool = True,
                          key: str = KEY, time: str = TIME, strategy: str = "series") -> DataFrame:
    """``rain_in_future`` = x[t+h]; target = x[t+h] > threshold; null future dropped.

    ``keep_future=True`` keeps ``rain_in_future`` in the table (reference
    parity; it is a leak when used as a feature).
    """
    out = (series_frame(df, lambda w: {"rain_in_future": F.lead(source, horizon).over(w)}, key, time,
                        fwd=horizon, strategy=strategy)
             .withColumn(name, threshold_flag(F.col("rain_in_future"), threshold, ">"))
             .dropna(subset=["rain_in_future"]))
    return out if keep_future else out.drop("rain_in_future")


def threshold_flag(x: Column, t: float, op: str = ">") -> Column:
    """0/1 of a comparison; a null compares as 0 (pandas astype(int))."""
    c = {">": x > t, ">=": x >= t, "<": x < t, "<=": x <= t}[op]
    return F.coalesce(c.cast("int"), F.lit(0))


# --------------------------------------------------------------- W3 / W11 / W17
def lag_cols(w: WindowSpec, col: str, lags: Iterable[int] = (1, 2),
             prefix: str = "lag") -> dict[str, Column]:
    return {f"{prefix}{n}": F.lag(col, n).over(w) for n in lags}


def lag_features(df: DataFrame, col: str, lags: Iterable[int] = (1, 2), prefix: str = "lag",
                 key: str = KEY, time: str = TIME, strategy: str = "series") -> DataFrame:
    """``lag{n}`` = x[t-n].  The reference name carries no source column,
    so a second call overwrites; pass ``prefix`` for a safe name."""
    lags = list(lags)
    return series_frame(df, lambda w: lag_cols(w, col, lags, prefix), key, time, back=max(lags),
                        strategy=strategy)


# --------------------------------------------------------------- W4-W8
def rolling_precip_cols(w: WindowSpec, col: str = "precipitation_sum",
                        windows: Iterable[int] = ROLLING_WINDOWS) -> dict[str, Column]:
    """W4-W8 with ``min_periods=1``: sum, mean, sample std, max, rainy days."""
    x = F.col(col)
    out: dict[str, Column] = {}
    for n in windows:
        f = trailing(w, n)
        out[f"precip_{n}d_sum"] = F.sum(x).over(f)
        out[f"precip_{n}d_avg"] = F.avg(x).over(f)
        out[f"precip_{n}d_std"] = F.stddev_samp(x).over(f)
        out[f"precip_{n}d_max"] = F.max(x).over(f)
        rainy = F.sum(F.when(x > 0, 1).otherwise(0)).over(f).cast("double")
        out[f"rain_days_{n}d"] = F.when(F.count(x).over(f) > 0, rainy)
    return out


def rolling_features(df: DataFrame, col: str = "precipitation_sum",
                     windows: Iterable[int] = ROLLING_WINDOWS, key: str = KEY, time: str = TIME,
                     strategy: str = "series") -> DataFrame:
    windows = list(windows)
    return series_frame(df, lambda w: rolling_precip_cols(w, col, windows), key, time,
                        back=max(windows) - 1, strategy=strategy)


# --------------------------------------------------------------- W9-W11
def rolling_weather_cols(w: WindowSpec, columns: Iterable[str] = ADVANCED_ROLLING_COLUMNS,
                         windows: Iterable[int] = ROLLING_WINDOWS) -> dict[str, Column]:
    """Mean / sample std / max / min of each column over each window."""
    out: dict[str, Column] = {}
    for c in columns:
        x = F.col(c)
        for n in windows:
            f = trailing(w, n)
            out[f"{c}_{n}d_mean"] = F.avg(x).over(f)
            out[f"{c}_{n}d_std"] = F.stddev_samp(x).over(f)
            out[f"{c}_{n}d_max"] = F.max(x).over(f)
            out[f"{c}_{n}d_min"] = F.min(x).over(f)
    return out


def temp_anomaly_col(w: WindowSpec, col: str = "temperature_2m_max", n: int = 30) -> Column:
    """today's value minus the mean of the last n rows (today included)."""
    return F.col(col) - F.avg(col).over(trailing(w, n))


def weather_lag_cols(w: WindowSpec, lags: Iterable[int] = ADVANCED_LAGS) -> dict[str, Column]:
    """Lags of max temperature, wind speed and radiation, interleaved by lag."""
    out: dict[str, Column] = {}
    for n in lags:
        out[f"temp_max_lag{n}"] = F.lag("temperature_2m_max", n).over(w)
        out[f"wind_speed_lag{n}"] = F.lag("wind_speed_10m_max", n).over(w)
        out[f"radiation_lag{n}"] = F.lag("shortwave_radiation_sum", n).over(w)
    return out


# --------------------------------------------------------------- W12-W18 (notebook features)
def full_window_cols(w: WindowSpec, col: str = "precipitation_sum") -> dict[str, Column]:
    """Pandas default (full-window) rolling: sums 3/7/14/30, means 7/30,
    std 7 and rainy days 7 -- null until n non-null rows are in the frame."""
    x = F.col(col)
    out: dict[str, Column] = {}
    for n in (3, 7, 14, 30):
        f = trailing(w, n)
        out[f"precip_{n}d_sum"] = full_window(F.sum(x).over(f), x, f, n)
    for n in (7, 30):
        f = trailing(w, n)
        out[f"precip_{n}d_avg"] = full_window(F.avg(x).over(f), x, f, n)
    f7 = trailing(w, 7)
    out["precip_7d_std"] = full_window(F.stddev_samp(x).over(f7), x, f7, 7)
    out["rain_days_7d"] = full_window(F.sum(F.when(x > 0, 1).otherwise(0)).over(f7).cast("double"), x, f7, 7)
    return out


def rolling_range_cols(w: WindowSpec, col: str = "precipitation_sum", n: int = 7) -> dict[str, Column]:
    """Full-window range (max - min) and max over n rows."""
    x, f = F.col(col), trailing(w, n)
    mx = full_window(F.max(x).over(f), x, f, n)
    mn = full_window(F.min(x).over(f), x, f, n)
    return {f"precip_{n}d_range": mx - mn, f"precip_{n}d_max": mx}


def precip_trend_col(w: WindowSpec, col: str = "precipitation_sum", n: int = 3) -> Column:
    """Sum of the last n rows minus the sum of the n rows before them."""
    x = F.col(col)
    now = w.rowsBetween(-(n - 1), 0)
    before = w.rowsBetween(-(2 * n - 1), -n)
    return full_window(F.sum(x).over(now), x, now, n) - full_window(F.sum(x).over(before), x, before, n)


def lagged_rolling_cols(w: WindowSpec, col: str = "precipitation_sum") -> dict[str, Column]:
    """The full n-row sum as it was n rows ago (n = 7, 30)."""
    x = F.col(col)
    out = {}
    for n in (7, 30):
        f = w.rowsBetween(-(2 * n - 1), -n)
        out[f"precip_{n}d_sum_lag1"] = full_window(F.sum(x).over(f), x, f, n)
    return out


def excl_today_cols(w: WindowSpec) -> dict[str, Column]:
    """``rolling(n, min_periods=1).sum().shift(1)`` for n = 3, 7 and
    yesterday's value, for rain and precipitation."""
    out = {}
    for c, nm in (("rain_sum", "rain"), ("precipitation_sum", "precip")):
        for n in (3, 7):
            out[f"{nm}_last_{n}d"] = F.sum(c).over(w.rowsBetween(-n, -1))
    for c, nm in (("rain_sum", "rain"), ("precipitation_sum", "precip")):
        out[f"{nm}_lag1"] = F.lag(c, 1).over(w)
    return out


def monthly_climatology_col(col: str = "precipitation_sum", key: str = KEY, time: str = TIME) -> Column:
    """The series' mean of ``col`` over all rows of the same calendar month.

    Twelve conditional means over the series, of which a row picks its month's:
    the series' own partition serves, which the other windows use as well."""
    series = Window.partitionBy(key)
    means = [F.avg(F.when(F.month(time) == m, F.col(col))).over(series) for m in range(1, 13)]
    return F.get(F.array(*means), F.month(time) - 1)


def climatology_anomaly_col(w: WindowSpec, col: str = "precipitation_sum",
                            key: str = KEY, time: str = TIME) -> Column:
    """Full 30-row sum minus the monthly mean of daily values (as the reference)."""
    x, f = F.col(col), trailing(w, 30)
    return full_window(F.sum(x).over(f), x, f, 30) - monthly_climatology_col(col, key, time)


def sequence_cols(w: WindowSpec, cols: Iterable[str], length: int = 7) -> dict[str, Column]:
    """The ``length`` rows before today (today excluded) as an array of structs."""
    seq = F.collect_list(F.struct(*cols)).over(w.rowsBetween(-length, -1))
    return {"sequence": seq}


def sequences(df: DataFrame, cols: Iterable[str], label: str, length: int = 7,
              key: str = KEY, time: str = TIME, strategy: str = "series") -> DataFrame:
    """Rows i >= L with the L previous rows as a sequence and y[i] as label.

    The collected frame is bounded by ``length``, never by the series."""
    cols = list(cols)
    out = series_frame(df, lambda w: sequence_cols(w, cols, length), key, time, back=length, strategy=strategy)
    return out.where(F.size("sequence") == length).select(key, time, "sequence", label)
