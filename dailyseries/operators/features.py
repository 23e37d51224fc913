"""Feature composition over daily series: calendar (F2-F3, P2), derived
weather measures and the advanced block (F4-F19), one-hot helpers and
projections (P1-P4)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from dailyseries.functions.scalar import au_season, cyclical, safe_ratio
from dailyseries.operators.windows import (
    KEY, TIME, rolling_weather_cols, series_frame, temp_anomaly_col, threshold_flag,
    weather_lag_cols,
)

# fixed values: notebook leakage columns for the classification task
LEAKAGE_COLUMNS = ("precipitation_sum", "rain_sum", "precipitation_hours")


def temporal_features(df: DataFrame, keep_columns: Iterable[str] | None = None,
                      time: str = TIME) -> DataFrame:
    """F2-F3 (+P2): year, month, southern season; optional keep list.

    With a keep list, only its columns plus year, month, season and time
    stay, in input order (the reference used set order); unknown names are
    ignored.
    """
    out = df.withColumns({
        "year": F.year(time),
        "month": F.month(time),
    }).withColumn("season", au_season("month"))
    if keep_columns is None:
        return out
    keep = set(keep_columns) | {"year", "month", "season", time}
    return out.select(*[c for c in out.columns if c in keep])


def derived_cols() -> dict[str, Column]:
    """F4-F15 before the window block is merged in (see advanced_cols)."""
    tmax, tmin = F.col("temperature_2m_max"), F.col("temperature_2m_min")
    wind, gust = F.col("wind_speed_10m_max"), F.col("wind_gusts_10m_max")
    rad, et0 = F.col("shortwave_radiation_sum"), F.col("et0_fao_evapotranspiration")
    temp_range = tmax - tmin
    msin, mcos = cyclical(F.col("month"), 12)
    dsin, dcos = cyclical(F.col("wind_direction_10m_dominant"), 360)
    return {
        "humidity_proxy": F.abs(F.col("apparent_temperature_max") - tmax),
        "storm_potential": wind * gust / 100,
        "atmospheric_instability": temp_range * wind,
        "month_sin": msin,
        "month_cos": mcos,
        "temp_season_interaction": tmax * msin,
        "wind_season_interaction": wind * mcos,
        "pressure_proxy": safe_ratio(rad, et0 + 1),
        "energy_balance": rad - et0,
        "wind_dir_sin": dsin,
        "wind_dir_cos": dcos,
        "weather_code_cloudy": threshold_flag(F.col("weather_code"), 2, ">="),
        "weather_code_rainy": threshold_flag(F.col("weather_code"), 61, ">="),
    }


def advanced_cols(w: WindowSpec) -> dict[str, Column]:
    """the 92 advanced columns in the reference's order, one window spec."""
    tmax, tmin = F.col("temperature_2m_max"), F.col("temperature_2m_min")
    out: dict[str, Column] = {
        "temp_range": tmax - tmin,
        "apparent_temp_range": F.col("apparent_temperature_max") - F.col("apparent_temperature_min"),
        "temp_anomaly": temp_anomaly_col(w),
    }
    out.update(rolling_weather_cols(w))
    out.update(derived_cols())
    out.update(weather_lag_cols(w))
    return out


def advanced_features(df: DataFrame, drop_leakage_first: bool = False, key: str = KEY,
                      time: str = TIME, strategy: str = "series") -> DataFrame:
    """``create_advanced_features``; needs ``month`` and the 10 measures."""
    if drop_leakage_first:
        df = drop_columns(df, LEAKAGE_COLUMNS)
    return series_frame(df, advanced_cols, key, time, back=29, strategy=strategy)


def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop, ignoring names that are absent."""
    return df.drop(*[c for c in columns if c in df.columns])


def select_features(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Strict projection; a missing name raises AnalysisException."""
    return df.select(*columns)


def prepare_features(df: DataFrame, split_col: str = "split", key: str = "player_id") -> DataFrame:
    """Drop the non-features ``player_id`` and ``year``; the test split
    keeps ``player_id`` as its row key (here: kept only on test rows)."""
    out = drop_columns(df, ["year"])
    if key in out.columns and split_col in out.columns:
        out = out.withColumn(key, F.when(F.col(split_col) == "test", F.col(key)))
    elif key in out.columns:
        out = out.drop(key)
    return out
