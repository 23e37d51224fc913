"""Scalar column functions (calendar, derived weather measures, height
parsing, null rules).  All are built-in Spark expressions: no Python UDF."""

from dailyseries.functions.height import height_to_cm
from dailyseries.functions.scalar import (
    au_season, cyclical, inf_to_null, log1p_columns, month_sin_cos, safe_ratio,
)

__all__ = ["au_season", "cyclical", "height_to_cm", "inf_to_null", "log1p_columns",
           "month_sin_cos", "safe_ratio"]
