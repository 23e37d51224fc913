"""Window features for a date range without computing the whole history.

A filter on ``time`` cannot be pushed below a window (it would change the
frames).  For a request on [start, end] with frames reaching ``back`` rows
back and ``fwd`` rows ahead, each series needs only the rows from the
``back``-th row before ``start`` to the ``fwd``-th row after ``end``.
Those per-series bounds come from a narrow (key, time) pass -- a per-series
top-k, planned as ``WindowGroupLimit`` so each task keeps k rows per key
before the shuffle -- and the wide frame is then cut to the halo before the
window runs.  Rows count, not days, so gaps in the dates are handled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from dailyseries.operators.windows import KEY, TIME, series_window
from dailyseries.plans.ranking import join_groups


def halo_bounds(df: DataFrame, start: str, end: str, back: int, fwd: int,
                key: str = KEY, time: str = TIME) -> DataFrame:
    """Per series: first and last date needed for exact windows on [start, end]."""
    s, e = F.lit(start).cast("date"), F.lit(end).cast("date")
    narrow = df.select(key, time)
    lo = (narrow.where(F.col(time) < s)
          .withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(F.col(time).desc())))
          .where(F.col("_r") <= back).groupBy(key).agg(F.min(time).alias("_lo")))
    hi = (narrow.where(F.col(time) > e)
          .withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(F.col(time).asc())))
          .where(F.col("_r") <= fwd).groupBy(key).agg(F.max(time).alias("_hi")))
    both = lo.unionByName(hi, allowMissingColumns=True)
    return both.groupBy(key).agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))


def window_for_range(df: DataFrame, builder: Callable[[WindowSpec], dict[str, Column]], start: str, end: str,
                     back: int, fwd: int = 0, key: str = KEY, time: str = TIME) -> DataFrame:
    """Rows of [start, end] with ``builder``'s window columns, exactly as on the full history."""
    s, e = F.lit(start).cast("date"), F.lit(end).cast("date")
    bounds = halo_bounds(df, start, end, back, fwd, key, time)  # one row per series
    first, last = bounds.agg(F.min("_lo"), F.max("_hi")).first()
    # the outermost dates are literals, so they reach the scan below
    df = df.where((F.col(time) >= (F.lit(first) if first else s)) & (F.col(time) <= (F.lit(last) if last else e)))
    j = join_groups(df, bounds, [key], "left")
    lo = F.coalesce(F.col("_lo"), s)
    hi = F.coalesce(F.col("_hi"), e)
    cut = j.where((F.col(time) >= lo) & (F.col(time) <= hi)).drop("_lo", "_hi")
    out = cut.withColumns(builder(series_window(key, time)))
    return out.where((F.col(time) >= s) & (F.col(time) <= e))
