"""Input frames derived from the driver's tables (FIXTURES.md §B).

Each builder reads whole parquet tables and derives the frame with
DataFrame expressions, so its work grows with the tables.  The daily
weather frame is the measurement stream pre-aggregated to one row per
(series_key, day) -- a partial + final ``HashAggregate`` -- which bounds
every series to one row per calendar day before any window runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dailyseries.functions.scalar import round6
from dailyseries.sources.tables import read_table


def daily_weather(spark: SparkSession, sf_dir: str, n_series: int | None = 10,
                  nulls: bool = False, start: str | None = None, end: str | None = None) -> DataFrame:
    """B1: daily weather rows keyed by ``series_key`` (= l_suppkey % n_series).

    ``n_series=None`` keys by ``l_suppkey`` itself (many series).  With
    ``nulls=True`` the 13th day of each month has a null precipitation,
    rain and minimum temperature.  ``start``/``end`` (inclusive dates)
    restrict the scan: written on the raw timestamp, so the bound is a
    parquet ``PushedFilter``.

    Keyed by ``l_suppkey``, hardly two lines share a supplier and day, and a
    line is half as wide as the sums and extremes of a day: lines are
    shuffled, by series, and neither the daily sums nor later windows over a
    series shuffle again.
    """
    li = read_table(spark, sf_dir, "lineitem")
    if start:
        li = li.where(F.col("l_shipdate") >= F.lit(start).cast("timestamp_ntz"))
    if end:
        li = li.where(F.col("l_shipdate") < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp_ntz"))
    key = (F.col("l_suppkey") % n_series) if n_series else F.col("l_suppkey")
    q, d, t = F.col("l_quantity"), F.col("l_discount"), F.col("l_tax")
    if not n_series:
        li = li.select("l_suppkey", F.col("l_shipdate").cast("date").alias("l_shipdate"), "l_linenumber", q, d, t,
                       (F.col("l_orderkey") % 360).alias("l_orderkey")).repartition("l_suppkey")
    g = li.groupBy(key.alias("series_key"), F.col("l_shipdate").cast("date").alias("time")).agg(
        F.max("l_linenumber").cast("int").alias("_maxline"),
        F.max(q).alias("temperature_2m_max"),
        F.min(q).alias("temperature_2m_min"),
        F.max(q * (1 + t)).alias("apparent_temperature_max"),
        F.min(q * (1 - d)).alias("apparent_temperature_min"),
        F.sum(F.when(d >= 0.09, q).otherwise(F.lit(0.0))).alias("precipitation_sum"),
        F.sum(F.when(d >= 0.10, q).otherwise(F.lit(0.0))).alias("rain_sum"),
        F.count(F.lit(1)).cast("double").alias("precipitation_hours"),
        F.max(d * 100).alias("wind_speed_10m_max"),
        F.max((d + t) * 100).alias("wind_gusts_10m_max"),
        F.max(F.col("l_orderkey") % 360).cast("double").alias("wind_direction_10m_dominant"),
        (F.sum(q) / 10.0).alias("shortwave_radiation_sum"),
        (F.max(t) * 50).alias("et0_fao_evapotranspiration"),
        (F.sum(t) * 1000).alias("sunshine_duration"),
    )
    code = _weather_code(F.col("_maxline"))
    out = g.select(
        "series_key", "time", code.alias("weather_code"),
        "temperature_2m_max",
        _null13(F.col("temperature_2m_min"), nulls).alias("temperature_2m_min"),
        "apparent_temperature_max", "apparent_temperature_min",
        _null13(F.col("precipitation_sum"), nulls).alias("precipitation_sum"),
        _null13(F.col("rain_sum"), nulls).alias("rain_sum"),
        F.lit(0.0).alias("snowfall_sum"),
        "precipitation_hours", "wind_speed_10m_max", "wind_gusts_10m_max",
        "wind_direction_10m_dominant", "shortwave_radiation_sum",
        "et0_fao_evapotranspiration", "sunshine_duration",
        (F.lit(36000.0) + F.month("time") * 600).cast("double").alias("daylight_duration"),
    )
    # measures are rounded to 6 decimals at the source (like real station
    # data with finite decimals), so every engine sees identical inputs
    return out.select(*[round6(c).alias(c) if t == "double" else F.col(c)
                        for c, t in out.dtypes])


def _null13(c: Column, on: bool) -> Column:
    return F.when(F.dayofmonth("time") == 13, F.lit(None).cast("double")).otherwise(c) if on else c


def _weather_code(maxline: Column) -> Column:
    # fixed values: line number 1..6 -> WMO-like weather codes, else 63
    pairs = [(1, 0), (2, 1), (3, 2), (4, 3), (5, 51), (6, 61)]
    e = F.when(maxline == pairs[0][0], F.lit(pairs[0][1]))
    for k, v in pairs[1:]:
        e = e.when(maxline == k, F.lit(v))
    return e.otherwise(F.lit(63)).cast("int")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2: one scored row per order: player_id, y (0/1), p in [0,1] with ties."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("player_id"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).cast("int").alias("y"),
        F.least(F.lit(1.0), F.floor(F.col("o_totalprice") / 500) / 1000.0).cast("double").alias("p"),
    )


def players_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw player rows with text heights in both supported notations."""
    p = read_table(spark, sf_dir, "part")
    k, s = F.col("p_partkey"), F.col("p_size")
    feet_inches = F.concat((F.lit(4) + s % 4).cast("string"), F.lit("'"), (k % 14).cast("string"), F.lit("''"))
    mon = (F.when(s % 5 == 0, "Jun").when(s % 5 == 1, "May").when(s % 5 == 2, "Sept")
           .when(s % 5 == 3, "Junk").otherwise("Foo"))
    day_month = F.concat((k % 14).cast("string"), F.lit("-"), mon)
    return p.select(
        k.alias("player_id"),
        (F.lit(1990) + s).cast("int").alias("year"),
        "p_retailprice", "p_brand",
        F.when(k % 2 == 0, feet_inches).otherwise(day_month).alias("ht"),
        F.when(s % 7 == 0, F.lit(None)).when(s % 3 == 0, 1).otherwise(0).cast("int").alias("drafted"),
    )


def orders_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One long series -- order value per order date."""
    o = read_table(spark, sf_dir, "orders")
    return (o.groupBy(F.col("o_orderdate").cast("date").alias("time"))
            .agg((F.sum("o_totalprice") / 1000.0).alias("value"), F.count(F.lit(1)).alias("n_orders"))
            .withColumn("series_key", F.lit(0).cast("bigint")))


