"""DuckDB-side SQL texts for the oracle check (same derived inputs as
``dailyseries.plans.fixtures``) and small helpers to write them."""

from __future__ import annotations

from collections.abc import Iterable


def r(expr: str) -> str:
    """Round a computed double exactly as ``functions.scalar.round6`` does."""
    e = f"CAST({expr} AS DOUBLE)"
    return f"(CASE WHEN abs({e}) < 1e12 THEN floor({e} * 1e6 + 0.500001) / 1e6 ELSE {e} END)"


def daily_weather_sql(n_series: int | None = 10, nulls: bool = False) -> str:
    key = f"l_suppkey % {n_series}" if n_series else "l_suppkey"

    def n13(c: str) -> str:
        return f"CASE WHEN day(time) = 13 THEN NULL ELSE {c} END" if nulls else c

    return f"""
SELECT series_key, time,
  CASE _maxline WHEN 1 THEN 0 WHEN 2 THEN 1 WHEN 3 THEN 2 WHEN 4 THEN 3
                WHEN 5 THEN 51 WHEN 6 THEN 61 ELSE 63 END AS weather_code,
  {r('temperature_2m_max')} AS temperature_2m_max,
  {r(n13('temperature_2m_min'))} AS temperature_2m_min,
  {r('apparent_temperature_max')} AS apparent_temperature_max,
  {r('apparent_temperature_min')} AS apparent_temperature_min,
  {r(n13('precipitation_sum'))} AS precipitation_sum,
  {r(n13('rain_sum'))} AS rain_sum,
  CAST(0 AS DOUBLE) AS snowfall_sum,
  {r('precipitation_hours')} AS precipitation_hours,
  {r('wind_speed_10m_max')} AS wind_speed_10m_max,
  {r('wind_gusts_10m_max')} AS wind_gusts_10m_max,
  {r('wind_direction_10m_dominant')} AS wind_direction_10m_dominant,
  {r('shortwave_radiation_sum')} AS shortwave_radiation_sum,
  {r('et0_fao_evapotranspiration')} AS et0_fao_evapotranspiration,
  {r('sunshine_duration')} AS sunshine_duration,
  CAST(36000 + 600 * month(time) AS DOUBLE) AS daylight_duration
FROM (
  SELECT {key} AS series_key, CAST(l_shipdate AS DATE) AS time,
    CAST(max(l_linenumber) AS INTEGER) AS _maxline,
    max(l_quantity) AS temperature_2m_max, min(l_quantity) AS temperature_2m_min,
    max(l_quantity * (1 + l_tax)) AS apparent_temperature_max,
    min(l_quantity * (1 - l_discount)) AS apparent_temperature_min,
    sum(CASE WHEN l_discount >= 0.09 THEN l_quantity ELSE 0 END) AS precipitation_sum,
    sum(CASE WHEN l_discount >= 0.10 THEN l_quantity ELSE 0 END) AS rain_sum,
    CAST(count(*) AS DOUBLE) AS precipitation_hours,
    max(l_discount * 100) AS wind_speed_10m_max,
    max((l_discount + l_tax) * 100) AS wind_gusts_10m_max,
    CAST(max(l_orderkey % 360) AS DOUBLE) AS wind_direction_10m_dominant,
    sum(l_quantity) / 10.0 AS shortwave_radiation_sum,
    max(l_tax) * 50 AS et0_fao_evapotranspiration,
    sum(l_tax) * 1000 AS sunshine_duration
  FROM lineitem GROUP BY 1, 2) g"""


SCORED_SQL = """
SELECT o_orderkey AS player_id, CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS INTEGER) AS y,
  CAST(least(1.0, floor(o_totalprice / 500) / 1000.0) AS DOUBLE) AS p FROM orders"""

PLAYERS_RAW_SQL = """
SELECT p_partkey AS player_id, CAST(1990 + p_size AS INTEGER) AS year, p_retailprice, p_brand,
  CASE WHEN p_partkey % 2 = 0
       THEN concat(CAST(4 + p_size % 4 AS VARCHAR), '''', CAST(p_partkey % 14 AS VARCHAR), '''''')
       ELSE concat(CAST(p_partkey % 14 AS VARCHAR), '-',
            CASE p_size % 5 WHEN 0 THEN 'Jun' WHEN 1 THEN 'May' WHEN 2 THEN 'Sept'
                            WHEN 3 THEN 'Junk' ELSE 'Foo' END) END AS ht,
  CAST(CASE WHEN p_size % 7 = 0 THEN NULL WHEN p_size % 3 = 0 THEN 1 ELSE 0 END AS INTEGER) AS drafted
FROM part"""

ORDERS_DAILY_SQL = """
SELECT CAST(o_orderdate AS DATE) AS time, sum(o_totalprice) / 1000.0 AS value,
  count(*) AS n_orders, CAST(0 AS BIGINT) AS series_key FROM orders GROUP BY 1"""

HEIGHT_SQL = """CASE
  WHEN regexp_matches(trim(ht), '^\\s*(\\d+)''\\s*(\\d{1,2})''''\\s*$') THEN
    CASE WHEN TRY_CAST(regexp_extract(trim(ht), '^\\s*(\\d+)''\\s*(\\d{1,2})''''\\s*$', 2) AS DOUBLE) <= 11
         THEN TRY_CAST(regexp_extract(trim(ht), '^\\s*(\\d+)''\\s*(\\d{1,2})''''\\s*$', 1) AS DOUBLE) * 30.48
            + TRY_CAST(regexp_extract(trim(ht), '^\\s*(\\d+)''\\s*(\\d{1,2})''''\\s*$', 2) AS DOUBLE) * 2.54 END
  WHEN regexp_matches(trim(ht), '^\\s*(\\d{1,2})\\s*[-/\\s]\\s*([A-Za-z]{3,9})\\s*$') THEN
    CASE WHEN list_position(['jan','feb','mar','apr','may','jun','jul','aug','sep','oct','nov','dec'],
                 lower(substr(regexp_extract(trim(ht), '^\\s*(\\d{1,2})\\s*[-/\\s]\\s*([A-Za-z]{3,9})\\s*$', 2), 1, 3))) IS NOT NULL
          AND TRY_CAST(regexp_extract(trim(ht), '^\\s*(\\d{1,2})\\s*[-/\\s]\\s*([A-Za-z]{3,9})\\s*$', 1) AS DOUBLE) <= 11
         THEN list_position(['jan','feb','mar','apr','may','jun','jul','aug','sep','oct','nov','dec'],
                 lower(substr(regexp_extract(trim(ht), '^\\s*(\\d{1,2})\\s*[-/\\s]\\s*([A-Za-z]{3,9})\\s*$', 2), 1, 3))) * 30.48
            + TRY_CAST(regexp_extract(trim(ht), '^\\s*(\\d{1,2})\\s*[-/\\s]\\s*([A-Za-z]{3,9})\\s*$', 1) AS DOUBLE) * 2.54 END
END"""


def with_ctes(body: str, **ctes: str) -> str:
    parts = ",\n".join(f"{name} AS ({sql})" for name, sql in ctes.items())
    return f"WITH {parts}\n{body}"


def select_list(items: Iterable[tuple[str, str]]) -> str:
    return ",\n  ".join(f"{expr} AS {name}" for name, expr in items)
