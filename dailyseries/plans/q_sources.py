"""Registered queries: scans and sinks (S1-S8), each a write + read round
trip through the shared checkpoint folder on data derived from the tables."""

from __future__ import annotations

from dailyseries.operators import metrics as mt
from dailyseries.operators import scoring as sc
from dailyseries.operators import splits as spl
from dailyseries.plans import fixtures as fx
from dailyseries.plans import oracle as o
from dailyseries.plans.q_pipeline import _split_sql
from dailyseries.plans.registry import ORACLE, query
from dailyseries.session import scratch_path
from dailyseries.sources import files as io

R = o.r
DW = o.daily_weather_sql(nulls=True)


@query("scan_csv_folder", o.with_ctes(
    f"SELECT player_id, CAST(year AS BIGINT) AS year, p_retailprice, p_brand, {R(o.HEIGHT_SQL)} AS ht, "
    "CAST(drafted AS BIGINT) AS drafted FROM players", players=o.PLAYERS_RAW_SQL))
def q_scan_csv_folder(spark, sf):
    """Players and scores written as CSV datasets (one with an upper-case
    suffix), the folder scanned back; heights converted on ingest."""
    folder = scratch_path(spark, "raw")
    fx.players_raw(spark, sf).write.option("header", True).csv(f"{folder}/players.CSV")
    fx.scored(spark, sf).write.option("header", True).csv(f"{folder}/scored.csv")
    ds = io.scan_csv_folder(spark, folder)
    assert set(ds) == {"players", "scored"}, sorted(ds)
    return ds["players"]


@query("scan_splits", o.with_ctes(
    "SELECT player_id, p_retailprice, CAST(CASE WHEN split = 'test' THEN NULL ELSE drafted END AS BIGINT) AS drafted, "
    "split FROM ("
    + _split_sql("players", "year, player_id") + ") s", players=o.PLAYERS_RAW_SQL))
def q_scan_splits(spark, sf):
    """X_{split}.csv and y_{split}.csv (no y_test, as the reference)
    written with the row key, read back as one table."""
    p = spl.chrono_split(fx.players_raw(spark, sf), order_cols=("year", "player_id"))
    folder = scratch_path(spark, "splits")
    io.write_reference_splits(p.select("player_id", "p_retailprice", "drafted", "split"), folder, "drafted")
    return io.scan_splits(spark, folder).select("player_id", "p_retailprice", "drafted", "split")


@query("ingest_daily_payload", o.with_ctes("SELECT * FROM daily_weather", daily_weather=DW))
def q_ingest_daily_payload(spark, sf):
    """S3: daily rows -> payload documents of parallel arrays -> rows again."""
    dw = fx.daily_weather(spark, sf, nulls=True)
    path = scratch_path(spark, "payload")
    measures = io.write_daily_payload(dw, path)
    return io.ingest_daily_payload(spark, path, measures)


@query("scan_date_range", o.with_ctes(
    "SELECT * FROM daily_weather WHERE time BETWEEN DATE '1996-01-01' AND DATE '1997-06-30'", daily_weather=DW))
def q_scan_date_range(spark, sf):
    """Inclusive date range; the bound reaches the lineitem parquet scan."""
    dw = fx.daily_weather(spark, sf, nulls=True, start="1996-01-01", end="1997-06-30")
    return io.scan_date_range(dw, "1996-01-01", "1997-06-30")


@query("sink_splits", o.with_ctes(
    "SELECT series_key, time, precipitation_sum, split FROM (" + _split_sql("daily_weather") + ") s",
    daily_weather=DW))
def q_sink_splits(spark, sf):
    """The split table written partitioned by split and read back."""
    s = spl.chrono_split(fx.daily_weather(spark, sf, nulls=True)).select("series_key", "time", "precipitation_sum", "split")
    path = scratch_path(spark, "split-table")
    io.write_splits(s, path)
    return spark.read.parquet(path).select("series_key", "time", "precipitation_sum", "split")


@query("submission", o.with_ctes("SELECT player_id, p AS drafted FROM scored", scored=o.SCORED_SQL))
def q_submission(spark, sf):
    """Submission CSV (player_id, drafted = probability) written and read back."""
    path = scratch_path(spark, "submission")
    io.write_submission(sc.submission(fx.scored(spark, sf)), path)
    return io.read_submission(spark, path)


@query("predictions_roundtrip", o.with_ctes("SELECT player_id, p FROM scored", scored=o.SCORED_SQL))
def q_predictions_roundtrip(spark, sf):
    """Predictions saved and loaded."""
    path = scratch_path(spark, "predictions")
    io.save_predictions(fx.scored(spark, sf).select("player_id", "p"), path)
    return io.load_predictions(spark, path)


@query("report_json_roundtrip", ORACLE.get("evaluation_report"))
def q_report_json_roundtrip(spark, sf):
    """Evaluation report written as JSON and read back with its schema."""
    rep = mt.evaluation_report(sc.predict_labels(fx.scored(spark, sf)))
    from dailyseries.plans.registry import round_doubles
    rep = round_doubles(rep)
    path = scratch_path(spark, "report")
    io.save_report(rep, path)
    return io.load_report(spark, path, rep.schema)
