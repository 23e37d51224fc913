"""The feature pipeline keeps the narrow daily rows only, and shuffles them once."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from dailyseries.plans import fixtures as fx
from dailyseries.plans.pipeline import feature_pipeline


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Lines of 40 suppliers; some share a supplier and day."""
    top = tmp_path_factory.mktemp("lines")
    begin = dt.datetime(1996, 1, 1, 5)
    lines = [(i % 997, i % 40, 1 + i % 7, float(1 + i * 7 % 50), (i * 3 % 11) / 100, (i * 5 % 9) / 100, begin + dt.timedelta(days=i // 50))
             for i in range(9000)]
    schema = "l_orderkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, l_tax double, l_shipdate timestamp_ntz"
    spark.createDataFrame(lines, schema).write.parquet(f"{top}/lineitem.parquet")
    return str(top)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("task, leak_safe", [("regression", True), ("classification", False)])
def test_only_the_daily_rows_are_kept_and_shuffled_once(spark, folder, task, leak_safe):
    dw = fx.daily_weather(spark, folder, n_series=None, nulls=True)
    handles = []
    out, feats, target = feature_pipeline(dw, task=task, leak_safe=leak_safe, persisted=handles)
    assert [sorted(h.columns) for h in handles] == [sorted(dw.columns)]
    plan = plan_of(out)
    assert "Exchange" not in plan.split("InMemoryRelation")[0]  # windows and rolling statistics use the kept order
    assert plan_of(handles[0]).split("Initial Plan")[-1].count("Exchange hashpartitioning") <= 1
    got = sorted(map(tuple, out.select("series_key", "time", "split", target, *feats).collect()))
    handles[0].unpersist()
    whole = feature_pipeline(fx.daily_weather(spark, folder, n_series=None, nulls=True), task=task, leak_safe=leak_safe, persist=False)[0]
    want = sorted(map(tuple, whole.select("series_key", "time", "split", target, *feats).collect()))
    assert len(got) == len(want) > 0
    for a, b in zip(got, want, strict=True):
        assert a[:3] == b[:3] and a[3:] == pytest.approx(b[3:], abs=1e-9)


def test_lines_of_many_series_are_shuffled_once(spark, folder):
    dw = fx.daily_weather(spark, folder, n_series=None, nulls=True)
    plan = plan_of(dw.repartition("series_key").sortWithinPartitions("series_key", "time"))
    assert plan.count("Exchange") == 1
    few = fx.daily_weather(spark, folder, n_series=40, nulls=True)  # the same series, summed before the shuffle
    assert dw.exceptAll(few).isEmpty() and few.exceptAll(dw).isEmpty()
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    days = lines.select("l_suppkey", F.col("l_shipdate").cast("date")).distinct().count()
    assert dw.count() == days < lines.count()
