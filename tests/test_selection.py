"""Order statistics by counting, and column fits without a row per cell."""

import datetime
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from dailyseries.operators import prepare as prep
from dailyseries.operators import splits as spl
from dailyseries.plans import selection as sel


def plan_of(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("bins", [2, 7, 4096])
def test_rows_at_positions(spark, monkeypatch, bins):
    monkeypatch.setattr(sel, "BINS", bins)
    r = random.Random(bins)
    day = datetime.date(1969, 12, 20)
    keys = {(day + datetime.timedelta(days=r.randrange(40)), r.choice([-(1 << 40), -5, 0, 3, 9, 1 << 61])) for _ in range(150)}
    rows = sorted(keys)
    df = spark.createDataFrame([(d, k, i % 2 == 0) for i, (d, k) in enumerate(r.sample(rows, len(rows)))], "d date, k long, b boolean")
    order = sel.Selection(df, ["d", "k"])
    assert order.n == len(rows)
    want = [0, 1, len(rows) // 3, len(rows) // 2, len(rows) - 2, len(rows) - 1, len(rows), -1]
    got = order.rows(want)
    epoch = datetime.date(1970, 1, 1)
    assert got == {p: ((rows[p][0] - epoch).days, rows[p][1]) for p in want if 0 <= p < len(rows)}
    value = spark.range(1).select(*order.values(got[0])).first()
    assert tuple(value) == rows[0]
    order.close()


def test_ties_nulls_and_empty_tables(spark):
    schema = "d date, k int"
    day = datetime.date(2020, 1, 1)
    for bad in ([(day, 1), (day, 1)], [(day, 1), (None, 2)], [(day, None)]):
        with pytest.raises(ValueError, match="unique and not null"):
            sel.Selection(spark.createDataFrame(bad, schema), ["d", "k"])
    empty = sel.Selection(spark.createDataFrame([], schema), ["d", "k"])
    assert empty.n == 0 and empty.rows([0, 1]) == {}


def test_splits_of_text_and_real_keys_are_ranked_as_before(spark):
    rows = [(f"k{i:03d}", i / 7) for i in range(50)]
    df = spark.createDataFrame(rows, "s string, x double")
    for c in ("s", "x"):
        got = spl.chrono_split(df, order_cols=(c,)).groupBy("split").count().collect()
        assert {r.split: r["count"] for r in got} == {"train": 35, "val": 7, "test": 8}


def test_cuts_sort_no_rows(spark):
    """No range exchange, no sort: the split's plan and its passes only count."""
    df = spark.range(5000).select(F.expr("date_add(date'2020-01-01', cast(id % 900 as int))").alias("time"),
                                  F.col("id").alias("series_key"))
    out = spl.chrono_split(df)
    assert "rangepartitioning" not in plan_of(out).lower()
    order = sel.Selection(df, ["time", "series_key"])
    assert "rangepartitioning" not in plan_of(order.keys).lower() and "Sort [" not in plan_of(order.keys)
    assert order.rows([2500])


@pytest.mark.parametrize("few", [3, 1000])
def test_column_quantiles_equal_numpy(spark, monkeypatch, few):
    monkeypatch.setattr(sel, "FEW", few)
    monkeypatch.setattr(sel, "ACCURACY", 50 if few == 3 else 10_000)
    r = random.Random(few)
    n = 2001
    cols = {"normal": [r.gauss(0, 1) for _ in range(n)], "zeros": [0.0 if r.random() < 0.8 else r.random() for _ in range(n)],
            "two": [float(i % 2) for i in range(n)], "holes": [None if r.random() < 0.5 else r.expovariate(1) for _ in range(n)],
            "one": [7.0] * n, "single": [3.5] + [None] * (n - 1), "none": [None] * n, "whole": [float(r.randrange(30)) for _ in range(n)]}
    df = spark.createDataFrame(list(zip(*cols.values(), strict=True)), ", ".join(f"{c} double" for c in cols)).repartition(5)
    for q in (0.5, 0.0, 0.9, 1.0):
        got = sel.column_quantiles(df, list(cols), q)
        for c, values in cols.items():
            held = [v for v in values if v is not None]
            assert got[c] == (pytest.approx(np.quantile(held, q), abs=1e-12) if held else None), (c, q)


def test_column_stats_equal_plain_aggregates(spark):
    r = random.Random(4)
    n = 3000
    cols = {"pressure": [None if r.random() < 0.1 else 1e6 + r.gauss(0, 0.5) for _ in range(n)], "rain": [max(0.0, r.gauss(-1, 1)) for _ in range(n)],
            "late": [None] * 500 + [5.0] * (n - 500), "none": [None] * n, "negative": [-abs(r.gauss(3, 1)) for _ in range(n)],
            "whole": [r.randrange(9) for _ in range(n)]}
    kinds = {c: "long" if c == "whole" else "double" for c in cols}
    df = spark.createDataFrame(list(zip(*cols.values(), strict=True)), ", ".join(f"{c} {kinds[c]}" for c in cols)).coalesce(1).repartition(4)
    got = prep.column_stats(df, list(cols), ["rows", "count", "mean", "var_pop", "min", "max"])
    for c, values in cols.items():
        held = np.array([v for v in values if v is not None], float)
        assert (got[c]["rows"], got[c]["count"]) == (n, len(held))
        if not len(held):
            assert [got[c][s] for s in ("mean", "var_pop", "min", "max")] == [None] * 4
            continue
        assert got[c]["mean"] == pytest.approx(held.mean(), rel=1e-13)
        assert got[c]["var_pop"] == pytest.approx(held.var(), rel=1e-8, abs=1e-15)
        assert (got[c]["min"], got[c]["max"]) == (held.min(), held.max())
    alone = prep.column_stats(df, list(cols), ["mean", "var_pop"])
    assert got["late"]["var_pop"] == alone["late"]["var_pop"] == 0.0  # a constant column stays one, nulls and all
    assert all(alone[c]["mean"] == got[c]["mean"] and alone[c]["var_pop"] == got[c]["var_pop"] for c in cols)
    empty = prep.column_stats(df.where("rain < 0"), ["rain"], ["count", "mean"])
    assert empty == {"rain": {"count": 0, "mean": None}}


def test_fits_make_no_row_per_cell(spark, monkeypatch):
    """The passes of a fit neither unpivot nor expand."""
    seen = []
    plain = type(spark.range(1)).first
    monkeypatch.setattr(type(spark.range(1)), "first", lambda self: (seen.append(plan_of(self)), plain(self))[1])
    df = spark.range(100).select(*[(F.col("id") * i).cast("double").alias(f"c{i}") for i in range(5)])
    prep.fit_impute_scale(df, [f"c{i}" for i in range(5)], split_col=None)
    prep.fit_impute(df, [f"c{i}" for i in range(5)], "median", None)
    assert seen and not any("Expand" in p or "Generate" in p for p in seen)
