import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from dailyseries.operators import splits as spl
from dailyseries.plans.ranking import exact_quantiles, global_row_number, running_sum


def test_global_row_number_matches_window(spark):
    rng = np.random.default_rng(1)
    rows = [(int(k), int(t)) for k, t in zip(rng.integers(0, 50, 2000), rng.permutation(2000))]
    df = spark.createDataFrame(rows, "k long, t long")
    ranked, n = global_row_number(df, ["k", "t"])
    assert n == 2000
    ref = df.withColumn("ref", F.row_number().over(Window.orderBy("k", "t")))
    bad = ranked.join(ref, ["k", "t"]).where(F.col("rn") != F.col("ref")).count()
    assert bad == 0


@pytest.mark.parametrize("parts", [1, 64])
def test_global_row_number_many_partitions(spark, parts):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(int(v), i) for i, v in enumerate(rng.integers(0, 10_000, 3000))], "v long, i long")
    ranked, n = global_row_number(df, ["v", "i"], partitions=parts)
    assert n == 3000
    got = [r["rn"] for r in ranked.orderBy("v", "i").collect()]
    assert got == list(range(1, 3001))


def test_running_sum_and_quantiles(spark):
    rng = np.random.default_rng(2)
    vals = rng.integers(0, 40, 500).astype(float)
    g = rng.integers(0, 3, 500)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(g, vals)], "g int, v double")
    counts = df.groupBy("g", "v").agg(F.count(F.lit(1)).alias("c"))
    rs = {(r["g"], r["v"]): r["c_before"] for r in running_sum(counts, "v", ["c"], ["g"], buckets=4).collect()}
    for (gg, v), before in rs.items():
        assert before == int(((g == gg) & (vals < v)).sum())
    qs = [0.0, 0.1, 0.25, 0.5, 0.99, 1.0]
    got = {(r["g"], r["q"]): r["value"] for r in exact_quantiles(df, "v", qs, ["g"]).collect()}
    for gg in range(3):
        for q in qs:
            assert got[(gg, q)] == pytest.approx(np.percentile(vals[g == gg], q * 100), abs=1e-12)


def _series(spark, n):
    import datetime as dt
    return spark.createDataFrame([(i % 3, dt.date(2000, 1, 1) + dt.timedelta(days=i // 3), float(i)) for i in range(n)],
                                 "series_key long, time date, x double")


def test_chrono_split_sizes_use_python_int(spark):
    out = spl.chrono_split(_series(spark, 90))
    c = {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
    assert c == {"train": int(90 * 0.7), "val": int(90 * 0.15), "test": 90 - 62 - 13}
    # chronological: every train row precedes every val row
    mx = out.where("split = 'train'").agg(F.max(F.struct("time", "series_key"))).first()[0]
    mn = out.where("split = 'val'").agg(F.min(F.struct("time", "series_key"))).first()[0]
    assert tuple(mx) < tuple(mn)


def test_single_row_split(spark):
    out = spl.chrono_split(_series(spark, 1)).collect()
    assert [r["split"] for r in out] == ["test"]


def test_folds(spark):
    df = _series(spark, 100)
    kf = {r["fold"]: r["count"] for r in spl.kfold(df, 3).groupBy("fold").count().collect()}
    assert kf == {0: 34, 1: 33, 2: 33}
    ts = spl.time_series_folds(df, 5).where("fold IS NOT NULL")
    assert {r["fold"]: r["count"] for r in ts.groupBy("fold").count().collect()} == {i: 16 for i in range(5)}
    wf = spl.walk_forward_folds(df, 0.6, 0.1).where("fold IS NOT NULL")
    got = {r["fold"]: (r["count"], r["te"]) for r in wf.groupBy("fold").agg(F.count(F.lit(1)).alias("count"),
                                                                        F.min("train_end").alias("te")).collect()}
    assert got == {0: (10, 60), 1: (10, 70), 2: (10, 80), 3: (10, 90)}


def _sk_stratified(y, k):
    y = np.asarray(y)
    classes, enc = np.unique(y, return_inverse=True)
    y_order = np.sort(enc)
    alloc = np.asarray([np.bincount(y_order[i::k], minlength=len(classes)) for i in range(k)])
    folds = np.empty(len(y), dtype=int)
    for c in range(len(classes)):
        folds[enc == c] = np.arange(k).repeat(alloc[:, c])
    return folds


def test_stratified_matches_reference_rule(spark):
    rng = np.random.default_rng(4)
    y = (rng.random(103) < 0.3).astype(int)
    df = spark.createDataFrame([(i, int(v)) for i, v in enumerate(y)], "player_id long, y int")
    got = {r["player_id"]: r["fold"] for r in spl.stratified_folds(df, "y", 5).collect()}
    want = _sk_stratified(y, 5)
    assert [got[i] for i in range(len(y))] == want.tolist()


def test_train_from_selects_expanding_windows(spark):
    df = _series(spark, 100)
    wf = spl.walk_forward_folds(df, 0.6, 0.1)
    for k, start in enumerate((60, 70, 80, 90)):
        assert wf.where(F.col("train_from") <= k).count() == start
    assert wf.where(F.col("train_from").isNull()).count() == 0  # 60 + 4 * 10 = 100 rows all used
    ts = spl.time_series_folds(_series(spark, 101), 5)  # 101 // 6 = 16; tests start at 21
    assert [ts.where(F.col("train_from") <= k).count() for k in range(5)] == [21, 37, 53, 69, 85]


@pytest.mark.parametrize("rows", [[(1, 5), (2, 5), (1, 5)], [(1, 5), (None, 6)], [(1, None), (2, 3)]])
def test_splits_reject_ties_and_nulls(spark, rows):
    df = spark.createDataFrame(rows, "k long, t long")
    with pytest.raises(ValueError, match="unique and not null"):
        spl.chrono_split(df, order_cols=("t", "k"))
    with pytest.raises(ValueError, match="unique and not null"):
        spl.kfold(df, 2, order_cols=("t", "k"))


def test_splits_of_an_empty_table(spark):
    df = spark.createDataFrame([], "k long, t long")
    assert spl.chrono_split(df, order_cols=("t", "k")).collect() == []


def test_folds_have_no_cap(spark):
    df = spark.createDataFrame([(0, i) for i in range(3000)], "k long, t long")
    got = {r["t"]: r["fold"] for r in spl.kfold(df, 1500, order_cols=("t", "k")).collect()}
    assert got == {i: i // 2 for i in range(3000)}


def test_null_groups_are_groups(spark):
    rows = [(None, float(v)) for v in range(11)] + [(1, float(v)) for v in range(0, 22, 2)]
    df = spark.createDataFrame(rows, "g long, v double")
    got = {(r["g"], r["q"]): r["value"] for r in exact_quantiles(df, "v", [0.5, 1.0], ["g"]).collect()}
    assert got == {(None, 0.5): 5.0, (None, 1.0): 10.0, (1, 0.5): 10.0, (1, 1.0): 20.0}
