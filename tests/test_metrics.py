import numpy as np
import pytest
from pyspark.sql import functions as F

from dailyseries.operators import metrics as mt


def brute_auc(y, p):
    pos = [pi for yi, pi in zip(y, p) if yi == 1]
    neg = [pi for yi, pi in zip(y, p) if yi == 0]
    s = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    return s / (len(pos) * len(neg))


def brute_roc(y, p):
    """The ROC points rule: distinct thresholds descending, collinear points dropped, origin added."""
    y, p = np.asarray(y), np.asarray(p, dtype=float)
    order = np.argsort(-p, kind="mergesort")
    ys, ps = y[order], p[order]
    idx = np.r_[np.where(np.diff(ps))[0], len(ps) - 1]
    tps, fps = np.cumsum(ys)[idx], (idx + 1) - np.cumsum(ys)[idx]
    keep = np.where(np.r_[True, np.logical_or(np.diff(fps, 2), np.diff(tps, 2)), True])[0]
    fps, tps, thr = np.r_[0, fps[keep]], np.r_[0, tps[keep]], np.r_[np.inf, ps[idx][keep]]
    return sorted(zip(fps / fps[-1], tps / tps[-1], thr))


def brute_ap(y, p):
    y, p = np.asarray(y), np.asarray(p, dtype=float)
    P = y.sum()
    total = 0.0
    for t in np.unique(p):
        sel = p >= t
        tp = (y[sel] == 1).sum()
        prec = tp / sel.sum()
        total += (y[p == t] == 1).sum() / P * prec
    return total


def scored(spark, seed, n=300, levels=20):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, n).tolist()
    p = (np.round(rng.random(n) * levels) / levels).tolist()  # many ties
    return spark.createDataFrame(list(zip(range(n), y, p)), "player_id long, y int, p double"), y, p


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_auc_roc_ap_against_brute_force(spark, seed):
    df, y, p = scored(spark, seed)
    assert mt.roc_auc(df).first()["auc_score"] == pytest.approx(brute_auc(y, p), abs=1e-12)
    got = sorted((r["fpr"], r["tpr"], r["threshold"]) for r in mt.roc_curve(df).collect())
    want = brute_roc(y, p)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a == pytest.approx(b, abs=1e-12)
    assert mt.average_precision(df).first()["average_precision"] == pytest.approx(brute_ap(y, p), abs=1e-12)


def test_auc_invariant_under_monotone_transform(spark):
    df, y, p = scored(spark, 5)
    a = mt.roc_auc(df).first()["auc_score"]
    b = mt.roc_auc(df.withColumn("p", F.exp(F.col("p") * 3) - 7)).first()["auc_score"]
    assert a == pytest.approx(b, abs=1e-12)


def test_auc_by_group_in_one_job(spark):
    df, y, p = scored(spark, 9, n=400)
    g = df.withColumn("g", (F.col("player_id") % 3).cast("int"))
    got = {r["g"]: r["auc_score"] for r in mt.roc_auc(g, by=["g"]).collect()}
    for k in range(3):
        yy = [a for i, a in enumerate(y) if i % 3 == k]
        pp = [a for i, a in enumerate(p) if i % 3 == k]
        assert got[k] == pytest.approx(brute_auc(yy, pp), abs=1e-12)


def test_one_class_gives_null_auc(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.4)], "y int, p double")
    assert mt.roc_auc(df).first()["auc_score"] is None


def test_validate_predictions(spark):
    df = spark.createDataFrame([("ok", 0.0), ("ok", 1.0), ("nan", float("nan")), ("big", 1.5), ("inf", float("inf")),
                                ("neg", -0.1)], "g string, p double")
    got = {r["g"]: r["is_valid"] for r in mt.validate_predictions(df, by=["g"]).collect()}
    assert got == {"ok": True, "nan": False, "big": False, "inf": False, "neg": False}
    empty = spark.createDataFrame([], "p double")
    assert mt.validate_predictions(empty).first()["is_valid"] is True


def test_report_bands_and_percentiles(spark):
    df, y, p = scored(spark, 4, n=200)
    rows = mt.prediction_analysis(df).first()
    for q in mt.ANALYSIS_PERCENTILES:
        assert rows[f"percentile_{q}"] == pytest.approx(np.percentile(p, q), abs=1e-12)
    assert rows["std_probability"] == pytest.approx(np.std(p), abs=1e-12)
    assert rows["median_probability"] == pytest.approx(np.median(p), abs=1e-12)


def test_classification_report_and_regression_metrics(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0), (0, 1), (1, 1)], "y int, pred int")
    rep = {r["label"]: r for r in mt.classification_report(df).collect()}
    assert rep["1"]["precision"] == pytest.approx(2 / 3) and rep["1"]["recall"] == pytest.approx(2 / 3)
    assert rep["accuracy"]["f1_score"] == pytest.approx(4 / 6)
    const = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0)], "y double, yhat double")
    assert mt.regression_metrics(const, "y", "yhat").first()["r2"] == 1.0
