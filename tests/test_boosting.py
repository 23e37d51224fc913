"""Boosted fits in one task: the trees of Spark's learner, and the cases that stay with it."""

import re

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from dailyseries.operators import boosting as bo
from dailyseries.operators import models as md

SAMPLED = {"subsamplingRate": 0.8, "featureSubsetStrategy": "0.6", "minInstancesPerNode": 25, "seed": 42}


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1200, 5))
    z = x[:, 0] + x[:, 1] * x[:, 2] + 0.3 * rng.normal(size=1200)
    data = [(*map(float, r), float(t), int(t > 0.3)) for r, t in zip(x, z)]
    return spark.createDataFrame(data, "a double, b double, c double, d double, e double, z double, y int").coalesce(1)


def tree_lines(model):
    """The model's trees as text, numbers to nine places."""
    return [re.sub(r"-?\d+\.\d+(E-?\d+)?", lambda m: f"{float(m[0]):.9g}", x) for x in model.toDebugString.split("\n")[1:]]


@pytest.mark.parametrize("kind, params", [
    (GBTClassifier, {"labelCol": "y", "maxIter": 4, "maxDepth": 3, **SAMPLED}),
    (GBTRegressor, {"labelCol": "z", "maxIter": 4, "maxDepth": 4, "stepSize": 0.05, **SAMPLED}),
    (GBTRegressor, {"labelCol": "z", "maxIter": 3, "maxDepth": 3, "seed": -5})])
def test_one_task_fits_the_trees_that_sparks_learner_fits(rows, kind, params):
    est = kind(**params)
    data = md._assembler("abcde").transform(rows).select("features", "y", "z")
    theirs, ours = est.fit(data), bo.fit_boosted(est, data)
    assert type(ours) is type(theirs) and tree_lines(ours) == tree_lines(theirs)
    assert ours.treeWeights == theirs.treeWeights and ours.extractParamMap().keys() == theirs.extractParamMap().keys()
    assert np.allclose(ours.featureImportances.toArray(), theirs.featureImportances.toArray())
    p, q = (sorted(r[0] for r in m.transform(data).select("prediction").collect()) for m in (theirs, ours))
    assert np.allclose(p, q, atol=1e-12)


def test_members_of_a_vote_are_fitted_without_a_job_per_level(rows, spark):
    df = rows.withColumn("split", F.when(F.col("a") < 0.5, "train").otherwise("val"))
    fits = {}
    for n in (2, 12):
        spark.sparkContext.setJobGroup(f"fit-{n}", "")
        est = GBTClassifier(labelCol="y", maxIter=n, maxDepth=4, **SAMPLED)
        fits[n] = md.fit_members(df, list("abcde"), {"gb": est}, parallelism=1)["gb"].stages[-1]
        assert fits[n].getNumTrees == n
    jobs = [len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"fit-{n}")) for n in (2, 12)]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1]  # one job for all rounds


def test_what_is_no_job_for_one_task_stays_with_sparks_learner(rows, monkeypatch):
    data = md._assembler("abcde").transform(rows).select("features", "y", "z", F.lit(2.0).alias("w"))
    for est in (RandomForestClassifier(labelCol="y"), GBTClassifier(labelCol="y", weightCol="w"),
                GBTRegressor(labelCol="z", lossType="absolute")):
        assert bo.fit_boosted(est, data) is None
    monkeypatch.setattr(bo, "CELLS", 1199 * 5)
    est = GBTRegressor(labelCol="z", maxIter=2, maxDepth=2, seed=1)
    assert bo.fit_boosted(est, data) is None
    assert tree_lines(md.fit_one(est, data)) == tree_lines(est.fit(data))


def test_wide_trees_and_little_memory_give_the_same_trees(rows):
    data = md._assembler("abcde").transform(rows).select("features", "z")
    est = GBTRegressor(labelCol="z", maxIter=1, maxDepth=9, minInstancesPerNode=4, seed=1)
    whole = bo.fit_boosted(est, data).transform(data).agg(F.sum(F.abs(F.col("prediction") - F.col("z")))).first()[0]
    by_spark = est.fit(data).transform(data).agg(F.sum(F.abs(F.col("prediction") - F.col("z")))).first()[0]
    assert whole == pytest.approx(by_spark, rel=1e-9)
    a, b, c = (bo.Rules([np.linspace(-2, 2, 31)] * 3, 1, 0.1, 9, 2, 0.0, 3, 1.0, m, 1, False) for m in (256 << 20, 1, 9000))
    x = np.random.default_rng(1).normal(size=(800, 3))
    codes = np.stack([np.searchsorted(a.thresholds[0], v) for v in x.T]).astype(np.uint8)
    trees = [bo.Tree(codes, x[:, 0] * x[:, 1], np.ones(800, bool), r, 1).predicted() for r in (a, b, c)]
    assert np.allclose(trees[0], trees[1]) and np.allclose(trees[0], trees[2])


def test_models_are_scored_together_as_one_by_one(rows):
    df = rows.withColumn("split", F.when(F.col("a") < 0.5, "train").otherwise("val"))
    members = {"gb": GBTClassifier(labelCol="y", maxIter=3, maxDepth=3, seed=1), "rf": RandomForestClassifier(labelCol="y", numTrees=3, seed=1)}
    fits = md.fit_members(df, list("abcde"), members) | md.fit_members(df, list("ab"), {"two": members["gb"]})
    got = {r["model_name"]: r for r in md.evaluate_models(df, fits, "y").collect()}
    for name, m in fits.items():
        one = md.score(m, df.where("split = 'val'"))
        assert got[name]["val_auc"] == pytest.approx(md.roc_auc(one, "y", "p").first()["auc_score"])
        assert got[name]["percent_zeros_on_val"] == pytest.approx(100 * one.where("p < 0.5").count() / one.count())


def test_folds_are_fitted_without_a_job_per_level(rows, spark):
    folds = rows.withColumn("fold", F.when(F.col("a") > 0, 1).otherwise(0)).withColumn("train_from", F.when(F.col("b") > 0, 1).otherwise(0))
    jobs, scored = [], {}
    for n in (2, 12):
        spark.sparkContext.setJobGroup(f"folds-{n}", "")
        est = GBTRegressor(labelCol="z", maxIter=n, maxDepth=4, **SAMPLED)
        scored[n] = md.fold_fit_score(folds, list("abcde"), "z", est, parallelism=1)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"folds-{n}")))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1]  # one job for all rounds of a fold
    data = md._assembler("abcde").transform(folds).select("features", "z", "fold", "train_from")
    theirs = est.fit(data.where("train_from <= 0")).transform(data.where("fold = 0"))
    want = theirs.agg(F.sum("prediction")).first()[0]
    assert scored[12].where("fold = 0").agg(F.sum("p")).first()[0] == pytest.approx(want)
