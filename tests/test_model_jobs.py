"""The model queries ask for the reference's whole job."""

from unittest.mock import MagicMock

import pytest

from dailyseries.operators import models as md
from dailyseries.plans import q_models as qm


class Asked(Exception):
    pass


def asked(monkeypatch, query, name):
    """The arguments of ``query``'s call of ``models.name``; nothing is fitted."""
    def stop(*args, **kw):
        raise Asked(args, kw)

    monkeypatch.setattr(qm, "feature_pipeline", lambda *a, **k: (MagicMock(), ["a"], "y"))
    monkeypatch.setattr(qm.fx, "daily_weather", lambda *a, **k: None)
    for f in ("stratified_folds", "kfold", "walk_forward_folds", "time_series_folds"):
        monkeypatch.setattr(qm.spl, f, lambda *a, **k: a)
    monkeypatch.setattr(md, name, stop)
    with pytest.raises(Asked) as e:
        query(None, None)
    return e.value.args


def test_model_queries_ask_for_the_whole_job(spark, monkeypatch):
    for q in (qm.q_train_gbt_scores, qm.q_feature_importance, qm.q_feature_importance_splits):
        kw = asked(monkeypatch, q, "train_gbt")[1]
        assert (kw["max_iter"], kw["patience"], kw["params"]["n_estimators"]) == (300, 30, 300)
    args, _ = asked(monkeypatch, qm.q_random_search_regression, "random_search_regression")
    assert len(md._distinct([{"max_depth": 3}, {"max_depth": 3, "gamma": 1}])[0]) == 1
    assert asked(monkeypatch, qm.q_random_search_regression, "random_search_regression")[1]["n_iter"] == 30
    assert min(args[4]["n_estimators"]) == 200 and max(args[4]["n_estimators"]) == 900
    asked_for, kw = asked(monkeypatch, qm.q_random_search_classification, "fit_many")
    draws = asked_for[3]
    assert kw["weighted"] is False  # as the reference
    assert len(draws) == 20 and {d["n_estimators"] for d in draws} <= {200, 500, 800}
    assert asked(monkeypatch, qm.q_train_rf_scores, "train_random_forest")[1]["num_trees"] == 300
    for q in (qm.q_ensemble_scores, qm.q_model_comparison):
        assert sorted(asked(monkeypatch, q, "fit_members")[0][2]) == ["gb", "lgb", "rf", "xgb"]
    assert asked(monkeypatch, qm.q_walk_forward_gbt, "fold_fit_score")[0][3].getMaxIter() == 500
    assert len(asked(monkeypatch, qm.q_time_series_cv, "fold_fit_score")[0][3]) == 4
    args, _ = asked(monkeypatch, qm.q_grid_search_table, "grid_search")
    assert args[0][2] == 5 and len(md.grid_from(args[4])) == 5184
    monkeypatch.setattr(md, "grid_search", lambda *a, **k: ("table", [], None))
    args, kw = asked(monkeypatch, qm.q_topk_refit, "topk_refit")
    assert (args[3], args[4], kw["max_iter"], kw["patience"]) == ("table", 10, 300, 30)


def test_grid_search_is_weighted_and_equal_sets_are_fitted_once(spark):
    df = spark.createDataFrame([(float(i % 7), float(i), int(i % 3 == 0), i % 2, "train") for i in range(60)],
                               "a double, b double, y int, fold int, split string")
    grid = {"max_depth": [1, 2], "bagging_freq": [3, 5]}
    table, ranked, best = md.grid_search(df, ["a", "b"], "y", "fold", grid, base={"n_estimators": 2})
    assert table.count() == 4 and best.stages[-1].getOrDefault("weightCol") == "_w"
    fits = md.fit_many(df, ["a", "b"], "y", md.grid_from(grid), max_iter=2, patience=0)
    assert fits[0] is fits[1] and fits[2] is fits[3] and fits[0] is not fits[2]
    members = {"one": md.GBTClassifier(labelCol="y", maxIter=2), "two": md.RandomForestClassifier(labelCol="y", numTrees=2)}
    assert list(md.fit_members(df, ["a", "b"], members)) == ["one", "two"]
    folds = df.withColumn("train_from", 1 - df["fold"])
    votes = md.fold_fit_score(folds, ["a", "b"], "y", list(members.values()))
    assert votes.where("p between 0 and 1").count() == 60


def test_boosting_state_is_checkpointed_often_and_the_model_is_the_same(spark):
    df = md._assembler(["a"]).transform(spark.createDataFrame([(float(i % 7), float(i)) for i in range(60)], "a double, y double"))
    est = md.GBTRegressor(labelCol="y", maxIter=5, seed=1)
    short = md.short_lineage(est)
    assert short.getCheckpointInterval() == md.CHECKPOINT_ROUNDS < est.getCheckpointInterval()
    assert md.short_lineage(est.copy({est.checkpointInterval: 7})).getCheckpointInterval() == 7
    assert short.fit(df).toDebugString.split("\n")[1:] == est.fit(df).toDebugString.split("\n")[1:]
