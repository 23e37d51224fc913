"""Saved preparation, staged early stopping, split counts and the trial ledger."""

import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from conftest import SF0001
from dailyseries.operators import models as md
from dailyseries.operators import prepare as prep
from dailyseries.operators import preprocess as pre
from dailyseries.operators import trials
from dailyseries.operators.metrics import roc_auc
from dailyseries.plans import fixtures as fx
from dailyseries.session import scratch_path


def points(spark, n=400, seed=1):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        a, b = r.gauss(0, 1), r.gauss(0, 1)
        y = int(a + 0.5 * b + r.gauss(0, 1) > 0)
        rows.append((i, a, b, r.randrange(5), y, i % 3, "train" if i % 10 < 6 else "val" if i % 10 < 8 else "test"))
    return spark.createDataFrame(rows, "i int, a double, b double, c int, y int, fold int, split string")


FEATURES = ["a", "b", "c"]


# ---------------------------------------------------------------- staged stopping
def test_staged_margins_are_those_of_the_first_trees(spark):
    df = points(spark)
    vectors = md.weighted_vectors(df, FEATURES, "y").withColumn("n", F.monotonically_increasing_id()).cache()
    model = GBTClassifier(labelCol="y", weightCol="_w", maxIter=12, maxDepth=3, seed=1).fit(vectors.where("split = 'train'"))
    val = vectors.where("split = 'val'")
    staged = {(r["round"], r["n"]): r["margin"] for r in md.staged_margins(model, val, ["n"]).collect()}
    for rounds in (1, 5, 12):
        cut = md.truncated(model, rounds)
        assert cut.getNumTrees == rounds and cut.getFeaturesCol() == "features" and cut.getLabelCol() == "y"
        for r in cut.transform(val).select("n", "rawPrediction", "probability").collect():
            assert 2 * staged[rounds, r["n"]] == pytest.approx(2 * r["rawPrediction"][1], abs=1e-12)
    again = scratch_path(spark, "cut")
    md.truncated(model, 5).write().save(again)
    from pyspark.ml.classification import GBTClassificationModel
    assert GBTClassificationModel.load(again).getNumTrees == 5


def test_rounds_kept_equal_a_loop_over_prefixes(spark):
    df = points(spark, 600, 3)
    for patience in (2, 5, 30):
        model, rounds = md.train_gbt(df, FEATURES, "y", params={"max_depth": 4, "learning_rate": 0.4}, max_iter=25,
                                     patience=patience)
        full, _ = md.train_gbt(df, FEATURES, "y", params={"max_depth": 4, "learning_rate": 0.4}, max_iter=25, patience=0)
        best, at = -1.0, 0
        for k in range(1, 26):  # every prefix scored on its own
            cut = PipelineModel(stages=[full.stages[0], md.truncated(full.stages[1], k)])
            auc = roc_auc(md.score(cut, df.where("split = 'val'")), "y", "p").first()["auc_score"]
            if auc > best + 1e-12:
                best, at = auc, k
            elif k - at >= patience:
                break
        assert rounds == at == model.stages[-1].getNumTrees
        mine = roc_auc(md.score(model, df.where("split = 'val'")), "y", "p").first()["auc_score"]
        assert mine == pytest.approx(best)


def test_best_round_of_ties_and_missing_scores():
    assert md.best_round([0.5, 0.6, 0.6, 0.59, 0.7], 2) == 2
    assert md.best_round([0.5, 0.6, 0.6, 0.59, 0.7], 3) == 5
    assert md.best_round([None, None], 1) == 2  # one class only: all rounds stay


def test_split_counts_equal_a_walk_over_the_trees(spark):
    df = points(spark)
    model, _ = md.train_gbt(df, FEATURES + ["i"], "y", params={"max_depth": 3}, max_iter=6, patience=0)
    counts = dict.fromkeys(FEATURES + ["i"], 0)

    def walk(node):
        if node.getClass().getSimpleName() == "InternalNode":
            counts[(FEATURES + ["i"])[node.split().featureIndex()]] += 1
            walk(node.leftChild())
            walk(node.rightChild())

    for tree in model.stages[-1].trees:
        walk(tree._java_obj.rootNode())
    got = md.split_counts(model, FEATURES + ["i"]).collect()
    assert {r.feature: r.importance for r in got} == counts and sum(counts.values()) > 6
    assert [r.importance for r in got] == sorted(counts.values(), reverse=True)


# ------------------------------------------------------------------------- ledger
def searching(df, ledger, fail_after=None, seen=None):
    """A grid search whose scoring fails after some fits."""
    count = [0]
    plain = BinaryClassificationEvaluator.evaluate

    def evaluate(self, data, params=None):
        count[0] += 1
        if fail_after is not None and count[0] > fail_after:
            raise RuntimeError("lost")
        if seen is not None:
            seen.append(1)
        return plain(self, data)

    patch = pytest.MonkeyPatch()
    patch.setattr(BinaryClassificationEvaluator, "evaluate", evaluate)
    try:
        grid = {"max_depth": [1, 2], "learning_rate": [0.1, 0.5], "bagging_freq": [3, 5]}
        return md.grid_search(df, FEATURES, "y", "fold", grid, base={"n_estimators": 2}, parallelism=2, ledger=ledger)
    finally:
        patch.undo()


def test_a_stopped_search_goes_on_where_it_was(spark):
    df = points(spark, 200)
    whole, order, _ = searching(df, trials.Ledger(spark, scratch_path(spark, "ledger")))
    ledger, seen = trials.Ledger(spark, scratch_path(spark, "ledger")), []
    with pytest.raises(RuntimeError, match="lost"):
        searching(df, ledger, fail_after=5)
    done = len(ledger.finished())
    assert 0 < done <= 5 and ledger.table().count() == done
    table, again, best = searching(df, ledger, seen=seen)
    assert len(seen) == 12 - done  # four distinct points of three folds
    assert table.collect() == whole.collect() and again == order
    assert table.columns == ["rank_test_score", "grid_index", "param_max_depth", "param_learning_rate", "param_bagging_freq",
                             "mean_test_score", "std_test_score"]
    assert best.stages[-1].getNumTrees == 2
    seen.clear()
    searching(df, ledger, seen=seen)
    assert seen == []  # nothing is fitted twice
    searching(df.where("i > 0"), ledger, seen=seen)
    assert len(seen) == 12  # other data, other fits
    top = md.topk_refit(df, FEATURES, "y", table, 3, max_iter=4, patience=2)
    rows = {r.rank_test_score: r for r in top.collect()}
    assert sorted(rows) == [1, 2, 3] and all(0 <= r.val_auc <= 1 and 1 <= r.rounds <= 4 for r in rows.values())
    assert rows[1].param_max_depth == order[0]["max_depth"]
    seconds = trials.seconds_per_fit(ledger, ["maxDepth"]).collect()
    assert sorted(r.maxDepth for r in seconds) == ["1", "2"] and all(r.seconds > 0 for r in seconds)


def test_an_unfinished_fit_does_not_count(spark, tmp_path):
    ledger = trials.Ledger(spark, str(tmp_path / "ledger"))
    assert ledger.finished() == set() and ledger.table().count() == 0
    ledger.add("t1", 0, 0.5, 1.0, {"maxDepth": 3})
    ledger.add("t1", 1, 0.7, 2.0, {"maxDepth": 3})
    ledger.add("t2", 0, 0.9, 1.0, {"maxDepth": 4})
    (tmp_path / "ledger" / "trial=t2" / "fold=1").mkdir()
    (tmp_path / "ledger" / "trial=t2" / "fold=1" / "part-0.parquet").write_text("cut off")
    assert ledger.finished() == {("t1", 0), ("t1", 1), ("t2", 0)}
    got = ledger.scores(["t1", "t2"], 2).collect()
    assert [(r.trial, r.mean_score, r.std_score) for r in got] == [("t1", pytest.approx(0.6), pytest.approx(0.1))]
    ledger.add("t2", 1, 0.7, 1.0, {"maxDepth": 4})  # written again over what was left
    assert len(ledger.scores(["t1", "t2"], 2).collect()) == 2


# -------------------------------------------------------------- saved preparation
def messy(spark):
    return spark.createDataFrame(
        [(1.0, None, "u", 1, 0), (2.0, 5.0, "v", 1, 1), (float("nan"), 7.0, None, 2, 0), (4.0, float("inf"), "u", 2, 1)],
        "a double, b double, s string, k int, y int")


@pytest.mark.parametrize("strategy", ["mean", "median", "most_frequent"])
@pytest.mark.parametrize("method", ["standard", "minmax"])
def test_preparation_equals_the_functions_and_survives_a_round_trip(spark, strategy, method):
    df = messy(spark)
    model = pre.Preparation(columns=["a", "b"], categorical=["s"], strategy=strategy, method=method).fit(df)
    flat = prep.apply_one_hot(df, prep.fit_one_hot(df, ["s"]))
    expected = prep.scale(prep.impute(flat, model.features(), strategy, None), model.features(), method, None)
    assert model.features() == ["a", "b", "s_u", "s_v"]
    rows = [tuple(pytest.approx(v) for v in r) for r in expected.select("k", "y", *model.features()).collect()]
    path = scratch_path(spark, "prep")
    model.write().save(path)
    for m in (model, pre.PreparationModel.load(path)):
        assert [tuple(r) for r in m.transform(df).select("k", "y", *m.features()).collect()] == rows
    new = spark.createDataFrame([(None, None, "w", 9, 1)], df.schema)  # unseen category, nothing known
    out = pre.PreparationModel.load(path).transform(new).first()
    fills, scales = model.getOrDefault("fills"), model.getOrDefault("scales")
    assert out["a"] == pytest.approx((fills["a"] - scales["a"][0]) / scales["a"][1])
    assert out["s_u"] == pytest.approx((0 - scales["s_u"][0]) / scales["s_u"][1])


def test_empty_training_columns(spark):
    df = messy(spark).withColumn("z", F.lit(None).cast("double"))
    with pytest.raises(ValueError, match="no training value"):
        pre.Preparation(columns=["a", "z"]).fit(df)
    model = pre.Preparation(columns=["a", "z"], onEmpty="drop").fit(df)
    assert model.features() == ["a"]


def test_sparse_one_hot_is_scaled_without_being_filled_in(spark):
    rows = [(i, f"c{i % 700}") for i in range(2000)] + [(5000, None)]
    train = spark.createDataFrame(rows, "i int, c string")
    stages = pre.sparse_one_hot(train, "c", "v")
    new = spark.createDataFrame([(1, "c5"), (2, "unseen"), (3, None), (4, "c699")], "i int, c string")
    path = scratch_path(spark, "sparse")
    PipelineModel(stages=stages).write().save(path)
    out = PipelineModel.load(path).transform(new)
    assert out.columns == ["i", "c", "v"]
    labels, n = sorted({c for _, c in rows if c}), len(rows)
    for r in out.collect():
        assert r.v.size == 700 and type(r.v).__name__ == "SparseVector"
        p = sum(c == r.c for _, c in rows) / n
        if r.c in labels:
            assert r.v.indices.tolist() == [labels.index(r.c)] and r.v.values[0] == pytest.approx((p * (1 - p)) ** -0.5)
        else:
            assert r.v.numNonzeros() == 0


def test_scorer_goes_from_daily_rows_to_a_probability(spark):
    daily = fx.daily_weather(spark, SF0001, nulls=True)
    past = daily.where("time < '1997-01-01'").withColumn("y", (F.col("temperature_2m_max") > 30).cast("int"))
    past = past.withColumn("station", F.concat(F.lit("s"), F.col("series_key")))
    forest = RandomForestClassifier(labelCol="y", numTrees=5, maxDepth=4, seed=1)
    model = pre.fit_scorer(past, "y", forest, sparse=["station"])
    path = scratch_path(spark, "scorer")
    md.save_model(model, path)
    same = md.load_model(path)
    later = daily.withColumn("station", F.lit("unseen"))
    a = pre.score_range(model, later, "1997-01-01", "1997-03-31").withColumn("p", md.positive_proba())
    b = same.transform(later).where("time between '1997-01-01' and '1997-03-31'").withColumn("p", md.positive_proba())
    cols = ["series_key", "time", "p", "precip_30d_sum", "lag7"]
    rows = [sorted(map(tuple, x.select(*cols).collect())) for x in (a, b)]
    assert rows[0] == rows[1] and len(rows[0]) > 100  # the halo gives what the whole history gives
    assert all(0 <= r[2] <= 1 for r in rows[0])


@pytest.mark.parametrize("task", ["regression", "classification"])
def test_known_features_equal_the_pipeline_s(spark, task):
    """Where no row was dropped for its target, new rows get what training rows got."""
    from dailyseries.plans.pipeline import build_features, known_features
    daily = fx.daily_weather(spark, SF0001)
    old, target = build_features(daily, task)
    new = known_features(daily, task)
    both = [c for c in old.columns if c != target]
    assert set(both) == set(new.columns)
    lost = old.select(*both).exceptAll(new.select(*both))
    if task == "classification":
        assert lost.count() == 0
    else:  # the first rows' lags reach a target that the known form lacks, and the reverse
        drop = [c for c in both if not c.startswith("lag") or "_" in c]
        assert old.select(*drop).exceptAll(new.select(*drop)).count() == 0
        w = "lag1 is not null and lag2 is not null"
        assert old.where(w).select(*both).exceptAll(new.select(*both)).count() == 0
