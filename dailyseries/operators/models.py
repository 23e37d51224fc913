"""Training, tuning and scoring with ``pyspark.ml``.

Trees are fitted by Spark's distributed learners (histogram aggregation
over the cluster); metrics reuse the exact DataFrame metrics of
``operators.metrics`` -- one grouped job for many models.  Boosted-tree
numbers do not equal LightGBM/XGBoost; properties are tested instead.

Parameter mapping from the reference's boosting libraries:
learning_rate -> stepSize, n_estimators -> maxIter, num_leaves ->
maxDepth = ceil(log2(num_leaves)), max_depth -1 -> 30 (Spark's cap),
min_data_in_leaf / min_child_weight -> minInstancesPerNode,
feature_fraction / colsample_bytree -> featureSubsetStrategy,
bagging_fraction / subsample -> subsamplingRate; bagging_freq, reg_alpha,
reg_lambda and gamma have no counterpart (gamma is a sum over a node's rows,
Spark's minInfoGain a mean, which no split reaches at gamma's values).
"""

from __future__ import annotations

import math
import random
import warnings
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark import SparkContext, StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dailyseries.operators.boosting import fit_boosted
from dailyseries.operators.metrics import roc_auc
from dailyseries.operators.quality import ensure_numeric
from dailyseries.operators.trials import Ledger, cross_validate, packed, ranked, run_fits
from dailyseries.session import checkpoint_dir, scratch_path

SEED = 42
# fixed values: the reference's default boosting grid
DEFAULT_GRID = {
    "learning_rate": [0.001, 0.005, 0.01, 0.05],
    "num_leaves": [32, 64, 128, 256],
    "max_depth": [4, 6, 8, -1],
    "min_data_in_leaf": [10, 20, 50],
    "feature_fraction": [0.6, 0.8, 1.0],
    "bagging_fraction": [0.6, 0.8, 1.0],
    "bagging_freq": [3, 5, 7],
}


# parameters without a counterpart in Spark's trees: reported, not applied
UNSUPPORTED = ("bagging_freq", "reg_alpha", "reg_lambda", "gamma")
MAX_DEPTH = 30  # Spark's limit; also what "no limit" means


def spark_params(params: Mapping) -> dict:
    """Map boosting-library parameter names to Spark tree parameters.

    Unknown names raise; names without a counterpart and depths above Spark's
    limit are reported with a warning."""
    out: dict = {}
    depths: list[int] = []
    for k, v in params.items():
        if k in ("learning_rate", "eta"):
            out["stepSize"] = float(v)
        elif k in ("n_estimators", "num_boost_round"):
            out["maxIter"] = int(v)
        elif k == "num_leaves":
            depths.append(int(math.ceil(math.log2(max(2, int(v))))))
        elif k == "max_depth":
            depths.append(MAX_DEPTH if int(v) <= 0 else int(v))
        elif k in ("min_data_in_leaf", "min_child_samples", "min_child_weight"):
            out["minInstancesPerNode"] = max(1, int(v))
        elif k in ("feature_fraction", "colsample_bytree"):
            out["featureSubsetStrategy"] = "all" if float(v) >= 1 else str(float(v))
        elif k in ("bagging_fraction", "subsample"):
            out["subsamplingRate"] = float(v)
        elif k in UNSUPPORTED:
            warnings.warn(f"{k} has no counterpart in Spark's trees and is not applied", stacklevel=2)
        else:
            raise ValueError(f"unknown model parameter {k!r}")
    if depths:
        if min(depths) > MAX_DEPTH:
            warnings.warn(f"depth {min(depths)} is above Spark's limit of {MAX_DEPTH}", stacklevel=2)
        out["maxDepth"] = min([*depths, MAX_DEPTH])
    return out


def positive_proba(col: str = "probability"):
    return vector_to_array(F.col(col))[1]


def class_weights(df: DataFrame, label: str, split_col: str | None = "split", out: str = "_w") -> DataFrame:
    """A5 as a weight column: negatives/positives on positive rows, 1 elsewhere."""
    tr = df.where(F.col(split_col) == "train") if split_col else df
    row = tr.agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n")).first()
    spw = 1.0 if not row["p"] else row["n"] / row["p"]
    return df.withColumn(out, F.when(F.col(label) == 1, F.lit(spw)).otherwise(F.lit(1.0)))


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")


def weighted_vectors(df: DataFrame, features: Sequence[str], label: str, split_col: str = "split",
                     weighted: bool = True) -> DataFrame:
    """(features, label, _w, split): what the learners read, without the columns
    the features came from."""
    data = class_weights(df, label, split_col) if weighted else df.withColumn("_w", F.lit(1.0))
    return _assembler(features).transform(data).select("features", label, "_w", split_col)


def node_table(spark: SparkSession, model) -> DataFrame:
    """The fitted trees as a table, read back from the saved model: (tree, node,
    prediction, gain, left, right, feature); leaves have feature -1.

    Node numbers go by preorder, as the learners' own leaf numbers do."""
    path = scratch_path(spark, "forest")
    model.write().overwrite().save(path)
    rows = spark.read.parquet(f"{path}/data")
    return rows.select(F.col("treeID").alias("tree"), F.col("nodeData.id").alias("node"),
                       F.col("nodeData.prediction").alias("prediction"), F.col("nodeData.gain").alias("gain"),
                       F.col("nodeData.leftChild").alias("left"), F.col("nodeData.rightChild").alias("right"),
                       F.col("nodeData.split.featureIndex").alias("feature"))


def staged_margins(model, vectors: DataFrame, keep: Sequence[str]) -> DataFrame:
    """(round, keep..., margin): every row's margin after each boosting round.

    One pass over ``vectors``: the learner reports the leaf that a row reaches in
    each tree, and the margins are the running sums of the leaves' weighted
    predictions -- the sums that the first trees alone would give."""
    spark = vectors.sparkSession
    leaves = node_table(spark, model).where("left < 0").orderBy("tree", "node").select("tree", "prediction").collect()
    values: list[list[float]] = [[] for _ in model.trees]  # as many numbers as the model has leaves
    for r in leaves:
        values[r["tree"]].append(r["prediction"] * model.treeWeights[r["tree"]])
    table = spark.createDataFrame([(values,)], "v array<array<double>>").scalar()
    start = F.struct(F.lit(0.0).alias("s"), F.array().cast("array<double>").alias("all"))

    def add(acc, step):
        s = acc["s"] + step
        return F.struct(s.alias("s"), F.concat(acc["all"], F.array(s)).alias("all"))

    reached = F.zip_with(F.col("_v"), vector_to_array(F.col("_leaf")), lambda v, leaf: F.get(v, leaf.cast("int")))
    margins = F.aggregate(reached, start, add, lambda acc: acc["all"])
    at = model.copy().setLeafCol("_leaf").transform(vectors).withColumn("_v", table)
    return at.select(*keep, F.posexplode(margins).alias("_i", "margin")).select(
        (F.col("_i") + 1).alias("round"), *keep, "margin")


def truncated(model, rounds: int):
    """The boosted model of the first ``rounds`` trees; nothing is fitted again."""
    if rounds >= model.getNumTrees:
        return model
    gateway, java = SparkContext._gateway, model._java_obj
    trees, weights = java.trees(), java.treeWeights()
    kind = gateway.jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    some, their = gateway.new_array(kind, rounds), gateway.new_array(gateway.jvm.double, rounds)
    for i in range(rounds):
        some[i], their[i] = trees[i], weights[i]
    first = type(model)(getattr(gateway.jvm, java.getClass().getName())(java.uid(), some, their, java.numFeatures(),
                                                                       java.numClasses()))
    model._copyValues(first)
    first._transfer_params_to_java()
    return first


def best_round(scores: Sequence[float | None], patience: int) -> int:
    """Rounds to keep: the first best score found before ``patience`` rounds pass
    without a better one; all rounds if no score is defined."""
    best, at = None, len(scores)
    for i, s in enumerate(scores):
        if s is not None and (best is None or s > best):
            best, at = s, i + 1
        elif best is not None and i + 1 - at >= patience:
            break
    return at


def train_gbt(df: DataFrame, features: Sequence[str], label: str, split_col: str = "split",
              params: Mapping | None = None, max_iter: int = 300, patience: int = 30,
              weighted: bool = True) -> tuple[PipelineModel, int]:
    """M1: boosted trees on the train rows with class weights, stopped on the
    validation rows' AUC.

    One fit of ``max_iter`` rounds; the validation rows' margins after every
    round give the exact AUC of all rounds in one grouped job, the first round
    that no later one beats within ``patience`` rounds counts, and the
    list of trees is cut there.  Without validation rows, or where they
    have one class only, all rounds stay.  Returns (model, rounds kept).
    """
    ensure_numeric(df, features)
    sp = {"maxIter": max_iter, "seed": SEED, **spark_params(params or {})}
    gbt = GBTClassifier(labelCol=label, featuresCol="features", weightCol="_w", **sp)
    with packed(weighted_vectors(df, features, label, split_col, weighted)) as data:
        model = short_lineage(gbt).fit(data.where(F.col(split_col) == "train"))
        rounds = model.getNumTrees
        val = data.where(F.col(split_col) == "val")
        if patience and not val.isEmpty():
            staged = staged_margins(model, val, [label])
            aucs = {r["round"]: r["auc_score"] for r in roc_auc(staged, label, "margin", by=["round"]).collect()}
            rounds = best_round([aucs[i + 1] for i in range(model.getNumTrees)], patience)
            model = truncated(model, rounds)
    return PipelineModel(stages=[_assembler(features), model]), rounds


def score(model: PipelineModel, df: DataFrame, out: str = "p") -> DataFrame:
    """Probability of class 1 (``predict_proba(X)[:, 1]``)."""
    if model is None:
        raise ValueError("No model available")
    s = model.transform(df)
    return s.withColumn(out, positive_proba()).drop("features", "rawPrediction", "probability", "prediction")


def train_random_forest(df: DataFrame, features: Sequence[str], label: str, split_col: str = "split",
                        num_trees: int = 100, max_depth: int = 10, min_instances: int = 1) -> PipelineModel:
    """M4: random forest with fixed parameters."""
    ensure_numeric(df, features)
    rf = RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=num_trees,
                                maxDepth=max_depth, minInstancesPerNode=min_instances, seed=SEED)
    return Pipeline(stages=[_assembler(features), rf]).fit(df.where(F.col(split_col) == "train"))


def feature_importance(model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """(feature, importance) sorted descending; Spark reports normalised
    gain importance (the reference's LightGBM default counts splits)."""
    tree = model.stages[-1]
    imp = tree.featureImportances.toArray().tolist()
    names = list(features) if len(features) == len(imp) else [f"feature_{i}" for i in range(len(imp))]
    ss = SparkSession.getActiveSession()
    return (ss.createDataFrame(list(zip(names, map(float, imp))), "feature string, importance double")
              .orderBy(F.col("importance").desc(), "feature"))


def split_counts(model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """O5 as the reference's boosting library counts it: how many splits of the
    fitted trees use each feature, most first; features without a split
    have 0."""
    tree = model.stages[-1]
    spark = SparkSession.builder.getOrCreate()
    names = spark.createDataFrame(list(enumerate(features)), "feature_index int, feature string")
    used = (node_table(spark, tree).where("left >= 0").groupBy(F.col("feature").alias("feature_index"))
            .agg(F.count("*").alias("importance")))
    return (names.join(used, "feature_index", "left")
            .select("feature", F.coalesce("importance", F.lit(0)).alias("importance"))
            .orderBy(F.col("importance").desc(), "feature"))


def grid_from(grid: Mapping[str, Sequence]) -> list[dict]:
    keys = list(grid)
    out = [{}]
    for k in keys:
        out = [dict(d, **{k: v}) for d in out for v in grid[k]]
    return out


def _distinct(param_sets: Sequence[Mapping]) -> tuple[list[dict], list[int]]:
    """The distinct Spark parameter sets, and which of them each set maps to."""
    with warnings.catch_warnings():
        warnings.simplefilter("once")
        keys = [tuple(sorted(spark_params(p).items())) for p in param_sets]
    number = {key: n for n, key in enumerate(dict.fromkeys(keys))}
    return [dict(key) for key in number], [number[key] for key in keys]


def _fold_count(df: DataFrame, fold_col: str) -> int:
    """Folds are numbered from 0; CrossValidator takes three unless told."""
    return int(df.agg(F.max(fold_col)).first()[0]) + 1


# fixed values: column names of the reference's search results
RANKED = {"rank": "rank_test_score", "index": "grid_index", "mean": "mean_test_score", "std": "std_test_score"}


def grid_search(df: DataFrame, features: Sequence[str], label: str, fold_col: str = "fold",
                grid: Mapping[str, Sequence] | None = None, base: Mapping | None = None,
                parallelism: int = 4, ledger: Ledger | None = None) -> tuple[DataFrame, list[dict], PipelineModel]:
    """M2/O3: cross-validated AUC of every grid point (folds given by
    ``fold_col``, e.g. ``stratified_folds``); returns the ranked table of all
    points (rank, index, one ``param_*`` column per parameter, mean, std), the
    ranked parameter dicts and the best model refitted on all rows
    (assembler + trees).

    Positive rows are weighted as in ``train_gbt``, over all rows of ``df``;
    without ``base`` 300 rounds are fitted.  Points that map to the same
    Spark parameters are fitted once and share their scores.  Fits that the
    ``ledger`` holds are not fitted again, so a search that was stopped goes
    on where it was; without one, a fresh ledger is used."""
    combos = grid_from(grid or DEFAULT_GRID)
    est = GBTClassifier(labelCol=label, featuresCol="features", weightCol="_w", seed=SEED,
                        **{"maxIter": 300, **spark_params(base or {})})
    ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="probability",
                                       metricName="areaUnderROC", numBins=0)
    data = class_weights(df.withColumn(fold_col, F.col(fold_col).cast("int")), label, split_col=None)
    vectors = _assembler(features).transform(data).select("features", label, "_w", fold_col)
    table, at = _searched(vectors, est, combos, ev, fold_col, _fold_count(df, fold_col), ledger, [label, *features],
                          parallelism, RANKED)
    order = [combos[r[RANKED["index"]]] for r in table.collect()]  # one row per point
    distinct, number = _distinct(combos)
    best = distinct[number[combos.index(order[0])]]
    model = est.copy({est.getParam(k): v for k, v in best.items()}).fit(vectors)
    return table, order, PipelineModel(stages=[_assembler(features), model])


def _searched(vectors: DataFrame, est, points: Sequence[Mapping], evaluator, fold_col: str, folds: int,
              ledger: Ledger | None, key: object, parallelism: int, names: Mapping[str, str],
              ascending: bool = False) -> tuple[DataFrame, list[str]]:
    """The ranked table of a search and the trial of each point."""
    spark = vectors.sparkSession
    ledger = ledger or Ledger(spark, scratch_path(spark, "ledger"))
    distinct, at = _distinct(points)
    trials = cross_validate(vectors, est, distinct, evaluator, fold_col, folds, ledger, key, parallelism)
    of_point = [trials[n] for n in at]
    return ranked(ledger, of_point, points, folds, names, ascending), of_point


def topk_refit(df: DataFrame, features: Sequence[str], label: str, searched: DataFrame, k: int = 10,
               max_iter: int = 300, patience: int = 30, parallelism: int = 4) -> DataFrame:
    """M6: the ``k`` best points of a search's ranked table fitted again with
    early stopping: their parameter columns, mean score, rounds kept,
    validation AUC and per cent of validation rows predicted 0.

    The table alone is read; the search itself doesn't run again."""
    top = searched.orderBy(RANKED["rank"]).limit(k).collect()
    named = [c for c in searched.columns if c.startswith("param_")]
    points = [{c.removeprefix("param_"): r[c] for c in named if r[c] is not None} for r in top]
    fits = fit_many(df, features, label, points, max_iter=max_iter, patience=patience, parallelism=parallelism)
    ev = evaluate_models(df, {str(r[RANKED["rank"]]): m for r, (m, _) in zip(top, fits, strict=True)}, label)
    rounds = df.sparkSession.createDataFrame([(str(r[RANKED["rank"]]), n) for r, (_, n) in zip(top, fits, strict=True)],
                                             "model_name string, rounds int")
    table = searched.select(F.col(RANKED["rank"]).cast("string").alias("model_name"), RANKED["rank"], *named, RANKED["mean"])
    return table.join(ev, "model_name").join(rounds, "model_name").drop("model_name")


def sample_params(space: Mapping[str, Sequence], n: int, seed: int = SEED) -> list[dict]:
    """M3/M5: ``n`` distinct parameter draws from a discrete space, seeded."""
    size = math.prod(len(v) for v in space.values())
    out = []
    for index in random.Random(seed).sample(range(size), min(n, size)):
        point = {}
        for k, values in space.items():  # mixed radix: the space is never listed
            index, digit = divmod(index, len(values))
            point[k] = values[digit]
        out.append(point)
    return out


def random_search_regression(df: DataFrame, features: Sequence[str], label: str, fold_col: str,
                             space: Mapping[str, Sequence], n_iter: int = 30,
                             parallelism: int = 4, ledger: Ledger | None = None) -> DataFrame:
    """M3: seeded random search of boosted regression trees, k-fold RMSE;
    ``ledger`` as in ``grid_search``."""
    draws = sample_params(space, n_iter)
    est = GBTRegressor(labelCol=label, featuresCol="features", seed=SEED)
    ev = RegressionEvaluator(labelCol=label, metricName="rmse")
    vectors = (_assembler(features).transform(df.withColumn(fold_col, F.col(fold_col).cast("int")))
               .select("features", label, fold_col))
    names = {"rank": "rank_test_score", "index": "draw", "mean": "mean_rmse", "std": "std_rmse"}
    return _searched(vectors, est, draws, ev, fold_col, _fold_count(df, fold_col), ledger, [label, *features], parallelism,
                     names, ascending=True)[0]


def fit_many(df: DataFrame, features: Sequence[str], label: str, param_sets: Sequence[Mapping],
             split_col: str = "split", max_iter: int = 50, patience: int = 10,
             parallelism: int = 4, weighted: bool = True) -> list[tuple[PipelineModel, int]]:
    """Fit several boosted models concurrently (driver threads each launch
    cluster jobs, like CrossValidator's ``parallelism``).  Sets that map to the
    same Spark parameters share one fit."""
    distinct, at = _distinct(param_sets)
    first = [param_sets[at.index(n)] for n in range(len(distinct))]

    def one(p):
        return train_gbt(df, features, label, split_col, p, max_iter=max_iter, patience=patience, weighted=weighted)
    fits = run_fits(df.sparkSession, first, one, parallelism)
    return [fits[n] for n in at]


CHECKPOINT_ROUNDS = 3


def short_lineage(est):
    """``est`` with its boosting state checkpointed every few rounds; the model is the same.

    Every task of a round carries the trees since the last checkpoint."""
    if not est.hasParam("checkpointInterval") or est.isSet("checkpointInterval"):
        return est.copy()
    checkpoint_dir(SparkSession.builder.getOrCreate())
    return est.copy({est.checkpointInterval: CHECKPOINT_ROUNDS})


def fit_one(est, data: DataFrame):
    """``est`` fitted to ``data``: boosted trees of a table that one task can hold in that
    task, all else by Spark's jobs."""
    model = fit_boosted(est, data)
    return short_lineage(est).fit(data) if model is None else model


def fit_members(df: DataFrame, features: Sequence[str], members: Mapping, split_col: str = "split",
                parallelism: int = 4) -> dict[str, PipelineModel]:
    """M7: every estimator of ``members`` fitted on the train rows, by name."""
    ensure_numeric(df, features)
    asm = _assembler(features)
    label = next(iter(members.values())).getLabelCol()
    with packed(asm.transform(df.where(F.col(split_col) == "train")).select("features", label)) as train:
        fits = run_fits(df.sparkSession, list(members.values()), lambda e: fit_one(e, train), parallelism)
    return {name: PipelineModel(stages=[asm, m]) for name, m in zip(members, fits, strict=True)}


def _scored(df: DataFrame, models: Sequence[PipelineModel]) -> DataFrame:
    """``df`` with the class-1 probability of every model as ``_p0``, ``_p1``, ...: one pass,
    and models that share an assembler share its vectors."""
    cur, made = df, None
    for i, m in enumerate(models):
        first, *rest = m.stages
        if first is not made:
            cur = first.transform(cur.drop("features"))
        made = first
        for stage in rest:
            cur = stage.transform(cur)
        cur = cur.withColumn(f"_p{i}", positive_proba()).drop("rawPrediction", "probability", "prediction")
    return cur


def evaluate_models(df: DataFrame, models: Mapping[str, PipelineModel], label: str,
                    split_value: str = "val", split_col: str = "split", key: Sequence[str] = ()) -> DataFrame:
    """Score one split with every model and compute val AUC and
    % predicted zero for all of them in ONE grouped job (long frame)."""
    part = df.where(F.col(split_col) == split_value)
    cols = [F.struct(F.lit(name).alias("model_name"), F.col(f"_p{i}").alias("p")) for i, name in enumerate(models)]
    # scored once, and read by the AUC and by the share of zeros
    longs = (_scored(part, list(models.values())).select(*key, F.col(label).alias("y"), F.inline(F.array(*cols)))
             .persist(StorageLevel.DISK_ONLY))
    auc = roc_auc(longs, "y", "p", by=["model_name"]).withColumnRenamed("auc_score", "val_auc")
    zeros = longs.groupBy("model_name").agg(
        (F.avg(F.when(F.col("p") >= 0.5, 0.0).otherwise(1.0)) * 100).alias("percent_zeros_on_val"))
    return auc.join(zeros, "model_name")


def soft_vote(df: DataFrame, models: Sequence[PipelineModel], out: str = "p") -> DataFrame:
    """M7: mean of the members' class-1 probabilities, by chaining the
    members' transforms on one frame (no join)."""
    cur = df
    cols = []
    for i, m in enumerate(models):
        cur = m.transform(cur).withColumn(f"_p{i}", positive_proba()).drop(
            "features", "rawPrediction", "probability", "prediction")
        cols.append(F.col(f"_p{i}"))
    return cur.withColumn(out, sum(cols[1:], cols[0]) / len(cols)).drop(*[f"_p{i}" for i in range(len(models))])


def fold_fit_score(df: DataFrame, features: Sequence[str], label: str, estimator,
                   fold_col: str = "fold", train_from_col: str = "train_from",
                   keep: Sequence[str] = (), parallelism: int = 4) -> DataFrame:
    """L2/L3 with a model: for every test fold k fit ``estimator`` on the rows
    positioned before that fold (``train_from <= k``, from
    ``splits.walk_forward_folds`` / ``time_series_folds``) and score the
    fold's rows.  Returns (fold, keep..., y, p) of all folds -- scored by ONE
    grouped metric job afterwards.  Several estimators (a sequence of
    classifiers) are fitted each and give the mean of their probabilities."""
    folds = sorted(r[0] for r in df.where(F.col(fold_col).isNotNull()).select(fold_col).distinct().collect())
    if not folds:
        raise ValueError(f"no rows have a fold in {fold_col!r}")
    members = list(estimator) if isinstance(estimator, Sequence) else [estimator]
    asm = _assembler(features)
    jobs = [(k, m) for k in folds for m in range(len(members))]
    with packed(asm.transform(df).select("features", label, train_from_col)) as vectors:
        def one(job: tuple[int, int]):
            k, m = job
            return fit_one(members[m], vectors.where(F.col(train_from_col) <= k))

        # fits of different folds and members run beside each other
        fits = dict(zip(jobs, run_fits(df.sparkSession, jobs, one, parallelism), strict=True))
    out = []
    for k in folds:
        test, models = df.where(F.col(fold_col) == k), [PipelineModel(stages=[asm, fits[k, m]]) for m in range(len(members))]
        if isinstance(estimator, Sequence):
            scored = soft_vote(test, models)
        else:
            scored = models[0].transform(test)
            scored = scored.withColumn("p", positive_proba() if "probability" in scored.columns else F.col("prediction"))
        out.append(scored.select(F.lit(k).alias("fold"), *keep, F.col(label).alias("y"), "p"))
    return reduce(DataFrame.unionByName, out)


def save_model(model: PipelineModel | None, path: str) -> None:
    """Write a fitted model; a missing model raises."""
    if model is None:
        raise ValueError("no trained model to save")
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """Read a model written by ``save_model``."""
    return PipelineModel.load(path)
