"""A resumable ledger of cross-validation fits (M2, M3, M6, O3).

A search is a set of fits, one per parameter set and fold.  Every finished fit
is a row of the ledger, a table in the shared folder; a search that starts
again skips the fits that are there, and rankings and refits read the ledger
instead of fitting again.

Each fit writes a folder of its own (``trial=.../fold=...``), so fits that
run at the same time never touch each other's files, and a folder counts only
once its job has committed.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator
from pyspark.ml.evaluation import Evaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dailyseries.session import remove, scratch_path

ROW = "score double, seconds double, params string"
SMALL, ROWS_PER_PARTITION = 2_000, 200_000  # a fit is one job per tree level: few, full partitions


def _json(value: object) -> str:
    return json.dumps(value, sort_keys=True, default=str)


def fingerprint(data: DataFrame, columns: Sequence[str]) -> str:
    """A number of the rows, whatever their order, so that a ledger knows its data."""
    row = data.select(F.xxhash64(*columns).alias("h")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("s")).first()
    return f"{row['n']}:{row['s']}"


def trial_id(*parts: object) -> str:
    """Names everything that decides a fit's score."""
    return hashlib.sha256(_json(parts).encode()).hexdigest()[:24]


class Ledger:
    """Finished fits: (trial, fold, score, seconds, params)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _folder(self, trial: str, fold: int) -> str:
        return f"{self.path}/trial={trial}/fold={fold}"

    def _committed(self) -> list[str]:
        jvm = self.spark.sparkContext._jvm
        pattern = jvm.org.apache.hadoop.fs.Path(f"{self.path}/trial=*/fold=*/_SUCCESS")
        fs = pattern.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return sorted(st.getPath().getParent().toString() for st in fs.globStatus(pattern) or [])

    def finished(self) -> set[tuple[str, int]]:
        """The (trial, fold) of all finished fits."""
        parts = [p.rsplit("/", 2)[1:] for p in self._committed()]
        return {(trial.split("=", 1)[1], int(fold.split("=", 1)[1])) for trial, fold in parts}

    def add(self, trial: str, fold: int, score: float, seconds: float, params: Mapping) -> None:
        row = self.spark.createDataFrame([(float(score), float(seconds), _json(dict(params)))], ROW)
        row.coalesce(1).write.mode("overwrite").parquet(self._folder(trial, fold))

    def table(self) -> DataFrame:
        """(trial, fold, score, seconds, params) of all finished fits."""
        schema = f"{ROW}, trial string, fold int"
        paths = self._committed()
        rows = (self.spark.read.schema(schema).option("basePath", self.path).parquet(*paths) if paths
                else self.spark.createDataFrame([], schema))
        return rows.select("trial", "fold", "score", "seconds", "params")

    def scores(self, trials: Sequence[str], folds: int) -> DataFrame:
        """(trial, mean_score, std_score) of the ``trials`` whose folds are all
        there: population deviation, as the reference's search reports."""
        wanted = self.spark.createDataFrame([(t,) for t in dict.fromkeys(trials)], "trial string")
        rows = self.table().join(wanted, "trial", "left_semi").where(F.col("fold") < folds)
        by_fold = F.transform(F.array_sort(F.collect_list(F.struct("fold", "score"))), lambda x: x["score"])
        zero = F.lit(0.0)

        def mean(values):  # in the order of the folds: the same sum whichever fit ended first
            return F.aggregate(values, zero, lambda a, b: a + b) / folds

        got = rows.groupBy("trial").agg(by_fold.alias("s")).where(F.size("s") == folds).withColumn("mean_score", mean("s"))
        away = F.transform("s", lambda x: (x - F.col("mean_score")) * (x - F.col("mean_score")))
        return got.select("trial", "mean_score", F.sqrt(mean(away)).alias("std_score"))


def partitions_for(rows: int, cores: int) -> int:
    """Partitions of a training table: a core each while that leaves SMALL rows
    in one, and full ones beyond."""
    return max(1, min(-(-rows // SMALL), max(cores, -(-rows // ROWS_PER_PARTITION))))


@contextmanager
def packed(data: DataFrame) -> Iterator[DataFrame]:
    """``data`` written once and read back in few partitions, for a learner that
    starts a job per tree level.

    Every task of these jobs carries its plan; that of the feature columns is
    a hundred times larger than that of a file scan, and reading it took
    more of a task than the work did."""
    spark, path = data.sparkSession, scratch_path(data.sparkSession, "vectors")
    try:
        data.write.parquet(path)
        table = spark.read.schema(data.schema).parquet(path)
        yield table.coalesce(partitions_for(table.count(), spark.sparkContext.defaultParallelism))
    finally:
        remove(spark, path)


def run_fits(spark: SparkSession, jobs: Sequence[object], one: Callable[[object], object], parallelism: int) -> list:
    """``one`` of every job, some at a time, each in a scheduler pool of its own
    (with ``spark.scheduler.mode=FAIR`` the pools share the cluster evenly)."""
    def pooled(numbered: tuple[int, object]):
        n, job = numbered
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"fit-{n % max(1, parallelism)}")
        return one(job)

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        return list(pool.map(inheritable_thread_target(spark)(pooled), list(enumerate(jobs))))


def cross_validate(data: DataFrame, estimator: Estimator, param_sets: Sequence[Mapping], evaluator: Evaluator,
                   fold_col: str, folds: int, ledger: Ledger, key: object = None, parallelism: int = 4) -> list[str]:
    """Fit every parameter set (Spark names) on all folds but one and score it on
    that one, unless the ledger has it; returns the trial of each set.

    ``data`` holds assembled features; ``key`` names what else decides the
    scores (label, features, fixed parameters)."""
    columns = [c for c, t in data.dtypes if t != "vector" and not t.startswith("struct")]
    of_data = fingerprint(data, columns)
    fixed = {p.name: str(v) for p, v in estimator.extractParamMap().items()}
    trials = [trial_id(of_data, type(estimator).__name__, fixed, sorted(s.items()), folds, key) for s in param_sets]
    done = ledger.finished()
    todo = [(t, k, s) for t, s in dict(zip(trials, param_sets, strict=True)).items() for k in range(folds) if (t, k) not in done]
    if not todo:
        return trials
    metric = evaluator.getMetricName()

    def one(job: tuple[str, int, Mapping]) -> None:
        trial, k, params = job
        began = time.perf_counter()
        est = estimator.copy({estimator.getParam(name): v for name, v in params.items()})
        model = est.fit(table.where(F.col(fold_col) != k))
        score = evaluator.evaluate(model.transform(table.where(F.col(fold_col) == k)))
        ledger.add(trial, k, score, time.perf_counter() - began, dict(params) | {"metric": metric})

    with packed(data) as table:
        run_fits(data.sparkSession, todo, one, parallelism)
    return trials


def ranked(ledger: Ledger, trials: Sequence[str], points: Sequence[Mapping], folds: int, names: Mapping[str, str],
           ascending: bool = False) -> DataFrame:
    """The points of a search by their mean score: (rank, index, ``param_*`` one
    column per parameter, mean, std); ``names`` gives the columns' names.

    Equal means share the smaller index first.  Points whose fits are not
    all in the ledger are left out, so a search that was stopped can be read."""
    keys = list(dict.fromkeys(k for p in points for k in p))
    types = {k: "double" if any(isinstance(p.get(k), float) for p in points) else "bigint" for k in keys}
    rows = [(t, i, *[None if p.get(k) is None else float(p[k]) if types[k] == "double" else int(p[k]) for k in keys])
            for i, (t, p) in enumerate(zip(trials, points, strict=True))]
    schema = ", ".join(["trial string", f"{names['index']} int", *[f"`param_{k}` {types[k]}" for k in keys]])
    scored = ledger.spark.createDataFrame(rows, schema).join(ledger.scores(trials, folds), "trial")
    got = scored.collect()  # one row per point of the search
    sign = 1 if ascending else -1
    got.sort(key=lambda r: (sign * r["mean_score"], r[names["index"]]))
    out = [(n + 1, r[names["index"]], *[r[f"param_{k}"] for k in keys], r["mean_score"], r["std_score"])
           for n, r in enumerate(got)]
    head = ", ".join([f"{names['rank']} int", f"{names['index']} int", *[f"`param_{k}` {types[k]}" for k in keys],
                      f"{names['mean']} double", f"{names['std']} double"])
    return ledger.spark.createDataFrame(out, head)


def seconds_per_fit(ledger: Ledger, names: Sequence[str]) -> DataFrame:
    """Fits and mean seconds a fit by the value of some Spark parameters."""
    fields = [F.get_json_object("params", f"$.{n}").alias(n) for n in names]
    return ledger.table().select(*fields, "seconds").groupBy(*names).agg(
        F.count("*").alias("fits"), F.avg("seconds").alias("seconds"))
