"""Preparation fitted once and kept: persistable ML stages.

``Preparation`` learns one-hot categories, fills and scales on the training
rows; its model is a stage like any other, so one ``PipelineModel`` goes from
daily rows to a probability, is written and read back whole, and scores
later rows with the statistics of its own training rows.

Columns with very many categories are encoded as sparse vectors beside the
dense block (``sparse_one_hot``): one entry a row, divided by the category's
deviation and never filled in.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model, PipelineModel, Transformer
from pyspark.ml.feature import ElementwiseProduct, OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailyseries.functions.scalar import inf_to_null
from dailyseries.operators import prepare as prep
from dailyseries.operators.trials import packed
from dailyseries.plans.halo import halo_bounds
from dailyseries.plans.ranking import join_groups


class _Settings(Params):
    """What both the estimator and its model carry."""

    columns = Param(Params._dummy(), "columns", "numeric columns to fill and scale", TypeConverters.toListString)
    categorical = Param(Params._dummy(), "categorical", "columns turned into one 0/1 column per category",
                        TypeConverters.toListString)
    strategy = Param(Params._dummy(), "strategy", "mean, median or most_frequent", TypeConverters.toString)
    method = Param(Params._dummy(), "method", "standard or minmax", TypeConverters.toString)
    onEmpty = Param(Params._dummy(), "onEmpty", "a column without training values: error, null or drop",
                    TypeConverters.toString)


class Preparation(Estimator, _Settings, DefaultParamsReadable, DefaultParamsWritable):
    """Fit on the rows given, which are the training rows: categories of the
    ``categorical`` columns, then fills and scales of ``columns`` and of the
    0/1 columns."""

    @keyword_only
    def __init__(self, *, columns: Sequence[str] = (), categorical: Sequence[str] = (), strategy: str = "mean",
                 method: str = "standard", onEmpty: str = "error"):
        super().__init__()
        self._setDefault(columns=[], categorical=[], strategy="mean", method="standard", onEmpty="error")
        self._set(**{k: list(v) if k in ("columns", "categorical") else v for k, v in self._input_kwargs.items()})

    def _fit(self, df: DataFrame) -> "PreparationModel":
        categories = prep.fit_one_hot(df, self.getOrDefault("categorical"))
        dummies = [f"{c}_{v}" for c, values in categories.items() for v in values]
        columns = [*self.getOrDefault("columns"), *dummies]
        train = inf_to_null(prep.apply_one_hot(df, categories), columns)
        strategy, method, on_empty = (self.getOrDefault(p) for p in ("strategy", "method", "onEmpty"))
        if strategy == "mean":
            fills, scales = prep.fit_impute_scale(train, columns, method, None, on_empty)
        else:
            fills = prep.fit_impute(train, columns, strategy, None, on_empty)
            scales = prep.fit_scale(prep.apply_impute(train, fills), list(fills), method, None)
        model = PreparationModel()
        model._set(categories=categories, fills=fills, scales={c: list(v) for c, v in scales.items()}, output=columns)
        return self._copyValues(model)


class PreparationModel(Model, _Settings, DefaultParamsReadable, DefaultParamsWritable):
    """The fitted preparation.  Other columns pass through; a category that the
    training rows did not have gives 0 in all columns of its own."""

    categories = Param(Params._dummy(), "categories", "values of each one-hot column")
    fills = Param(Params._dummy(), "fills", "value for a missing entry, by column")
    scales = Param(Params._dummy(), "scales", "(centre, divisor) by column")
    output = Param(Params._dummy(), "output", "prepared columns in order", TypeConverters.toListString)

    def __init__(self):
        super().__init__()
        self._setDefault(columns=[], categorical=[], strategy="mean", method="standard", onEmpty="error")

    def features(self) -> list[str]:
        """The prepared columns, in the order the learner sees them."""
        return [c for c in self.getOrDefault("output") if c in self.getOrDefault("fills")]

    def _transform(self, df: DataFrame) -> DataFrame:
        fills, scales = self.getOrDefault("fills"), self.getOrDefault("scales")
        df = prep.apply_one_hot(df, self.getOrDefault("categories"))
        df = prep.apply_impute(inf_to_null(df, self.getOrDefault("output")), fills)
        return prep.apply_scale(df, {c: tuple(v) for c, v in scales.items()})


def sparse_one_hot(train: DataFrame, column: str, out: str, scaled: bool = True) -> list[Transformer]:
    """R5 for any number of categories, as fitted stages: text of the value, its
    index (alphabetical), a sparse 0/1 vector, and with ``scaled`` its entry over
    the deviation of that 0/1 column on the training rows.

    A null or a value the training rows did not have gives the zero vector.
    The categories and their counts are one row each on the driver, as in any
    indexer."""
    text, index, plain = f"_{column}_text", f"_{column}_index", f"_{column}_vector"
    name = column.replace("`", "``")
    counts = (train.groupBy(F.col(column).cast("string").alias("v")).agg(F.count(F.lit(1)).alias("n"))
              .orderBy("v").collect())  # one row per category
    rows, known = sum(r["n"] for r in counts), [r for r in counts if r["v"] is not None]
    if not known:
        raise ValueError(f"one-hot: no training value for column {column!r}")
    indexer = StringIndexerModel.from_labels([r["v"] for r in known], inputCol=text, outputCol=index, handleInvalid="keep")
    stages: list[Transformer] = [
        SQLTransformer(statement=f"SELECT *, CAST(`{name}` AS STRING) AS `{text}` FROM __THIS__"), indexer]
    sized = PipelineModel(stages=stages).transform(train.limit(0))  # the index column knows its size: no job
    encoder = OneHotEncoder(inputCol=index, outputCol=plain if scaled else out, dropLast=True).fit(sized)
    stages.append(encoder)  # the last index is "none of these"
    if scaled:
        spread = [(r["n"] / rows * (1 - r["n"] / rows)) ** 0.5 for r in known]
        stages.append(ElementwiseProduct(scalingVec=Vectors.dense([1 / s if s else 1.0 for s in spread]),
                                         inputCol=plain, outputCol=out))
    gone = ", ".join(f"`{c}`" for c in ([text, index, plain] if scaled else [text, index]))
    return [*stages, SQLTransformer(statement=f"SELECT * EXCEPT ({gone}) FROM __THIS__")]


class SeriesFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Daily rows to feature rows (calendar, lags, rolling, derived measures), as
    the full pipeline computes them, without a target and for every row.

    Frames count rows of a series, so the rows before a range that is to be
    scored must be there too: ``score_range`` adds just these."""

    task = Param(Params._dummy(), "task", "regression or classification", TypeConverters.toString)
    key = Param(Params._dummy(), "key", "series key column", TypeConverters.toString)
    time = Param(Params._dummy(), "time", "date column", TypeConverters.toString)

    BACK = 30  # rows before a range that its frames and lags reach

    @keyword_only
    def __init__(self, *, task: str = "classification", key: str = "series_key", time: str = "time"):
        super().__init__()
        self._setDefault(task="classification", key="series_key", time="time")
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        from dailyseries.plans.pipeline import known_features
        return known_features(df, *(self.getOrDefault(p) for p in ("task", "key", "time")))


def fit_scorer(daily: DataFrame, target: str, learner: Estimator, categorical: Iterable[str] = ("weather_code", "season"),
               strategy: str = "mean", method: str = "standard", task: str = "classification",
               sparse: Iterable[str] = ()) -> PipelineModel:
    """One model from daily rows to predictions: features, preparation, assembly
    and ``learner``, fitted on ``daily``, whose ``target`` is not null.

    Columns in ``sparse`` are encoded as scaled sparse vectors; they, like
    ``target``, are columns of ``daily``."""
    series = SeriesFeatures(task=task)
    rows = series.transform(daily).where(F.col(target).isNotNull()).persist(StorageLevel.DISK_ONLY)  # read once per fit
    try:
        left_out = {series.getOrDefault("key"), series.getOrDefault("time"), target, *categorical, *sparse}
        columns = [c for c in rows.columns if c not in left_out]
        prepared = Preparation(columns=columns, categorical=list(categorical), strategy=strategy, method=method).fit(rows)
        stages: list[Transformer] = [prepared]
        for c in sparse:
            stages += sparse_one_hot(rows, c, f"{c}_onehot")
        names = [*prepared.features(), *[f"{c}_onehot" for c in sparse]]
        stages.append(VectorAssembler(inputCols=names, outputCol=learner.getFeaturesCol(), handleInvalid="keep"))
        vectors = PipelineModel(stages=stages).transform(rows).select(learner.getFeaturesCol(), target)
        with packed(vectors) as table:
            return PipelineModel(stages=[series, *stages, learner.fit(table)])
    finally:
        rows.unpersist()


def score_range(model: PipelineModel, daily: DataFrame, start: str, end: str) -> DataFrame:
    """The rows of [start, end] through a ``fit_scorer`` model: its prepared
    columns and predictions, exactly as over the whole history.  Of the
    rows before ``start`` each series gives the few that the frames reach."""
    series = model.stages[0]
    key, time = (series.getOrDefault(p) for p in ("key", "time"))
    since, until = F.lit(start).cast("date"), F.lit(end).cast("date")
    lows = halo_bounds(daily, start, end, series.BACK, 0, key, time).select(key, "_lo")
    first = lows.agg(F.min("_lo")).first()[0]
    rows = daily.where((F.col(time) >= (F.lit(first) if first else since)) & (F.col(time) <= until))
    rows = join_groups(rows, lows, [key], "left").where(F.col(time) >= F.coalesce("_lo", since)).drop("_lo")
    return model.transform(rows).where(F.col(time) >= since)
