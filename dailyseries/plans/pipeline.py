"""The full daily-series feature pipeline as one composed DataFrame plan.

scan -> target (lead) -> calendar (+keep list) -> lags -> rolling (W4-W8)
-> advanced block (F19) -> one-hot (R5) -> chronological split (L1)
-> mean imputation (R1) -> standard scaling (R2).

The window stages share one distribution (hash on ``series_key``): after
the target's ``lead`` and its null filter, every later window reuses that
exchange.  Output: ONE table with ``split``, the target and the features
(no positionally aligned X/y frames).

``leak_safe=True`` (default) removes the reference's three leaks:
``rain_in_future`` is dropped, regression lags are lags of the target
that are already known (lag n of the h-day target is taken n + h - 1 rows
back), and one-hot categories are fitted on training rows only.
``leak_safe=False`` reproduces the reference.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailyseries.operators import features as feat
from dailyseries.operators import prepare as prep
from dailyseries.operators import splits as spl
from dailyseries.operators import windows as win
from dailyseries.operators.windows import KEY, TIME


# cached frames live on executor disk, never pinned in the heap
PERSIST_LEVEL = StorageLevel.DISK_ONLY
# keep the daily input too, so the raw table is scanned once per pipeline
PERSIST_INPUT = True


def build_features(dw: DataFrame, task: str = "regression", target_name: str | None = None,
                   keep_columns: Sequence[str] | None = None, leak_safe: bool = True,
                   key: str = KEY, time: str = TIME, strategy: str = "series",
                   keys: list[DataFrame] | None = None) -> tuple[DataFrame, str]:
    """Stages up to (not including) one-hot; returns (frame, target name).

    A narrow frame of the same rows without the features (key, time, weather code)
    is appended to ``keys``, if one can be read without making these.

    ``strategy`` as in ``windows.series_frame``.  A daily series has one row
    per calendar day, which bounds its length; "bucketed" is for finer grains."""
    if task not in ("regression", "classification"):
        raise ValueError("task_type must be 'regression' or 'classification'")
    target = target_name or ("precip_3day_next" if task == "regression" else "target_rain")
    if task == "regression":
        df = win.regression_target(dw, name=target, key=key, time=time, strategy=strategy)
    else:
        df = win.classification_target(dw, name=target, keep_future=not leak_safe, key=key, time=time,
                                       strategy=strategy)
    df = feat.temporal_features(df, keep_columns, time=time)
    if key not in df.columns:  # a keep list may drop the key; it is the row identity
        raise ValueError(f"keep_columns must not remove {key!r}")

    def stage(w):
        out = {}
        if task == "regression":
            back = 2 if leak_safe else 0  # horizon - 1
            out.update({f"lag{n}": F.lag(target, n + back).over(w) for n in (1, 2)})
        else:
            out.update(win.lag_cols(w, "rain_sum", (1, 2, 3, 7)))
        out.update(win.rolling_precip_cols(w))
        out.update(feat.advanced_cols(w))
        return out

    if strategy != "series":
        return win.series_frame(df, stage, key, time, back=29, strategy=strategy), target
    if keys is not None:  # batches take every column: the narrow frame before them has the same rows
        keys.append(df.select(key, time, *[c for c in ("weather_code", "season") if c in df.columns]))
    return _with_rolling(df, stage(win.series_window(key, time)), key, time), target


def _with_rolling(df: DataFrame, cols: dict, key: str, time: str) -> DataFrame:
    """``cols`` added in their order: window functions for what looks at one row,
    batches of sorted rows for the rolling statistics among them."""
    rolling = win.rolling_precip_stats() + win.rolling_weather_stats()
    names = [*df.columns, *[c for c in cols if c not in df.columns]]
    made = {name for name, *_ in rolling} | {"temp_anomaly"}
    out = win.trailing_stats(df.withColumns({n: c for n, c in cols.items() if n not in made}), rolling, key, time)
    out = out.withColumn("temp_anomaly", F.col("temperature_2m_max") - F.col("temperature_2m_max_30d_mean"))
    return out.select(*names)


def known_features(dw: DataFrame, task: str = "classification", key: str = KEY, time: str = TIME) -> DataFrame:
    """Every row of ``dw`` with the features that are known on its day; other
    columns pass through.  No target is needed and no row goes, so new rows
    get what rows of the same history got when a model was fitted.

    The regression task's lags are those of the 3-day sum that is known then:
    the sum of the last three days, and the one before it."""
    if task not in ("regression", "classification"):
        raise ValueError("task_type must be 'regression' or 'classification'")

    def stage(w):
        if task == "regression":
            x = "precipitation_sum"
            sums = {n: sum((F.lag(x, n - 1 + i).over(w) for i in (1, 2)), F.lag(x, n - 1).over(w)) for n in (1, 2)}
            out = {f"lag{n}": s for n, s in sums.items()}
        else:
            out = win.lag_cols(w, "rain_sum", (1, 2, 3, 7))
        return out | win.rolling_precip_cols(w) | feat.advanced_cols(w)

    return _with_rolling(feat.temporal_features(dw, time=time), stage(win.series_window(key, time)), key, time)


def feature_pipeline(dw: DataFrame, task: str = "regression", target_name: str | None = None,
                     keep_columns: Sequence[str] | None = None, leak_safe: bool = True,
                     train_ratio: float = 0.7, val_ratio: float = 0.15, impute_strategy: str = "mean",
                     scale_method: str = "standard", key: str = KEY, time: str = TIME,
                     persist: bool = True, strategy: str = "series",
                     persisted: list[DataFrame] | None = None,
                     sparse: Sequence[str] = ()) -> tuple[DataFrame, list[str], str]:
    """Returns (table with split/target/features, feature names, target name).

    The daily input is persisted (to executor disk, by series and in order of
    time), so the raw table is scanned, aggregated and shuffled once.  The
    features, seven times as wide, are never kept: the split and the one-hot
    categories read the narrow frame under them, the impute/scale statistics
    and the result compute them, without a shuffle.  The "bucketed" strategy
    has no narrow frame and copies rows between buckets; its features are
    persisted.  A lost block is recomputed from lineage.
    Columns of ``dw`` in ``sparse`` may have any number of categories: each comes
    out as one scaled sparse vector ``{column}_onehot`` beside the features,
    fitted on the training rows and never filled in.
    Frames that were persisted are appended to ``persisted``, for the caller
    to ``unpersist`` when done.
    """
    handles = persisted if persisted is not None else []
    if persist and PERSIST_INPUT:
        # the split ranking and the window stage read the daily input: keep it
        # (on disk) so the raw scan and the daily pre-aggregation run once;
        # AQE sizes the partitions of the cached plan
        if strategy == "series":  # the windows find their rows together and in order
            dw = dw.repartition(key).sortWithinPartitions(key, time)
        dw = dw.persist(PERSIST_LEVEL)
        handles.append(dw)
    narrow: list[DataFrame] = []
    df, target = build_features(dw, task, target_name, keep_columns, leak_safe, key, time, strategy, narrow)
    # the split's narrow ranking pass (key, time only) also gives the row count
    cuts = spl.Cuts((narrow[0] if narrow else df).select(key, time), (time, key))
    if persist and not narrow:
        df = df.persist(PERSIST_LEVEL)
        handles.append(df)
    cats = [c for c in ("weather_code", "season") if c in df.columns]

    def split(rows: DataFrame) -> DataFrame:
        return spl.chrono_split(rows, train_ratio, val_ratio, order_cols=(time, key), key=key, time=time, cuts=cuts)

    seen = narrow[0] if narrow else df
    if leak_safe:
        rows = split(seen)
        fit = prep.fit_one_hot(rows.where(rows["split"] == "train"), cats)
        df = prep.apply_one_hot(split(df), fit)
    else:
        df = split(prep.apply_one_hot(df, prep.fit_one_hot(seen, cats)))
    features = [c for c in df.columns if c not in (key, time, target, "split", *sparse)]
    from dailyseries.functions.scalar import inf_to_null
    df = inf_to_null(df, features)
    if impute_strategy == "mean":  # one fit pass for both steps (X4)
        imp, sc = prep.fit_impute_scale(df, features, scale_method, "split")
        df = prep.apply_scale(prep.apply_impute(df, imp), sc)
    else:
        df = prep.impute(df, features, impute_strategy, "split")
        df = prep.scale(df, features, scale_method, "split")
    vectors = [f"{c}_onehot" for c in sparse]
    if sparse:
        from dailyseries.operators.preprocess import sparse_one_hot
        train = df.where(F.col("split") == "train")
        df = PipelineModel(stages=[s for c, v in zip(sparse, vectors) for s in sparse_one_hot(train, c, v)]).transform(df)
    return df.select(key, time, "split", target, *features, *vectors), features, target
