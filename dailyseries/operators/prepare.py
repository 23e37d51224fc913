"""Feature preparation fitted on the training rows only.

Each ``fit_*`` (but the mode) aggregates the training rows to one
small row of parameters (like any Spark ML ``fit``); the matching
transform applies them as literals in a single projection over all rows,
so there is no join and no second pass per column.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dailyseries.functions.scalar import SEASONS, inf_to_null, numeric_columns
from dailyseries.plans.selection import column_quantiles

# fixed values: one-hot categories known up front (all emitted even if absent)
KNOWN_CATEGORIES = {"season": SEASONS}


def _train(df: DataFrame, split_col: str | None) -> DataFrame:
    return df.where(F.col(split_col) == "train") if split_col else df


def _check_fit(params: dict, on_empty: str, what: str) -> dict:
    empty = [c for c, v in params.items() if v is None]
    if empty and on_empty == "error":
        raise ValueError(f"{what}: no training value for columns {empty}")
    if on_empty == "drop":
        return {c: v for c, v in params.items() if v is not None}
    return params


STAT_NAMES = ["i", "rows", "count", "mean", "m2", "min", "max"]
STAT_TYPES = [pa.int32(), pa.int64(), pa.int64(), *[pa.float64()] * 4]


def _task_stats():
    """The ``mapInArrow`` function of :func:`column_stats`: one row per column with rows, values,
    mean, squared deviations from it, least and greatest value of the task."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: list[tuple] = []
        for batch in batches:
            total = total or [(i, 0, 0, None, None, None, None) for i in range(batch.num_columns)]
            for i, (_, rows, n, mean, m2, low, high) in enumerate(total):
                x = batch.column(i).drop_null().to_numpy(zero_copy_only=False)
                if len(x):
                    away = x - x[0]  # a constant column has exactly no spread
                    more, at = len(x), x[0] + away.mean()
                    dev, least, most = ((away - away.mean()) ** 2).sum(), np.fmin.reduce(x), np.fmax.reduce(x)
                    if n:
                        step = at - mean
                        at, dev = mean + step * more / (n + more), m2 + dev + step * step * n * more / (n + more)
                        least, most = np.fmin(low, least), np.fmax(high, most)
                    n, mean, m2, low, high = n + more, at, dev, least, most
                total[i] = (i, rows + batch.num_rows, n, mean, m2, low, high)
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*total), STAT_TYPES)], STAT_NAMES)

    return run


def column_stats(df: DataFrame, columns: Sequence[str], stats: Sequence[str]) -> dict[str, dict]:
    """Per-column statistics of the non-null values in ONE pass over the rows.

    Tasks take the rows as Arrow batches and give one row per column (count, mean
    and squared deviations from it); these are merged about the mean of all, so
    no sums of squares of far-off values cancel.
    ``stats`` from mean, count, rows, var_pop, min, max.
    """
    columns = list(columns)
    if not columns:
        return {}
    rows = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    parts = rows.mapInArrow(_task_stats(), "i int, rows bigint, count bigint, mean double, m2 double, min double, max double")
    column = Window.partitionBy("i")
    centre = F.sum(F.col("count") * F.col("mean")).over(column) / F.nullif(F.sum("count").over(column), F.lit(0))
    merged = parts.withColumn("centre", centre).groupBy("i").agg(
        F.sum("rows").alias("rows"), F.sum("count").alias("count"), F.first("centre").alias("mean"),
        F.sum(F.col("m2") + F.col("count") * (F.col("mean") - F.col("centre")) ** 2).alias("m2"),
        F.min("min").alias("min"), F.max("max").alias("max"))
    got = {r["i"]: r for r in merged.collect()}  # one row per column
    out = {}
    for i, c in enumerate(columns):
        one = got[i].asDict() if i in got else {"rows": 0, "count": 0, "mean": None, "min": None, "max": None}
        if one["count"]:
            same = one["min"] == one["max"]
            one |= {"mean": one["min"] if same else one["mean"], "var_pop": 0.0 if same else one["m2"] / one["count"]}
        out[c] = {s: one.get(s) for s in stats}
    return out


def fit_impute(df: DataFrame, columns: Sequence[str], strategy: str = "mean",
               split_col: str | None = "split", on_empty: str = "error") -> dict:
    """R1 fit: mean / median / most_frequent (ties -> smallest) per column."""
    tr = _train(df, split_col)
    columns = list(columns)
    if strategy == "mean":
        st = column_stats(tr, columns, ["mean"])
        params = {c: st[c]["mean"] for c in columns}
    elif strategy == "median":
        params = column_quantiles(tr, columns, 0.5)
    elif strategy == "most_frequent":
        params = _long_mode(tr, columns)
    else:
        raise ValueError("strategy must be 'mean', 'median' or 'most_frequent'")
    return _check_fit(params, on_empty, f"impute[{strategy}]")


def _long(tr: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Unpivot numeric columns to (column, value) rows, nulls dropped."""
    cols = [F.col(c).cast("double").alias(c) for c in columns]
    return (tr.select(*cols).unpivot([], list(columns), "column", "value")
              .where(F.col("value").isNotNull()))


def _long_mode(tr: DataFrame, columns: Sequence[str]) -> dict:
    counts = _long(tr, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("column").agg(
        F.max_by("value", F.struct(F.col("n"), -F.col("value"))).alias("mode"))
    got = {r["column"]: r["mode"] for r in best.collect()}  # one row per column
    return {c: got.get(c) for c in columns}


def apply_impute(df: DataFrame, params: dict) -> DataFrame:
    """Fill nulls; imputed columns come out as doubles (as the reference's float matrix)."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(float(v)))
                           for c, v in params.items() if v is not None})


def impute(df: DataFrame, columns: Sequence[str] | None = None, strategy: str = "mean",
           split_col: str | None = "split", on_empty: str = "error") -> DataFrame:
    """Impute with train statistics; NaN/inf become null first."""
    columns = list(columns) if columns is not None else _features(df, split_col)
    df = inf_to_null(df, columns)
    params = fit_impute(df, columns, strategy, split_col, on_empty)
    return apply_impute(df, params)


def fit_scale(df: DataFrame, columns: Sequence[str], method: str = "standard",
              split_col: str | None = "split") -> dict:
    """R2/R3 fit: (center, divisor) per column; divisor 1 when the spread is 0."""
    if method not in ("standard", "minmax"):
        raise ValueError("Method must be 'standard' or 'minmax'")
    stats = ["mean", "var_pop"] if method == "standard" else ["min", "max"]
    st = column_stats(_train(df, split_col), columns, stats)
    out = {}
    for c in columns:
        if method == "standard":
            a, v = st[c]["mean"], st[c]["var_pop"]
            b = v ** 0.5 if v is not None else None
        else:
            a, hi = st[c]["min"], st[c]["max"]
            b = hi - a if a is not None else None
        out[c] = (a, 1.0 if not b else b)
    return out


def apply_scale(df: DataFrame, params: dict) -> DataFrame:
    return df.withColumns({c: (F.col(c) - F.lit(a)) / F.lit(b) for c, (a, b) in params.items()
                           if a is not None})


def scale(df: DataFrame, columns: Sequence[str] | None = None, method: str = "standard",
          split_col: str | None = "split") -> DataFrame:
    """Standard (population std) or min-max scaling fitted on train;
    NaN/inf to null first (R4); nulls stay null."""
    columns = list(columns) if columns is not None else _features(df, split_col)
    df = inf_to_null(df, columns)
    return apply_scale(df, fit_scale(df, columns, method, split_col))


def fit_impute_scale(df: DataFrame, columns: Sequence[str], method: str = "standard",
                     split_col: str | None = "split", on_empty: str = "error") -> tuple[dict, dict]:
    """Mean imputation followed by scaling, fitted in ONE job.

    Filling with the mean keeps the mean, min and max; the population
    variance over n rows of which k were non-null becomes var_k * k / n.
    """
    if method not in ("standard", "minmax"):
        raise ValueError("Method must be 'standard' or 'minmax'")
    extra = ["var_pop"] if method == "standard" else ["min", "max"]
    st = column_stats(_train(df, split_col), columns, ["mean", "count", "rows"] + extra)
    imp = _check_fit({c: st[c]["mean"] for c in columns}, on_empty, "impute[mean]")
    sc: dict = {}
    for c in imp:
        k, n = st[c]["count"], st[c]["rows"]
        if method == "standard":
            v = st[c]["var_pop"]
            sd = (v * k / n) ** 0.5 if (v is not None and k and n) else None
            sc[c] = (st[c]["mean"], 1.0 if not sd else sd)
        else:
            lo, hi = st[c]["min"], st[c]["max"]
            rng = (hi - lo) if lo is not None else None
            sc[c] = (lo, 1.0 if not rng else rng)
    return imp, sc


def _features(df: DataFrame, split_col: str | None) -> list[str]:
    return [c for c in numeric_columns(df) if c != split_col]


def fit_one_hot(df: DataFrame, columns: Iterable[str], categories: dict | None = None) -> dict[str, list]:
    """R5 fit: sorted observed values per column (known lists used as given).

    One distinct job for all columns together; values keep their type, NaN is
    a missing value.  Every category becomes a column, so this is for columns
    with few categories; ``one_hot_vector`` takes any number of them."""
    known = dict(KNOWN_CATEGORIES)
    known.update(categories or {})
    present = [c for c in columns if c in df.columns]
    fit = {c: list(known[c]) for c in present if c in known}
    todo = [c for c in present if c not in fit]
    if todo:
        types = dict(df.dtypes)

        def parts(c: str) -> Column:
            whole = types[c] in ("int", "bigint", "smallint", "tinyint")
            real = types[c] in ("double", "float")
            x = F.when(~F.isnan(c), F.col(c)) if real else F.col(c)
            none = F.lit(None)
            return F.struct(F.lit(c).alias("column"), (x if whole else none).cast("bigint").alias("i"),
                            (x if real else none).cast("double").alias("d"),
                            (none if whole or real else x).cast("string").alias("s"))

        seen = df.select(F.inline(F.array(*[parts(c) for c in todo]))).distinct()
        vals: dict[str, list] = {c: [] for c in todo}
        for column, *typed in seen.collect():  # one row per category
            vals[column] += [v for v in typed if v is not None]
        fit.update({c: sorted(v) for c, v in vals.items()})
    return {c: fit[c] for c in present}  # encoded in the order given


def one_hot_vector(df: DataFrame, column: str, out: str, split_col: str | None = "split") -> DataFrame:
    """R5 for any number of categories: one sparse vector column instead of a
    column per category.  Indices are fitted on the training rows; null and
    unseen values give the zero vector."""
    text = f"_{column}_text"
    data = df.withColumn(text, F.col(column).cast("string"))
    index = StringIndexer(inputCol=text, outputCol=f"_{column}_index", handleInvalid="keep",
                          stringOrderType="alphabetAsc").fit(_train(data, split_col))
    encoder = OneHotEncoder(inputCol=f"_{column}_index", outputCol=out, dropLast=True)  # the last is "invalid"
    indexed = index.transform(data)
    return encoder.fit(indexed).transform(indexed).drop(text, f"_{column}_index")


def apply_one_hot(df: DataFrame, fit: dict[str, list]) -> DataFrame:
    """R5 transform: ``{col}_{value}`` 0/1 ints at the end, original dropped,
    null -> all zeros.  One projection."""
    keep = [F.col(c) for c in df.columns if c not in fit]
    dummies: list[Column] = []
    for c, values in fit.items():
        for v in values:
            dummies.append(F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{c}_{v}"))
    return df.select(*keep, *dummies)


def one_hot(df: DataFrame, columns: Iterable[str] = ("weather_code", "season"),
            categories: dict | None = None) -> DataFrame:
    """``encode_categorical_features``; absent columns are skipped."""
    return apply_one_hot(df, fit_one_hot(df, columns, categories))
