"""Distributed order-dependent helpers (X2 and friends).

A window with ``orderBy`` but no ``partitionBy`` runs in ONE task
(``Exchange SinglePartition``).  These helpers give the same answers with
the work spread over the cluster:

* ``running_sum`` -- cumulative sums over a sorted key: value buckets from
  approximate quantiles (balanced, deterministic, value-based), one window
  per bucket, plus a tiny per-bucket offset table.
* ``exact_quantiles`` -- exact linear-interpolation percentiles (pandas /
  numpy / ``quantile_cont``) as order statistics found through
  ``running_sum`` over the distinct values; no per-group value map.
* ``global_row_number`` -- 1-based position in a total order: range
  partitioning, a per-partition position, and per-partition offsets.  The
  ranked frame is checkpointed to the shared folder so positions are fixed
  across retries and lost executors.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dailyseries.session import checkpoint_dir

_LOW_BITS = (1 << 33) - 1  # monotonically_increasing_id: partition id << 33 | position
BUCKET_VALUES = 500_000  # distinct values per bucket of a running sum
MIN_BUCKETS = 8


def default_buckets(rows: int) -> int:
    """Buckets by the number of distinct values, not by a cluster setting."""
    return max(MIN_BUCKETS, -(-rows // BUCKET_VALUES))


def value_buckets(df: DataFrame, col: str, buckets: int, by: Sequence[str] = (),
                  out: str = "_bkt") -> DataFrame:
    """Tag rows with a value bucket from approximate quantiles of ``col``
    (per ``by`` group when given), so each (group, bucket) holds a similar
    share of the rows."""
    by = list(by)
    probs = [i / buckets for i in range(1, buckets)]
    if not by:
        qs = df.approxQuantile(col, probs, 1.0 / (4 * buckets)) if buckets > 1 else []
        splits = [float("-inf")] + sorted({q for q in qs if q == q}) + [float("inf")]
        src = df.withColumn(col, F.col(col).cast("double")) if dict(df.dtypes)[col] != "double" else df
        return Bucketizer(splits=splits, inputCol=col, outputCol=out, handleInvalid="keep").transform(src)
    # per-group bounds: one grouped percentile_approx (B values per group)
    bounds = df.groupBy(*by).agg(F.percentile_approx(F.col(col).cast("double"), probs, 1000)
                                  .alias("_bounds"))
    j = join_groups(df, bounds, by)
    bkt = F.size(F.filter(F.col("_bounds"), lambda b: b <= F.col(col))).cast("double")
    return j.withColumn(out, bkt).drop("_bounds")


def running_sum(df: DataFrame, order_col: str, sum_cols: Sequence[str], by: Sequence[str] = (),
                suffix: str = "_before", buckets: int | None = None,
                prev_cols: Sequence[str] = ()) -> DataFrame:
    """Add ``{c}{suffix}`` = sum of ``c`` over rows of the same ``by`` group
    with a smaller ``order_col`` (exclusive), and ``_prev_{c}`` = the value
    of ``c`` on the previous row in that order for each ``prev_cols``.
    ``(by, order_col)`` must be unique (aggregate first).

    ``df`` is checkpointed once: the bounds, the bucket totals and the windows
    all read it.  A null group is a group like any other."""
    by = list(by)
    checkpoint_dir(df.sparkSession)
    df = df.checkpoint(eager=True)
    b = value_buckets(df, order_col, buckets or default_buckets(df.count()), by)
    per_bucket = [F.sum(c).alias(c) for c in sum_cols]
    if prev_cols:
        per_bucket.append(F.max_by(F.struct(*prev_cols), F.col(order_col)).alias("_last"))
    tot = b.groupBy(*by, "_bkt").agg(*per_bucket)
    wb = Window.partitionBy(*by).orderBy("_bkt")
    before = wb.rowsBetween(Window.unboundedPreceding, -1)
    off_cols = [F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_off_{c}") for c in sum_cols]
    if prev_cols:
        off_cols.append(F.lag("_last", 1).over(wb).alias("_prev_last"))
    off = tot.select(*by, "_bkt", *off_cols)
    wo = Window.partitionBy(*by, "_bkt").orderBy(order_col)
    w = wo.rowsBetween(Window.unboundedPreceding, -1)
    add = {f"_in_{c}": F.coalesce(F.sum(c).over(w), F.lit(0)) for c in sum_cols}
    add.update({f"_lag_{c}": F.lag(c, 1).over(wo) for c in prev_cols})
    add["_first"] = F.row_number().over(wo) == 1
    within = b.withColumns(add)
    j = join_groups(within, off, [*by, "_bkt"])
    outs = [(F.col(f"_off_{c}") + F.col(f"_in_{c}")).alias(f"{c}{suffix}") for c in sum_cols]
    outs += [F.when(F.col("_first"), F.col(f"_prev_last.{c}")).otherwise(F.col(f"_lag_{c}")).alias(f"_prev_{c}")
             for c in prev_cols]
    return j.select(*df.columns, *outs)


def exact_quantiles(df: DataFrame, col: str, probs: Iterable[float], by: Sequence[str] = (),
                    buckets: int | None = None) -> DataFrame:
    """Exact percentiles with linear interpolation between order statistics.

    Returns one row per (by..., q) with ``value``; null when the group has
    no non-null value.  Work: one aggregation to distinct values, one
    bucketed running count, and a join against the (tiny) target ranks.
    """
    by = list(by)
    probs = [float(q) for q in probs]
    vals = df.where(F.col(col).isNotNull()).select(*by, F.col(col).cast("double").alias("_v"))
    counts = vals.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_c"))
    cum = running_sum(counts, "_v", ["_c"], by, buckets=buckets)  # adds _c_before
    n = counts.groupBy(*by).agg(F.sum("_c").alias("_n"))
    # every group gets the fixed list of target ranks (2 per prob)
    tq = F.explode(F.array(*[F.struct(F.lit(i).alias("_qi"), F.lit(q).alias("q"))
                             for i, q in enumerate(probs)])).alias("t")
    targets = (n.select(*by, "_n", tq).select(*by, "_n", "t._qi", "t.q")
                .withColumn("_pos", (F.col("_n") - 1) * F.col("q"))
                .withColumn("_lo", F.floor("_pos")).withColumn("_hi", F.ceil("_pos")))
    long_t = targets.select(*by, "_qi", "q", "_pos", "_lo", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("_lo").alias("k")),
        F.struct(F.lit(1).alias("side"), F.col("_hi").alias("k")))).alias("t"))
    long_t = long_t.select(*by, "_qi", "q", "_pos", "_lo", "t.side", "t.k")
    if not by:
        long_t = F.broadcast(long_t)  # 2 * len(probs) rows: a proven bound
    cum = cum.select(*[F.col(c).alias(f"_by_{c}") for c in by], "_v", "_c", "_c_before")
    cond = [long_t[c].eqNullSafe(cum[f"_by_{c}"]) for c in by] + [
        cum["_c_before"] <= long_t["k"], long_t["k"] < cum["_c_before"] + cum["_c"]]
    hit = long_t.join(cum, cond).select(*[long_t[c] for c in by], "_qi", "q", "_pos", "_lo", "side", "_v")
    piv = hit.groupBy(*by, "_qi", "q", "_pos", "_lo").agg(
        F.max(F.when(F.col("side") == 0, F.col("_v"))).alias("_a"),
        F.max(F.when(F.col("side") == 1, F.col("_v"))).alias("_b"))
    frac = F.col("_pos") - F.col("_lo")
    return piv.select(*by, "q", (F.col("_a") + frac * (F.col("_b") - F.col("_a"))).alias("value"))


def quantile_row(df: DataFrame, col: str, probs: Sequence[float], names: Sequence[str],
                 by: Sequence[str] = ()) -> DataFrame:
    """``exact_quantiles`` pivoted to one row per group: one column per prob."""
    by = list(by)
    q = exact_quantiles(df, col, probs, by)
    return q.groupBy(*by).agg(*[F.max(F.when(F.col("q") == float(p), F.col("value"))).alias(nm)
                                for p, nm in zip(probs, names)])


def global_row_number(df: DataFrame, order_cols: Sequence[str], name: str = "rn",
                      partitions: int | None = None) -> tuple[DataFrame, int]:
    """``row_number() over (order by order_cols)`` without a single-task
    window.  Returns (ranked frame, row count).

    Range partitioning spreads the rows, each task numbers its own sorted
    partition, and a per-partition offset (a table of one row per partition)
    makes the numbers global.  The ranked frame
    is checkpointed to the shared folder first, so partition contents and
    positions cannot change between counting and use (retries, lost
    executors).  Ties in ``order_cols`` get an arbitrary but fixed order;
    end with a unique key for a deterministic answer.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    # without a fixed count AQE may coalesce the range partitions to the data
    # size; positions are taken after that read, so they stay consistent
    ranged = df.repartitionByRange(partitions, *order_cols) if partitions else df.repartitionByRange(*order_cols)
    ranged = ranged.sortWithinPartitions(*order_cols).withColumn("_mid", F.monotonically_increasing_id())
    ranged = ranged.checkpoint(eager=True)
    pid = F.shiftright(F.col("_mid"), 33)
    sizes = sorted((r[0], r[1]) for r in ranged.groupBy(pid).count().collect())  # one row per partition
    offsets, total = [], 0
    for p, c in sizes:
        offsets.append((p, total))
        total += c
    local = F.col("_mid").bitwiseAND(F.lit(_LOW_BITS)) + 1
    table = spark.createDataFrame(offsets, "_pid bigint, _off bigint")
    j = ranged.withColumn("_pid", pid).join(F.broadcast(table), "_pid")
    return ranked_select(j, df.columns, F.col("_off") + local, name), total


def ranked_select(df: DataFrame, columns: Sequence[str], rn, name: str) -> DataFrame:
    return df.select(*columns, rn.alias(name))


def join_groups(a: DataFrame, b: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """Attach per-group results ``b`` (one row per ``by`` group) to ``a``.

    Without group columns ``b`` is a single aggregate row: it becomes one
    scalar subquery (computed once, used as a constant), not a join."""
    by = list(by)
    if by:  # null-safe: a null group keeps its rows, as in GROUP BY
        b = b.select(*[F.col(c).alias(f"_by_{c}") if c in by else F.col(c) for c in b.columns])
        same = reduce(and_, [a[c].eqNullSafe(b[f"_by_{c}"]) for c in by])
        return a.join(b, same, how).drop(*[f"_by_{c}" for c in by])
    s = b.select(F.struct(*b.columns).alias("_s")).scalar()
    return a.withColumn("_s", s).select(*a.columns, *[F.col(f"_s.{c}").alias(c) for c in b.columns])


SMALL_GROUPS = 100_000  # groups that are sent to every task


def join_counted(a: DataFrame, b: DataFrame, by: Sequence[str]) -> DataFrame:
    """``join_groups`` of many rows ``a`` with few groups ``b``.

    ``b`` is taken once and counted: up to ``SMALL_GROUPS`` rows go to every
    task, so ``a`` is not shuffled on its few keys; more are joined by key."""
    if not by:
        return join_groups(a, b, by)
    checkpoint_dir(b.sparkSession)
    b = b.checkpoint(eager=True)
    return join_groups(a, F.broadcast(b) if b.count() <= SMALL_GROUPS else b, by)
