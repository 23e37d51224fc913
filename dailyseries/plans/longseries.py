"""Windows over very long series without one task per series.

A daily series is bounded by its calendar, but a series keyed coarsely
(or at a finer time grain) can hold a large share of all rows.  Then each
series is cut into buckets of ``bucket_rows`` consecutive rows; every
bucket also receives copies of the last ``back`` rows of the bucket before
it and the first ``fwd`` rows of the bucket after it (the halo), windows
run per (series, bucket), and only the bucket's own rows are kept.  Any
ROWS frame reaching at most ``back`` rows back and ``fwd`` rows ahead then
sees exactly the rows it would see in one giant partition.  Frames over
the whole partition (unbounded) are not allowed in this mode.

Row positions come from the distributed ``global_row_number`` over
(key, time); the per-series start is one small aggregate.  Rows with a null
key are one series, as in the plain window.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from dailyseries.plans.ranking import global_row_number, join_groups


def bucketed_series_frame(df: DataFrame, builder: Callable[[WindowSpec], dict[str, Column]],
                          key: str, time: str, back: int, fwd: int, bucket_rows: int = 100_000) -> DataFrame:
    if bucket_rows < max(back, fwd, 1):
        raise ValueError("bucket_rows must be at least the frame reach (back, fwd)")
    ranked, _ = global_row_number(df, [key, time], name="_grn")
    starts = ranked.groupBy(key).agg(F.min("_grn").alias("_start"))  # one row per series
    pos = F.col("_grn") - F.col("_start")
    r = join_groups(ranked, starts, [key]).withColumn("_pos", pos).withColumn("_b", F.floor(F.col("_pos") / bucket_rows))
    off = F.col("_pos") % bucket_rows
    copies = F.array(
        F.struct(F.col("_b").alias("_bucket"), F.lit(True).alias("_own")),
        F.when(off >= bucket_rows - back, F.struct((F.col("_b") + 1).alias("_bucket"), F.lit(False).alias("_own"))),
        F.when((off < fwd) & (F.col("_b") > 0), F.struct((F.col("_b") - 1).alias("_bucket"), F.lit(False).alias("_own"))))
    halo = (r.select(*df.columns, F.explode(F.filter(copies, lambda s: s.isNotNull())).alias("_c"))
              .select(*df.columns, "_c._bucket", "_c._own"))
    w = Window.partitionBy(key, "_bucket").orderBy(time)
    out = halo.withColumns(builder(w))
    return out.where(F.col("_own")).drop("_bucket", "_own")
