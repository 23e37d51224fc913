"""Connected components of a link table, by repeated random contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailyseries.llm.common import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b); nodes share a label
    if and only if links connect them.

    In each round every node points to the neighbour (or itself) with the
    smallest salted hash, pointers are shortened, and the graph is rebuilt over
    the targets.  A new salt per round shrinks any shape, long chains included,
    by a constant factor in expectation.  All steps are aggregations that
    combine before the shuffle, and plain joins.
    """
    e = materialize(edges.select("a", "b").where("a <> b").distinct(), "cc-edges")
    labels = materialize(e.select(F.col("a").alias("node")).union(e.select("b")).distinct()
                         .withColumn("label", F.col("node")), "cc-labels")
    salt = 0
    while not e.isEmpty():
        both = e.union(e.select("b", "a"))
        low = F.min(F.struct(F.xxhash64(F.lit(salt), F.col("b")).alias("h"), F.col("b").alias("id")))
        up = (both.groupBy("a").agg(low.alias("m"))
              .select(F.col("a").alias("node"), F.when(
                  F.struct(F.xxhash64(F.lit(salt), F.col("a")).alias("h"), F.col("a").alias("id")) < F.col("m"),
                  F.col("a")).otherwise(F.col("m.id")).alias("up")))
        up = materialize(up, f"cc-up-{salt}")
        over = up.select(F.col("node").alias("mid"), F.col("up").alias("top"))
        up2 = materialize(up.join(over, up["up"] == over["mid"]).select("node", F.col("top").alias("up")),
                          f"cc-jump-{salt}")
        to = up2.select(F.col("node").alias("was"), F.col("up").alias("now"))
        e = materialize(
            e.join(to, e["a"] == to["was"]).select(F.col("now").alias("a"), "b")
            .join(to, F.col("b") == to["was"]).select("a", F.col("now").alias("b"))
            .where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
            f"cc-edges-{salt}")
        labels = materialize(labels.join(to, labels["label"] == to["was"], "left")
                             .select("node", F.coalesce("now", "label").alias("label")), f"cc-labels-{salt}")
        salt += 1
    return labels
