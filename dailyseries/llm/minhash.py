"""Near-duplicate documents by circulant MinHash.

Two permutations of the 64-bit shingle space make the whole signature: the
first scatters the shingles once, the second, shifted circularly by k, gives
coordinate k as the minimum of ``pi((sigma(x) - k) mod 2**64)``.  Signatures
are banded; a shared band makes documents candidates, and every link is
confirmed on the full shingle sets (exact Jaccard).

Links are searched without listing the pairs of a bucket:

* Equal sets are one class from the start.
* Each bucket's most central class (fewest shingles that no other candidate
  has) is compared with all others of the bucket.  That joins nearly all of a
  group with as many comparisons as members.
* What is left are pairs across components.  Shingles seen in one candidate
  only can't be shared, and per hash class of shingles no more can be shared
  than the smaller count; both bound the intersection from above.  Only pairs
  whose bound still reaches the threshold are compared, each in the first
  band it shares.

Both bounds are exact, so no link between candidates is lost.  With 32 bands
of 4 rows a pair at the threshold of 0.8 misses being a candidate with a
chance below 5e-8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailyseries.llm.common import (U, drop_table, materialize, maybe_in, mix64, path_of, shingle_sets, signed,
                                    small_batches)
from dailyseries.llm.components import connected_components

WIDTH = 5          # words in a shingle
PERCENT = 80       # least similarity of a link, in per cent
BANDS, ROWS = 32, 4
CLASSES = 256      # hash classes of the intersection bound
BLOCK = 1 << 14    # shingles hashed at a time: fits the cache


def sigma(x: np.ndarray) -> np.ndarray:
    """The first permutation, applied once to every shingle."""
    return mix64(x + U(0x9E3779B97F4A7C15))


def pi(x: np.ndarray) -> np.ndarray:
    """The second permutation; coordinate k shifts its argument by k."""
    x = x * U(0x9FB21C651E98DF25)
    x ^= x >> U(32)
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(29)
    x *= U(0xFF51AFD7ED558CCD)
    x ^= x >> U(32)
    return x


def signatures(sets: list[np.ndarray], size: int = BANDS * ROWS) -> np.ndarray:
    """(documents, size) minima; sets must not be empty."""
    out = np.full((len(sets), size), np.iinfo(np.uint64).max, np.uint64)
    todo, n = [], 0
    pieces = [(i, s[at:at + BLOCK]) for i, s in enumerate(sets) for at in range(0, len(s), BLOCK)]

    def flush() -> None:
        if not todo:
            return
        owner = np.array([i for i, _ in todo])
        starts = np.concatenate(([0], np.cumsum([len(p) for _, p in todo])[:-1]))
        x = sigma(np.concatenate([p for _, p in todo]))
        for k in range(size):
            low = np.minimum.reduceat(pi(x - U(k)), starts)
            np.minimum.at(out[:, k], owner, low)
        todo.clear()

    for piece in pieces:
        if n + len(piece[1]) > BLOCK:
            flush()
            n = 0
        todo.append(piece)
        n += len(piece[1])
    flush()
    return out


def band_keys(sig: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band; the band number is part of it."""
    acc = np.arange(1, bands + 1, dtype=np.uint64) * np.ones((len(sig), 1), np.uint64)
    for r in range(rows):
        acc = acc * U(0xC4CEB9FE1A85EC53) + sig[:, r::rows][:, :bands]
    return mix64(acc)


def set_keys(s: np.ndarray) -> tuple[int, int]:
    """A 128-bit key of a set."""
    with np.errstate(over="ignore"):
        a, b = mix64(s).sum(dtype=np.uint64), mix64(s ^ U(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    return int(signed(np.array([a]))[0]), int(signed(np.array([b]))[0])


def sketch_udf(width: int):
    @F.pandas_udf("n int, k1 long, k2 long, bands array<long>")
    def sketch(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            n, k1, k2, keys = [], [], [], []
            for at in range(0, len(texts), 256):
                sets = shingle_sets([b"" if t is None else t.encode() for t in texts.iloc[at:at + 256]], width)
                full = [s for s in sets if len(s)]
                bands = iter(signed(band_keys(signatures(full)))) if full else iter(())
                for s in sets:
                    a, b = set_keys(s) if len(s) else (0, 0)
                    n.append(len(s))
                    k1.append(a)
                    k2.append(b)
                    keys.append(next(bands) if len(s) else None)
            yield pd.DataFrame({"n": n, "k1": k1, "k2": k2, "bands": keys})

    return sketch


def shingles_udf(width: int):
    @F.pandas_udf("array<long>")
    def shingles(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([signed(s) for s in shingle_sets([b"" if t is None else t.encode() for t in texts], width)])

    return shingles


def class_counts_udf():
    @F.pandas_udf("array<int>")
    def class_counts(sets: pd.Series) -> pd.Series:
        return pd.Series([np.bincount(np.asarray(s, np.int64) & (CLASSES - 1), minlength=CLASSES).astype(np.int32)
                          for s in sets])

    return class_counts


def _bound(shared, n, m, percent: int):
    """Whether ``shared`` common members can make a link of sets of n and m."""
    return (100 + percent) * shared >= percent * (n + m)


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets, of n members each, are similar enough.

    ``s`` may lack members that no other set has: the intersection is the same."""
    left = sets.select(F.col("cid").alias("a"), F.col("n").alias("na"), F.col("s").alias("sa"))
    right = sets.select(F.col("cid").alias("b"), F.col("n").alias("nb"), F.col("s").alias("sb"))
    both = pairs.join(left, "a").join(right, "b")
    return (both.select("a", "b", "na", "nb", F.size(F.array_intersect("sa", "sb")).alias("i"))
            .where(_bound(F.col("i"), F.col("na"), F.col("nb"), percent)).select("a", "b"))


def link_classes(classes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(node, label): components of the classes (cid, n, rep, bands) that have
    any link; ``rep`` names one row of ``docs`` by doc_id and text hash."""
    rows = classes.select("cid", F.posexplode("bands").alias("band", "key"))
    crowded = rows.groupBy("band", "key").agg(F.count("*").alias("c")).where("c > 1").select("band", "key")
    buckets = materialize(rows.join(crowded, ["band", "key"]), "mh-buckets")

    # texts of the candidates only; a repeated row would merely weaken a bound below
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    wanted = (buckets.select("cid").distinct().join(classes, "cid")
              .select("cid", "n", F.col("rep.id").alias("r_id"), F.col("rep.th").alias("r_th")))
    wanted = materialize(wanted, "mh-wanted")
    texts = docs.select(docs["doc_id"].cast("long").alias("id"), F.xxhash64(text).alias("th"), text.alias("body"))
    maybe = maybe_in(wanted, F.xxhash64("r_id", "r_th"))
    texts = texts.where(maybe(F.xxhash64("id", "th")))
    held = texts.join(wanted, texts["id"].eqNullSafe(wanted["r_id"]) & (texts["th"] == wanted["r_th"]))
    raw = materialize(held.select("cid", "n", shingles_udf(width)("body").alias("s")), "mh-shingles")

    # shingles of one candidate only can't be shared: count them, and leave them out of comparisons
    alone = (raw.select("cid", F.explode("s").alias("h")).groupBy("h")
             .agg(F.count("*").alias("c"), F.min("cid").alias("cid")).where("c = 1")
             .groupBy("cid").agg(F.collect_list("h").alias("alone")))
    shared = F.array_except("s", F.coalesce("alone", F.array().cast("array<bigint>")))
    sets = raw.join(alone, "cid", "left").select("cid", "n", shared.alias("s"))
    sets = materialize(sets.select("cid", "n", "s", F.size("s").alias("m"), class_counts_udf()("s").alias("classes")),
                       "mh-sets")
    drop_table(raw.sparkSession, path_of(raw))
    stats = sets.select("cid", "n", "m").distinct()
    buckets = materialize(buckets.join(stats, "cid"), "mh-bucket-stats")

    # first links: each class with the most central class of its buckets
    central = F.struct(((F.col("n") - F.col("m")) / F.col("n")).alias("alone"), F.col("cid").alias("hub"),
                       F.col("n").alias("hn"), F.col("m").alias("hm"))
    hubs = buckets.groupBy("band", "key").agg(F.min(central).alias("hub"))
    best = buckets.join(hubs, ["band", "key"]).groupBy("cid", "n", "m").agg(F.min("hub").alias("h"))
    pairs = (best.where(F.col("cid") != F.col("h.hub"))
             .where(_bound(F.least("m", "h.hm"), F.col("n"), F.col("h.hn"), percent))
             .select(F.col("cid").alias("a"), F.col("h.hub").alias("b")))
    links = materialize(_verify(pairs, sets, percent), "mh-links")
    labels = connected_components(links)

    # all pairs across components that the bounds leave, each in its first shared band
    label = F.coalesce("label", "cid").alias("label")
    open_rows = buckets.join(labels, buckets["cid"] == labels["node"], "left").select(
        "band", "key", "cid", "n", "m", label)
    mixed = (open_rows.groupBy("band", "key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
             .where("lo <> hi").select("band", "key"))
    wide = (open_rows.join(mixed, ["band", "key"])
            .join(classes.select("cid", "bands"), "cid")
            .join(sets.select("cid", "classes").dropDuplicates(["cid"]), "cid"))
    wide = materialize(wide, "mh-open")
    x, y = wide.alias("x"), wide.alias("y")
    first = F.array_position(F.zip_with("x.bands", "y.bands", lambda u, v: u == v), True) == F.col("x.band") + 1
    most = F.aggregate(F.zip_with("x.classes", "y.classes", lambda u, v: F.least(u, v)), F.lit(0),
                       lambda acc, v: acc + v)
    n, m = F.col("x.n"), F.col("y.n")
    cross = x.join(y, (F.col("x.band") == F.col("y.band")) & (F.col("x.key") == F.col("y.key"))
                   & (F.col("x.cid") < F.col("y.cid")) & (F.col("x.label") != F.col("y.label"))
                   & _bound(F.least("x.m", "y.m"), n, m, percent) & first & _bound(most, n, m, percent))
    late = _verify(cross.select(F.col("x.cid").alias("a"), F.col("y.cid").alias("b")), sets, percent)
    late = materialize(late, "mh-late-links")
    if late.isEmpty():
        return labels
    return connected_components(links.unionByName(late))


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, th (hash of the text), n_shingles,
    component_id, label, kept.

    A document's set holds its distinct ``width``-word shingles (all its words
    as one if it has fewer); words are runs without ``[\\x20\\x09-\\x0D]``
    with A-Z lower-cased.  Documents whose sets have 100 * intersection >=
    ``percent`` * union are linked; component_id is the smallest doc_id
    reachable, label one value per component, for ids may be shared.  A null or
    wordless text has an empty set, is linked with nothing and is its own
    component; its label is null.  A null doc_id is linked by its text,
    never the smallest id while another exists, and kept only in a component
    of null ids.  Rows that share a doc_id are linked each by its own text.
    A very long text is hashed whole, a segment at a time.  An empty table
    gives no rows; other columns are not read, whatever their names.
    """
    small_batches(docs.sparkSession)
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(text).alias("th"),
                       sketch_udf(width)(text).alias("p"))
    rows = materialize(rows.select("doc_id", "th", "p.n", "p.k1", "p.k2", "p.bands"), "mh-sketches")
    classes = (rows.where("n > 0").groupBy("n", "k1", "k2")
               .agg(F.min("doc_id").alias("min_id"),
                    F.min(F.struct(F.col("doc_id").alias("id"), F.col("th").alias("th"))).alias("rep"),
                    F.first("bands").alias("bands")))
    classes = materialize(classes.withColumn("cid", F.monotonically_increasing_id()), "mh-classes")
    labels = link_classes(classes, docs, width, percent)
    named = classes.join(labels, classes["cid"] == labels["node"], "left").select(
        "n", "k1", "k2", "min_id", F.coalesce("label", "cid").alias("label"))
    lowest = named.groupBy("label").agg(F.min("min_id").alias("component_id"))
    named = named.join(lowest, "label").select("n", "k1", "k2", "component_id", "label")
    empty = rows.where("n = 0").select("doc_id", "th", "n", F.col("doc_id").alias("component_id"),
                                       F.lit(None).cast("long").alias("label"))
    full = rows.where("n > 0").join(named, ["n", "k1", "k2"]).select("doc_id", "th", "n", "component_id", "label")
    return full.unionByName(empty).select("doc_id", "th", F.col("n").cast("long").alias("n_shingles"), "component_id",
                                          "label", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``docs`` without the rows that are not kept: one document of each group
    stays, the one with the smallest doc_id.

    Only rows that may be dropped are joined; the others pass straight
    through.  Where several rows of a group have the kept doc_id, one with
    the smallest text hash stays; rows of other groups that share the id, or
    have none either, are not touched.  Documents without words all stay.
    """
    found = materialize(near_duplicates(docs, width, percent), "mh-result")
    heads = found.where("kept and n_shingles > 0")
    again = (heads.groupBy("label").agg(F.min("doc_id").alias("a_id"), F.min("th").alias("a_th"), F.count("*").alias("c"))
             .where("c > 1").select("label", "a_id", "a_th"))
    again = materialize(again, "mh-repeated")
    others = heads.join(again, "label").where("th <> a_th")
    gone = found.where("not kept").select(F.col("doc_id").alias("g_id"), F.col("th").alias("g_th"))
    gone = materialize(gone.union(others.select("doc_id", "th")).distinct(), "mh-dropped")
    cols = docs.columns
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.withColumns({"__id": F.col("doc_id").cast("long"), "__th": F.xxhash64(text)})
    suspects = gone.select(F.xxhash64("g_id", "g_th").alias("h")).union(again.select(F.xxhash64("a_id", "a_th").alias("h")))
    maybe = maybe_in(suspects, F.col("h"))
    clear = keyed.where(~maybe(F.xxhash64("__id", "__th"))).select(*cols)
    rest = keyed.where(maybe(F.xxhash64("__id", "__th")))
    rest = rest.join(gone, rest["__id"].eqNullSafe(gone["g_id"]) & (rest["__th"] == gone["g_th"]), "left_anti")
    repeated = rest["__id"].eqNullSafe(again["a_id"]) & (rest["__th"] == again["a_th"])
    # a text has one label, so equal (id, text) are rows of one group
    twice = rest.join(again, repeated, "left_semi").dropDuplicates(["__id", "__th"]).select(*cols)
    once = rest.join(again, repeated, "left_anti").select(*cols)
    return clear.unionByName(once).unionByName(twice)


def digest_columns(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "n_shingles", "component_id", "kept")
