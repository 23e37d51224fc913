"""Near-duplicate documents by SimHash and meet-in-the-middle ball hashing.

A fingerprint has a bit set if more than half of the document's shingle hashes
have it set.  Two fingerprints differ in at most ``RADIUS`` = 2 bits if and
only if the balls of half that radius around them meet, so every distinct
fingerprint emits itself and its 64 one-bit variants, and the variants are
shuffled.

A variant and one flipped bit name the fingerprint that emitted it, so the
members of a variant are held as one 64-bit mask of flipped bits and a flag:
a buffer of fixed size that combines before the shuffle, and at most 65
members, whatever the number of documents.  Members of one variant are all
within the radius of each other; each is paired with the smallest one
only, the pairs are deduplicated and their distance is verified.

Equal fingerprints are one node from the start, so copies cost nothing more.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailyseries.llm.common import LOWER, arrow_batches, materialize, signed
from dailyseries.llm.components import connected_components

WIDTH = 3     # words in a shingle
RADIUS = 2    # most differing bits of a link
SEED = 42
BITS = 64
BLOCK = 1 << 15  # shingle hashes counted at a time


def shingle_hashes(text: str, width: int = WIDTH) -> Iterator[int]:
    """XXH64 of every ``width``-word shingle, repeats included, words joined by
    one space; of the whole sequence if there are fewer words."""
    words = text.encode().translate(LOWER).split()  # splits at [\x20\x09-\x0D]
    if not words:
        return iter(())
    joined = b" ".join(words)
    if len(words) <= width:
        return iter((xxhash.xxh64_intdigest(joined, SEED),))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-width] + 1)).tolist()
    digest = xxhash.xxh64_intdigest
    return (digest(joined[s:e], SEED) for s, e in zip(starts, ends[width - 1:].tolist(), strict=True))


def fingerprint(text: str | None, width: int = WIDTH) -> int:
    """Unsigned fingerprint of a text; 0 without words."""
    ones, n = np.zeros(BITS, np.int64), 0
    hashes = shingle_hashes(text or "", width)
    while len(block := np.fromiter(islice(hashes, BLOCK), "<u8")):
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(block)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprint_udf(width: int = WIDTH):
    @F.pandas_udf("long")
    def fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(signed(np.array([fingerprint(t, width) for t in texts], np.uint64)))

    return fingerprints


def variants(prints: DataFrame) -> DataFrame:
    """(v, flips, itself): the members of every variant ``v`` of the distinct
    fingerprints ``fp``; bit k of ``flips`` stands for v with bit k flipped,
    ``itself`` for v."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("k"))
    out = prints.select("fp", F.explode(F.sequence(F.lit(-1), F.lit(BITS - 1))).alias("k"))
    flip = F.when(F.col("k") >= 0, bit).otherwise(F.lit(0).cast("long"))
    return (out.select(F.col("fp").bitwiseXOR(flip).alias("v"), flip.alias("flip"), (F.col("k") < 0).alias("same"))
            .groupBy("v").agg(F.bit_or("flip").alias("flips"), F.bool_or("same").alias("itself")))


def ball_links(prints: DataFrame) -> DataFrame:
    """(a, b): distinct pairs of the distinct fingerprints ``fp``, at most
    ``RADIUS`` bits apart, that connect all that are linked: in every variant
    each member with the smallest one."""
    met = variants(prints).where(F.bit_count("flips") + F.col("itself").cast("int") > 1)
    shift = F.sequence(F.lit(0), F.lit(BITS - 1))
    on = F.filter(shift, lambda k: F.call_function("getbit", F.col("flips"), k) == 1)
    flipped = F.transform(on, lambda k: F.col("v").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), k)))
    members = F.concat(F.when(F.col("itself"), F.array("v")).otherwise(F.array().cast("array<bigint>")), flipped)
    pairs = (met.select(members.alias("m")).select(F.array_min("m").alias("a"), F.explode("m").alias("b"))
             .where("a <> b").distinct())
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS)


def near_duplicates(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp (the fingerprint as a signed
    long), component_id (smallest doc_id reachable over fingerprints at most
    two bits apart), kept (whether that is its own id).

    Words are runs without ``[\\x20\\x09-\\x0D]`` with A-Z lower-cased.  Null,
    empty and wordless texts have fingerprint 0, linked like any other.  A
    bit that exactly half of the hashes have is 0.  A very long text is
    hashed whole, a block of hashes at a time.  Rows that repeat or share a
    doc_id are each linked by their own text.  A null doc_id is never the
    smallest while another is in reach; among null ids only, component_id is
    null and the rows are kept.  Other columns are not read, whatever their
    names; an empty table gives no rows.
    """
    with arrow_batches(docs.sparkSession):
        rows = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                       fingerprint_udf(width)(F.col("text").cast("string")).alias("fp")), "sh-prints")
    nodes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "sh-nodes")
    links = materialize(ball_links(nodes), "sh-links")
    labels = connected_components(links)
    linked = nodes.join(labels, nodes["fp"] == labels["node"]).select("fp", "low", "label")
    lowest = linked.groupBy("label").agg(F.min("low").alias("component_id"))
    moved = linked.join(lowest, "label").select("fp", "component_id", F.lit(True).alias("linked"))
    of_print = (nodes.join(moved, "fp", "left")
                .select("fp", F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("low")).alias("component_id")))
    return (rows.join(of_print, "fp")
            .select("doc_id", "fp", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")))


def digest_columns(result: DataFrame) -> DataFrame:
    return result.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "kept")
