"""Token counts: an exact length histogram with suffix sums.

Documents are encoded once and reduced to one row per encoded length.  Two
running sums from the long end (documents and tokens at or above each length)
then answer every question about context limits without another pass over the
corpus: totals, quantiles, and what remains after cutting at any limit.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dailyseries.llm.common import small_batches

BAND = 1024  # lengths per band of the two-level sums

_ENCODERS: dict[str, object] = {}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def encoder(path: str):
    """The byte-level BPE encoder of a vocabulary file; loaded once per worker."""
    if path not in _ENCODERS:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODERS[path] = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                            special_tokens={})
    return _ENCODERS[path]


def with_length(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``docs`` with n_tokens (long) added; a null or empty text has none.
    Special-token strings in a text count as ordinary text."""
    small_batches(docs.sparkSession)
    path = vocabulary or default_vocabulary()

    @F.pandas_udf("long")
    def length(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoder(path).encode_ordinary
        for texts in batches:
            yield pd.Series([len(encode(t)) if t else 0 for t in texts], dtype="int64")

    return docs.withColumn("n_tokens", length(F.col("text").cast("string")))


def histogram(lengths: DataFrame) -> DataFrame:
    """(length, n_docs) from rows with n_tokens; the only shuffle, one row per
    length and task."""
    return lengths.groupBy(F.col("n_tokens").alias("length")).agg(F.count("*").alias("n_docs"))


def suffix_sums(hist: DataFrame) -> DataFrame:
    """One row per distinct length L: n_docs, docs and tokens at or above L,
    all docs and tokens, and the tokens left after cutting every document at L.

    Sums run within bands of ``BAND`` lengths, then over one row per band, so
    no window holds all lengths.
    """
    banded = hist.withColumn("band", F.floor(F.col("length") / BAND))
    down = Window.partitionBy("band").orderBy(F.desc("length"))
    own = banded.withColumns({"d": F.sum("n_docs").over(down),
                              "t": F.sum(F.col("n_docs") * F.col("length")).over(down)})
    totals = (banded.groupBy("band").agg(F.sum("n_docs").alias("bd"),
                                         F.sum(F.col("n_docs") * F.col("length")).alias("bt")))
    above = Window.orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select("band", F.coalesce(F.sum("bd").over(above), F.lit(0)).alias("od"),
                            F.coalesce(F.sum("bt").over(above), F.lit(0)).alias("ot"),
                            F.sum("bd").over(all_rows).alias("all_docs"), F.sum("bt").over(all_rows).alias("all_tokens"))
    s = own.join(offsets, "band").withColumns({"docs_from": F.col("od") + F.col("d"),
                                               "tokens_from": F.col("ot") + F.col("t")})
    return s.select("length", "n_docs", "docs_from", "tokens_from", "all_docs", "all_tokens",
                    (F.col("all_tokens") - F.col("tokens_from") + F.col("docs_from") * F.col("length"))
                    .alias("tokens_cut_here"),
                    ((F.col("all_docs") - F.col("docs_from") + F.col("n_docs")) / F.col("all_docs"))
                    .alias("share_up_to"))


def truncated_totals(sums: DataFrame, limits: list[int]) -> DataFrame:
    """(limit, tokens) kept when every document is cut at each limit, for any
    limits: the row of the smallest length at or above the limit has all the
    documents that are cut.  Above the longest document, everything is kept."""
    spark = sums.sparkSession
    asked = spark.createDataFrame([(int(x),) for x in sorted(set(limits))], "limit long")
    per = [F.struct(F.lit(int(x)).alias("limit"),
                    F.min(F.when(F.col("length") >= x, F.struct("length", "docs_from", "tokens_from"))).alias("at"))
           for x in sorted(set(limits))]
    row = sums.agg(F.array(*per).alias("a"), F.max("all_tokens").alias("all_tokens"))
    found = row.select(F.inline("a"), "all_tokens")
    return (asked.join(found, "limit", "left")
            .select("limit", F.coalesce(
                F.col("all_tokens") - F.col("at.tokens_from") + F.col("at.docs_from") * F.col("limit"),
                F.col("all_tokens"), F.lit(0)).alias("tokens")))


def length_quantiles(sums: DataFrame, probabilities: list[float]) -> DataFrame:
    """(probability, length): the smallest length that at least that share of
    the documents doesn't exceed.  No rows in, null out."""
    per = [F.struct(F.lit(float(p)).alias("probability"),
                    F.min(F.when((F.col("all_docs") - F.col("docs_from") + F.col("n_docs")) >=
                                 F.ceil(F.lit(float(p)) * F.col("all_docs")), F.col("length"))).alias("length"))
           for p in probabilities]
    return sums.agg(F.array(*per).alias("a")).select(F.inline("a"))


def length_table(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Histogram and suffix sums of ``docs``; an empty table gives no rows,
    null and empty texts count at length 0, repeated rows count each.  A very
    long text is encoded whole.  Columns other than text are not read."""
    return suffix_sums(histogram(with_length(docs.select("text"), vocabulary)))
