"""Line deduplication over levelled sorted runs of line hashes.

Documents are taken in batches of ascending doc_id.  Each batch's distinct
line keys (128-bit hashes) are merge-joined with the sorted runs of the
earlier batches: keys found there are repeats of an older document, the rest
are new and become a run of their own.  Two runs of one level are compacted
into one run of the next level, so a key is rewritten a logarithmic number of
times and a batch meets few runs.  DataFrame functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailyseries.llm.common import ascii_lower, materialize
from dailyseries.llm.runs import SortedRuns, sorted_run

WHITE = " \t\n\x0b\f\r"  # [\x20\x09-\x0D]
MIN_CHARS = 10
ADDED = ["kept_text", "n_lines", "n_dropped"]
BATCHES = 4
NULL_ID = -(1 << 63)  # a null doc_id counts as one document that sorts first


def line_key(line):
    return ascii_lower(F.btrim(line, F.lit(WHITE)))


def _text(docs: DataFrame):
    return F.coalesce(docs["text"].cast("string"), F.lit(""))


def _keyed(docs: DataFrame) -> DataFrame:
    """did, th (hash of the text, so that rows sharing an id stay apart), text."""
    text = _text(docs)
    return docs.select(F.coalesce(docs["doc_id"].cast("long"), F.lit(NULL_ID)).alias("did"),
                       F.xxhash64(text).alias("th"), text.alias("body"))


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, batches: int = BATCHES) -> DataFrame:
    """(__d_did, __d_th, __drops): line numbers each document loses, for those that lose any."""
    spark = docs.sparkSession
    keyed = _keyed(docs)
    cuts = keyed.select(F.percentile_approx("did", [i / batches for i in range(1, batches)], 10_000).alias("q"))
    bounds = sorted(set(cuts.first()["q"] or []))
    batch = sum((F.col("did") > F.lit(b)).cast("int") for b in bounds) if bounds else F.lit(0)
    lines = (keyed.select("did", "th", F.posexplode(F.split("body", "\n", -1)).alias("pos", "line"))
             .withColumn("k", line_key(F.col("line")))
             .where(F.char_length("k") >= min_chars)
             .select("did", "th", "pos", F.xxhash64("k").alias("h1"), F.xxhash64(F.lit(7), "k").alias("h2"),
                     batch.alias("batch")))
    # one pass over the texts; everything after works on hashes
    lines = materialize(lines, "line-hashes")
    runs = SortedRuns(["h1", "h2"])
    drops = []
    for i in range(len(bounds) + 1):
        own = lines.where(F.col("batch") == i).drop("batch")
        keys = own.groupBy("h1", "h2").agg(F.min("did").alias("owner"), F.max("did").alias("last"))
        marked = sorted_run(runs.mark(keys), ["h1", "h2"], "line-keys")
        repeated = marked.where("seen or last > owner").select("h1", "h2", "owner", "seen")
        drops.append(own.join(repeated, ["h1", "h2"]).where("seen or did > owner").select("did", "th", "pos"))
        if i < len(bounds):
            runs.add(marked.where("not seen").select("h1", "h2"))
    return (reduce(DataFrame.unionByName, drops).groupBy("did", "th")
            .agg(F.collect_set("pos").alias("__drops")).withColumnsRenamed({"did": "__d_did", "th": "__d_th"}))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, batches: int = BATCHES) -> DataFrame:
    """``docs`` with ``kept_text``, ``n_lines`` and ``n_dropped`` added.

    A line's key is the line without white space at its ends, A-Z lower-cased.
    A key of at least ``min_chars`` code points held by two or more doc_ids
    loses all its lines but those of the smallest doc_id.  A null or empty
    text is one empty line; a null doc_id is one document before all others;
    rows that share a doc_id are one document, each row losing its own lines.
    Existing columns of the three names are replaced.
    """
    drops = dropped_lines(docs, min_chars, batches)
    text = _text(docs)
    base = docs.drop(*ADDED)
    keyed = base.withColumns({"__did": F.coalesce(docs["doc_id"].cast("long"), F.lit(NULL_ID)),
                              "__th": F.xxhash64(text)})
    joined = keyed.join(drops, (keyed["__did"] == drops["__d_did"]) & (keyed["__th"] == drops["__d_th"]), "left")
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    parts = F.split(body, "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("__drops"))
    out = joined.withColumns({
        "kept_text": F.when(F.col("__drops").isNull(), body)
        .otherwise(F.array_join(F.transform(kept, lambda i: F.get(parts, i)), "\n")),
        "n_lines": F.size(parts).cast("long"),
        "n_dropped": F.coalesce(F.size("__drops"), F.lit(0)).cast("long")})
    return out.select(*base.columns, "kept_text", "n_lines", "n_dropped")


def digest_columns(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE = r"""
with d as (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents),
e as (select doc_id, unnest(ls) as line, unnest(range(len(ls))) as pos from d),
k as (select doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from e),
o as (select key, min(doc_id) as owner from k where length(key) >= 10 group by key having count(distinct doc_id) > 1),
m as (select k.*, o.key is not null and k.doc_id > o.owner as dropped from k left join o using (key))
select doc_id, count(*) as n_lines, cast(count(*) filter (where dropped) as bigint) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not dropped), '')) as kept_sha256
from m group by doc_id
"""
