"""Exact top-k search over binary codes by incremental multi-index hashing.

A code has one sign bit per dimension, as words of 64 bits.  Codes are cut into
16-bit segments, and every distinct code is indexed once per segment value.
Search proceeds by radius: in round r, every query that is not finished
probes the segment values at exactly r flipped bits.  Probing the first b + 1
segments covers the Hamming distance ``segments * r + b`` (pigeonhole), so
a query grows no more segments than its k-th verified distance needs, and is
finished once that is covered.  Codes farther than the k-th so far are dropped
where they are verified, inside the task.  The result is exact at any
size; nothing is capped.

Segment values do not become rows.  The index of a segment is cut by the
leading bits of its values into parts, and a query is one row for each part
that holds a value at the radius, however many do.  A task looks the values up
and verifies the codes behind them with numpy, a bounded number at a time.  More
codes make more leading bits, and a part that is larger than two mean ones is
cut into chunks, its queries into shares.  So the rows of a query depend on
the radius and the leading bits, not on how many values the index has filled.

Which values of a segment occur in the index is a bitmap of 65 536 bits,
shipped to the tasks.  Parts are taken from the masks of weight r where these
are fewer, else from the occupied values.

Equal codes are one index entry that keeps its ``k + 1`` smallest ids, which
is all that a top-k with ties broken by id can use, so one very common vector
costs no more than a rare one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dailyseries.llm.common import materialize

SEGMENT_BITS = 16
WORD_BITS = 64
PER_WORD = WORD_BITS // SEGMENT_BITS
TOP_K = 10
QUERY_STEP = 20
#: Codes of a segment's part, and the leading bits that may cut it; the least codes of a chunk, and a share's queries.
PART_CODES = 1 << 18
PART_BITS = (4, 12)
CHUNK_CODES = 1 << 10
QUERY_CODES = 1 << 18
#: Words compared at a time.
CELLS = 1 << 20


def words_of(vectors: DataFrame, column: str = "embedding") -> int:
    """Words of 64 bits that a code of the longest vector takes; at least one."""
    width = vectors.agg(F.max(F.size(F.col(column)))).first()[0] or 0
    return max(1, -(-width // WORD_BITS))


def with_code(vectors: DataFrame, words: int, column: str = "embedding") -> DataFrame:
    """(vec_id, code): one sign bit per dimension in an array of ``words`` words;
    a missing or null dimension is a 0 bit.  Rows with a null id or a null
    vector are left out; of rows that share an id, the smallest code counts."""
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")

    def word(w: int):
        bits = F.transform(F.sequence(F.lit(0), F.lit(WORD_BITS - 1)), lambda i: F.when(
            F.get(column, i + w * WORD_BITS) >= 0, F.call_function("shiftleft", one, i)).otherwise(zero))
        return F.aggregate(bits, zero, lambda a, b: a.bitwiseOR(b))

    return (vectors.where(F.col("vec_id").isNotNull() & F.col(column).isNotNull())
            .select(F.col("vec_id").cast("long").alias("vec_id"), F.array(*[word(w) for w in range(words)]).alias("code"))
            .groupBy("vec_id").agg(F.min("code").alias("code")))


def _segment(code: str, s: int):
    word = F.get(code, F.lit(s // PER_WORD))
    return (F.shiftrightunsigned(word, SEGMENT_BITS * (s % PER_WORD))
            .bitwiseAND(F.lit((1 << SEGMENT_BITS) - 1)).cast("int"))


def _segments(code: str, words: int):
    return F.posexplode(F.array(*[_segment(code, s) for s in range(words * PER_WORD)]))


def occupied_values(entries: DataFrame, segments: int) -> list[np.ndarray]:
    """For each segment the bitmap of its values in the index: 8 KB each."""
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("val")).alias("bits")
    rows = (entries.select("seg", "val").groupBy("seg", F.bitmap_bucket_number("val").alias("bucket")).agg(bits))
    out = np.zeros((segments, 1 << SEGMENT_BITS), bool)
    for r in rows.collect():  # at most three rows of 4 KB a segment
        on = np.flatnonzero(np.unpackbits(np.frombuffer(bytes(r["bits"]), np.uint8), bitorder="little"))
        # Spark's bitmaps count from 1: bucket b holds the values (b - 1) * 32768 + 1 ... b * 32768
        values = on + 1 + (r["bucket"] - 1) * 32768 if r["bucket"] > 0 else -on
        out[r["seg"], values] = True
    return [np.packbits(row) for row in out]


def near_parts_udf(spark, occupied: list[np.ndarray], radius: int, low_bits: int):
    """The parts of a segment, by their leading bits, that hold an occupied
    value at exactly ``radius`` bits from a value."""
    shipped = spark.sparkContext.broadcast(occupied)  # 8 KB a segment
    masks = np.flatnonzero(np.bitwise_count(np.arange(1 << SEGMENT_BITS, dtype=np.uint32)) == radius).astype(np.uint32)

    @F.pandas_udf("array<int>")
    def near(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        held = [np.unpackbits(b).astype(bool) for b in shipped.value]
        values = [np.flatnonzero(h).astype(np.uint32) for h in held]

        def of(seg: int, own: int) -> np.ndarray:
            if len(masks) <= len(values[seg]):
                at = masks ^ np.uint32(own)
                at = at[held[seg][at]]
            else:
                at = values[seg][np.bitwise_count(values[seg] ^ np.uint32(own)) == radius]
            return np.flatnonzero(np.bincount(at >> low_bits)).astype(np.int32)

        for segs, owns in batches:
            yield pd.Series([of(s, o) for s, o in zip(segs.tolist(), owns.tolist(), strict=True)])

    return near


def _words(column: pa.ChunkedArray, words: int) -> np.ndarray:
    """Codes as rows of ``words`` words; segment s is the s-th 16 bits."""
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype("<i8", copy=False).view("<u8").reshape(-1, words)


FOUND = "q array<long>, code array<long>, n int, low long, dist int"


def search_part(radius: int, k: int, words: int, low_bits: int):
    """A function over one chunk of an index part and the queries sent to it:
    of the codes whose segment is ``radius`` bits away, for each query the
    ``k + 1`` first by (distance, smallest id) within its bound."""
    cells = max(1, CELLS // words)

    def nearest(qi: np.ndarray, ci: np.ndarray, dist: np.ndarray, low: np.ndarray):
        order = np.lexsort((low[ci], dist, qi))
        qi, ci, dist = qi[order], ci[order], dist[order]
        first = np.arange(len(qi)) - np.searchsorted(qi, qi) <= k
        return qi[first], ci[first], dist[first]

    def verified(seg, queries, bound, codes, low, qi, starts, counts):
        """Codes at ``starts`` of ``counts``, each for one query."""
        ends = np.cumsum(counts)
        qi = np.repeat(qi, counts)
        ci = np.arange(len(qi)) + np.repeat(starts - ends + counts, counts)
        apart = queries[qi] ^ codes[ci]
        dist = np.bitwise_count(apart).sum(axis=1, dtype=np.int32)
        on = np.flatnonzero(dist <= bound[qi])
        by_segment = np.bitwise_count(apart[on].view("<u2"))
        # a code is taken at its first segment with the least difference only: no repeats, no shuffle to find them
        on = on[(by_segment[:, :seg] > radius).all(axis=1) & (by_segment[:, seg:] >= radius).all(axis=1)]
        return nearest(qi[on], ci[on], dist[on], low)

    def search(key, queries: pa.Table, index: pa.Table) -> pa.Table:
        seg, part = key[0].as_py(), key[1].as_py()
        weight = np.bitwise_count(np.arange(1 << low_bits, dtype=np.uint32))
        value = index["val"].to_numpy() & ((1 << low_bits) - 1)
        order = np.argsort(value, kind="stable")
        codes, low, n = _words(index["code"], words)[order], index["low"].to_numpy()[order], index["n"].to_numpy()[order]
        first = np.searchsorted(value[order], np.arange((1 << low_bits) + 1))  # where the codes of each value begin
        held = np.flatnonzero(np.diff(first))
        asked, bound, own = _words(queries["q"], words), queries["bound"].to_numpy(), queries["own"].to_numpy()
        left = radius - np.bitwise_count((own >> low_bits) ^ part).astype(np.int64)  # bits to flip below the leading ones
        own = own & ((1 << low_bits) - 1)
        found = [(np.zeros(0, np.int64),) * 3]
        for bits in range(low_bits + 1):
            rows, masks = np.flatnonzero(left == bits), np.flatnonzero(weight == bits)
            by_mask = len(masks) <= len(held)
            step = max(1, cells // max(1, min(len(masks), len(held))))
            for at in range(0, len(rows), step):
                qi = rows[at:at + step]
                if by_mask:
                    to = own[qi][:, None] ^ masks[None, :]
                    i, j = np.nonzero(first[to + 1] > first[to])
                    to = to[i, j]
                else:
                    i, j = np.nonzero(weight[own[qi][:, None] ^ held[None, :]] == bits)
                    to = held[j]
                starts, counts = first[to], first[to + 1] - first[to]
                cuts = np.flatnonzero(np.diff(np.cumsum(counts) // cells, prepend=0))
                for here in np.split(np.arange(len(i)), cuts):
                    if len(here):
                        found.append(verified(seg, asked, bound, codes, low, qi[i[here]], starts[here], counts[here]))
        qi, ci, dist = nearest(*(np.concatenate(x) for x in zip(*found, strict=True)), low)
        offsets = pa.array(np.arange(len(qi) + 1) * words, pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x.view("<i8").reshape(-1))) for x in (asked[qi], codes[ci])]
        return pa.table([*lists, pa.array(n[ci], pa.int32()), pa.array(low[ci], pa.int64()), pa.array(dist, pa.int32())],
                        names=["q", "code", "n", "low", "dist"])

    return search


def index_parts(codes: DataFrame, words: int) -> tuple[DataFrame, DataFrame, int]:
    """(entries, chunks, low bits): every code once per segment with its part
    and chunk, and the number of chunks of each part."""
    held = codes.count()
    fewest, most = PART_BITS
    part_bits = min(most, max(fewest, (held // PART_CODES).bit_length()))
    low_bits = SEGMENT_BITS - part_bits
    chunk = min(max(CHUNK_CODES, 2 * held >> part_bits), 2 * PART_CODES)
    cut = codes.select("*", _segments("code", words).alias("seg", "val")).withColumn("part", F.shiftright("val", low_bits))
    # a row for each part that has codes: at most 4096 a segment
    chunks = materialize(cut.groupBy("seg", "part").agg(F.ceil(F.count("*") / chunk).cast("int").alias("chunks")), "mih-chunks")
    entries = (cut.join(F.broadcast(chunks), ["seg", "part"])
               .withColumn("chunk", F.pmod(F.xxhash64("code"), F.col("chunks")).cast("int")).drop("chunks"))
    return materialize(entries, "mih-index"), chunks, low_bits


def distinct_codes(codes: DataFrame, k: int) -> DataFrame:
    """(code, ids): each distinct code with its k + 1 smallest ids, ascending."""
    nth = Window.partitionBy("code").orderBy("vec_id")
    few = codes.withColumn("nth", F.row_number().over(nth)).where(F.col("nth") <= k + 1)
    return few.groupBy("code").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))


def search_codes(index: DataFrame, queries: DataFrame, k: int, words: int) -> DataFrame:
    """(q, code, dist): for each query code the k + 1 first index codes by
    (distance, smallest id), which hold its k + 1 nearest ids."""
    segments = words * PER_WORD
    codes = index.select("code", F.size("ids").alias("n"), F.get("ids", F.lit(0)).alias("low"))
    entries, chunks, low_bits = index_parts(codes, words)
    farthest = words * WORD_BITS
    active = materialize(queries.select(F.col("code").alias("q")).distinct().withColumn("bound", F.lit(farthest)), "mih-active")
    occupied = occupied_values(entries, segments)
    best, finished = None, []
    first = Window.partitionBy("q").orderBy("dist", "low")
    for radius in range(SEGMENT_BITS + 1):
        near = near_parts_udf(active.sparkSession, occupied, radius, low_bits)
        # segments 0 ... b at this radius cover the distance segments * radius + b: no more than the bound is needed
        needed = F.col("seg") <= F.col("bound") - segments * radius
        probes = materialize(active.select("q", "bound", _segments("q", words).alias("seg", "own")).where(needed).select(
            "q", "bound", "seg", "own", F.explode(near("seg", "own")).alias("part")), f"mih-probes-{radius}")
        # both sides of a part are cut, so that a task never holds more than a chunk and a share
        shares = probes.groupBy("seg", "part").agg(F.ceil(F.count("*") / QUERY_CODES).cast("int").alias("shares"))
        asked = (probes.join(F.broadcast(shares), ["seg", "part"]).join(F.broadcast(chunks), ["seg", "part"])
                 .withColumn("share", F.pmod(F.xxhash64("q"), F.col("shares")).cast("int"))
                 .select("q", "bound", "own", "seg", "part", "share", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk")))
        held = (entries.join(F.broadcast(shares), ["seg", "part"])
                .withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))).drop("shares"))
        key = ["seg", "part", "chunk", "share"]
        new = asked.groupBy(*key).cogroup(held.groupBy(*key)).applyInArrow(search_part(radius, k, words, low_bits), FOUND)
        pool = new if best is None else best.unionByName(new)
        best = materialize(pool.withColumn("nth", F.row_number().over(first))
                           .where(F.col("nth") <= k + 1).drop("nth"), f"mih-best-{radius}")
        # the distance within which k + 1 ids lie (one may be the query itself) bounds all that can still count
        ids = best.withColumn("ids", F.sum("n").over(first.rowsBetween(Window.unboundedPreceding, 0)))
        kth = ids.where(F.col("ids") >= k + 1).groupBy("q").agg(F.min("dist").alias("kth"))
        state = materialize(active.select("q").join(kth, "q", "left")
                            .select("q", F.coalesce("kth", F.lit(farthest)).alias("bound")), f"mih-state-{radius}")
        covered = segments * (radius + 1) - 1
        left = state.where(F.col("bound") > covered)
        finished.append(best.join(left, "q", "left_anti"))
        if left.isEmpty():
            break
        active, best = left, best.join(left, "q", "left_semi")
    return reduce(DataFrame.unionByName, finished).select("q", "code", "dist")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = TOP_K, column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, distance): for every query vector its ``k``
    nearest other ids by Hamming distance of the codes, ties by id.

    Codes have a bit for every dimension of the longest vector; shorter
    vectors have 0 bits beyond their end.  Fewer than ``k`` other ids give
    fewer rows.  Queries with a null id or vector give none, and so does an
    empty table.  Of rows that share an id the smallest code counts.  Other
    columns are not read, whatever their names.
    """
    words = max(words_of(vectors, column), words_of(queries, column))
    index = materialize(distinct_codes(with_code(vectors, words, column), k), "mih-codes")
    asked = with_code(queries, words, column)
    near = search_codes(index, asked, k, words)
    ids = near.join(index, "code").select("q", "dist", F.explode("ids").alias("vec_id"))
    nth = Window.partitionBy("q").orderBy("dist", "vec_id")
    lists = (ids.withColumn("nth", F.row_number().over(nth)).where(F.col("nth") <= k + 1)
             .groupBy("q").agg(F.array_sort(F.collect_list(F.struct("dist", "vec_id"))).alias("near")))
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return (asked.select(F.col("vec_id").alias("query_id"), F.col("code").alias("q")).join(lists, "q")
            .select("query_id", F.posexplode(others).alias("pos", "x"))
            .select("query_id", (F.col("pos") + 1).cast("long").alias("rank"), F.col("x.vec_id").alias("vec_id"),
                    F.col("x.dist").cast("long").alias("distance")))


ORACLE = f"""
with w as (select max(len(embedding)) as width from embeddings),
c as (select vec_id, array_to_string([case when embedding[i] >= 0 then '1' else '0' end for i in range(1, width + 1)], '')::bit as b
  from embeddings, w where vec_id is not null and embedding is not null),
p as (select q.vec_id as query_id, c.vec_id, bit_count(xor(q.b, c.b)) as distance
  from c q join c on q.vec_id <> c.vec_id where q.vec_id % {QUERY_STEP} = 0),
r as (select *, row_number() over (partition by query_id order by distance, vec_id) as rank from p)
select query_id, cast(rank as bigint) as rank, vec_id, cast(distance as bigint) as distance
from r where rank <= {TOP_K}
"""
