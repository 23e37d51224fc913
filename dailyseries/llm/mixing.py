"""Mixing sources to target weights by Pfair scheduling.

Every stream (a named source, or the rest) is cut into blocks of
``block_docs`` documents in a pseudo-random order of its own.  Block i of a
stream with weight w has release time floor(i / w) and deadline
ceil((i + 1) / w); each slot goes to the released block with the earliest
deadline.  With weights that are multiples of 1/period and sum to one, the
schedule repeats after ``period`` slots and every stream's share differs from
its target by less than one block at every slot.

The slot table of one period is fixed by the weights alone (at most ``period``
rows).  Everything that grows with the documents is DataFrame work: the order
within a stream is a two-level running count, so no window holds a whole source.  When a stream runs out, its later slots stay
empty and the others keep their proportions; no document is dropped.
"""

from __future__ import annotations

import heapq
from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

REST = "(rest)"
PERIOD = 1000
BLOCK_DOCS = 16


def quotas(weights: dict[str, float], rest: float, period: int = PERIOD) -> dict[str, int]:
    """Slots per period of each stream: largest remainders, at least one slot."""
    raw = {**weights, REST: rest}
    if any(w <= 0 for w in raw.values()) or REST in weights:
        raise ValueError("weights must be positive and must not name the rest stream")
    if len(raw) > period:
        raise ValueError("more streams than slots in a period")
    total = sum(map(Fraction, raw.values()))
    free = period - len(raw)
    share = {s: Fraction(w) / total * free for s, w in raw.items()}
    out = {s: 1 + int(x) for s, x in share.items()}
    left = period - sum(out.values())
    for s in sorted(share, key=lambda s: (int(share[s]) - share[s], s))[:left]:
        out[s] += 1
    return out


def slot_table(quota: dict[str, int]) -> list[tuple[str, int, int]]:
    """(stream, block number within the period, slot): earliest deadline first
    among released blocks; ties go by stream name."""
    period = sum(quota.values())
    blocks = sorted((i * period // q, -(-(i + 1) * period // q), s, i) for s, q in quota.items() for i in range(q))
    ready: list[tuple[int, str, int]] = []
    out, at = [], 0
    for slot in range(period):
        while at < len(blocks) and blocks[at][0] <= slot:
            _, deadline, s, i = blocks[at]
            heapq.heappush(ready, (deadline, s, i))
            at += 1
        deadline, s, i = heapq.heappop(ready)
        if deadline <= slot:
            raise AssertionError("missed deadline")
        out.append((s, i, slot))
    return out


def _shares(docs: DataFrame) -> int:
    """Hash shares per stream, so that one stream spreads over all tasks."""
    return 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def schedule(docs: DataFrame, weights: dict[str, float], rest: float, block_docs: int = BLOCK_DOCS,
             period: int = PERIOD) -> DataFrame:
    """``docs`` with stream, block, slot and place added; the mixed order is (slot, place).

    Documents of a stream are ordered by the md5 of the doc_id (null as the
    text "null"), then doc_id, then a hash of the row; full ties are repeated
    rows, and either may come first.  Null and unnamed sources share the rest
    stream.  An empty table gives an empty result.  Columns of the four new
    names are replaced.
    """
    spark = docs.sparkSession
    quota = quotas(weights, rest, period)
    slots = spark.createDataFrame(slot_table(quota), "stream string, __nth int, __slot int")
    base = docs.drop("stream", "block", "slot", "place")
    source = F.col("source").cast("string")
    n = _shares(docs)
    marked = base.withColumns({
        "stream": F.when(source.isin(list(weights)), source).otherwise(F.lit(REST)),
        "__md5": F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))),
        "__row": F.xxhash64(*[c for c, t in base.dtypes if "map" not in t])})
    # the first 32 bits of the md5 cut each stream into shares that are ranges of its order
    head = F.conv(F.substring("__md5", 1, 8), 16, 10).cast("long")
    marked = marked.withColumn("__share", F.floor(head * n / F.lit(1 << 32)).cast("int"))
    # level 1: documents before each share of the stream
    earlier = Window.partitionBy("stream").orderBy("__share").rowsBetween(Window.unboundedPreceding, -1)
    before = (marked.groupBy("stream", "__share").agg(F.count("*").alias("n"))
              .select("stream", "__share", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__before")))
    # level 2: rank within the share; the join keeps the window's partitioning
    own = Window.partitionBy("stream", "__share").orderBy("__md5", "doc_id", "__row")
    ranked = (marked.withColumn("__nth_own", F.row_number().over(own) - 1)
              .join(before, ["stream", "__share"])
              .withColumn("__rank", F.col("__before") + F.col("__nth_own"))
              .withColumn("block", F.floor(F.col("__rank") / block_docs).cast("long")))
    quota_of = F.create_map(*[x for s, q in quota.items() for x in (F.lit(s), F.lit(q))])
    per = F.element_at(quota_of, F.col("stream")).cast("long")
    ranked = ranked.withColumns({"__nth": F.pmod(F.col("block"), per).cast("int"),
                                 "__period": F.floor(F.col("block") / per).cast("long")})
    # the slot table has `period` rows, whatever the input
    out = (ranked.join(F.broadcast(slots), ["stream", "__nth"])
           .withColumns({"slot": F.col("__period") * period + F.col("__slot"),
                         "place": F.pmod(F.col("__rank"), F.lit(block_docs)).cast("long")}))
    return out.select(*base.columns, "stream", "block", "slot", "place")


# Production mixture of the synthetic corpus: the very large source is held to a fifth.
TARGET = {"src0": 0.20} | {f"src{i}": 0.06 for i in range(1, 10)} | {f"src{i}": 0.025 for i in range(10, 20)}
TARGET_REST = 0.01


def oracle(docs: str, columns: str = "doc_id", weights: dict[str, float] = TARGET, rest: float = TARGET_REST,
           block_docs: int = BLOCK_DOCS, period: int = PERIOD) -> str:
    """The same schedule in DuckDB SQL; the slot table of one period is inlined."""
    quota = quotas(weights, rest, period)
    values = ", ".join(f"('{s}', {i}, {slot}, {quota[s]})" for s, i, slot in slot_table(quota))
    named = ", ".join(f"'{s}'" for s in weights)
    return f"""
with slots(stream, nth, slot_in_period, quota) as (values {values}),
m as (select *, case when source in ({named}) then source else '{REST}' end as stream from {docs}),
r as (select *, row_number() over (partition by stream
        order by md5(coalesce(cast(doc_id as varchar), 'null')), doc_id, md5(coalesce(text, ''))) - 1 as rk from m),
b as (select *, rk // {block_docs} as block from r),
q as (select stream, any_value(quota) as quota from slots group by stream),
p as (select b.*, slots.slot_in_period + (block // q.quota) * {period} as slot
      from b join q using (stream) join slots on slots.stream = b.stream and slots.nth = b.block % q.quota)
select {columns}, stream, cast(block as bigint) as block, cast(slot as bigint) as slot,
  cast(rk % {block_docs} as bigint) as place
from p
"""
