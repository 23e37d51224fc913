"""Benchmark decontamination with one Aho-Corasick automaton.

All windows of the benchmark items become the patterns of one automaton over
normalised words (A-Z lower-cased, anything outside letters, digits and
non-ASCII characters a separator).  Every document is normalised and scanned
once; matches give word numbers, which map back to offsets of the original
text.

Benchmark items are a stated query set.  They are taken in blocks of at most
``block_bytes`` of item text (any usual benchmark is one block, so one
automaton), which bounds what is shipped to a task and the automaton's memory.
Further blocks are further passes over the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailyseries.llm.common import materialize, small_batches

WINDOW = 10
ADDED = ["n_words", "n_hit", "n_items", "item_ids", "hit_spans", "contaminated"]
BLOCK_BYTES = 1 << 20

# Bytes outside words become spaces; A-Z is lower-cased; 0x80 and above belong to words.
NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
               for c in range(256))

HIT_SCHEMA = ("n_words long, hit_words array<int>, item_ids array<string>, "
              "spans array<struct<start:int,end:int>>")


def normal_words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(NORMAL).split()


class Windows:
    """The automaton over word numbers of all windows of some items."""

    def __init__(self, items: list[tuple[object, str | None]], size: int = WINDOW):
        import ahocorasick

        self.numbers: dict[bytes, int] = {}
        patterns: dict[tuple[int, ...], set] = {}
        for item_id, text in items:
            words = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in normal_words(text)]
            # a shorter item, if it has words, is one window
            for i in range(max(1, len(words) - size + 1) if words else 0):
                patterns.setdefault(tuple(words[i:i + size]), set()).add(item_id)
        self.owners = [(len(p), sorted(str(i) for i in ids if i is not None)) for p, ids in patterns.items()]
        self.auto = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for k, p in enumerate(patterns):
            self.auto.add_word(p, k)
        self.auto.make_automaton()

    def scan(self, text: str | None) -> tuple[int, list[int], list[str], list[tuple[int, int]]]:
        """(number of words, numbers of hit words, item ids, hit spans in code
        points of the original text, end exclusive)."""
        raw = (text or "").encode()
        flat = raw.translate(NORMAL)
        words = flat.split()
        if not words or not self.owners:
            return len(words), [], [], []
        get = self.numbers.get
        found = list(self.auto.iter(tuple([get(w, 0) for w in words])))  # 0: in no item
        if not found:
            return len(words), [], [], []
        cover = np.zeros(len(words) + 1, np.int64)
        last = np.array([end for end, _ in found])
        np.add.at(cover, last + 1, -1)
        np.add.at(cover, last + 1 - np.array([self.owners[k][0] for _, k in found]), 1)
        hit = np.flatnonzero(np.cumsum(cover[:-1]) > 0)
        ids = {i for k in {k for _, k in found} for i in self.owners[k][1]}
        solid = np.frombuffer(flat, np.uint8) != 32
        edge = np.flatnonzero(np.diff(np.concatenate(([False], solid, [False])).astype(np.int8)))
        # code points before each byte
        point = np.concatenate(([0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)))
        runs = np.split(hit, np.flatnonzero(np.diff(hit) > 1) + 1)
        spans = [(int(point[edge[2 * r[0]]]), int(point[edge[2 * r[-1] + 1]])) for r in runs]
        return len(words), hit.tolist(), sorted(ids), spans


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple]]:
    """Items in blocks of bounded text size; the driver holds one block at a time."""
    block: list[tuple] = []
    size = 0
    for row in benchmark.select("item_id", F.col("text").cast("string")).toLocalIterator():
        n = 4 * len(row[1] or "") + 16
        if block and size + n > block_bytes:
            yield block
            block, size = [], 0
        block.append((row[0], row[1]))
        size += n
    yield block


def hits_udf(spark, items: list[tuple], size: int):
    shipped = spark.sparkContext.broadcast(items)

    @F.pandas_udf(HIT_SCHEMA)
    def hits(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        windows = Windows(shipped.value, size)
        for texts in batches:
            rows = [windows.scan(t) for t in texts]
            yield pd.DataFrame({
                "n_words": [r[0] for r in rows], "hit_words": [r[1] for r in rows],
                "item_ids": [r[2] for r in rows],
                "spans": [[{"start": s, "end": e} for s, e in r[3]] for r in rows]})

    return hits


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, item_ids (as strings, sorted),
    hit_spans and contaminated added; existing columns of these names are replaced.

    Null and empty texts have no words.  Items with null text or no words give
    no window; a null item id still marks words but is not listed.  An empty
    benchmark hits nothing.  Repeated rows are scanned as they come, very long
    texts whole.  Other columns pass through, whatever their names.
    """
    small_batches(docs.sparkSession)
    base = docs.drop(*ADDED)
    held, new = (_free_name(base, n) for n in ("__hits", "__new"))
    out = base
    for i, items in enumerate(item_blocks(benchmark, block_bytes)):
        if i:  # a pass of its own, so that a task holds one automaton at a time
            out = materialize(out, "decontam-pass")
        hits = hits_udf(docs.sparkSession, items, size)(F.col("text").cast("string"))
        out = out.withColumn(new if i else held, hits)
        if i:
            out = out.withColumn(held, F.struct(
                F.col(f"{new}.n_words").alias("n_words"),
                *[F.array_sort(F.array_union(f"{held}.{c}", f"{new}.{c}")).alias(c)
                  for c in ("hit_words", "item_ids", "spans")])).drop(new)
    return out.select(*base.columns, F.col(f"{held}.n_words").alias("n_words"),
                      F.size(f"{held}.hit_words").cast("long").alias("n_hit"),
                      F.size(f"{held}.item_ids").cast("long").alias("n_items"),
                      F.col(f"{held}.item_ids").alias("item_ids"), F.col(f"{held}.spans").alias("hit_spans"),
                      (F.size(f"{held}.hit_words") > 0).alias("contaminated"))


def _free_name(df: DataFrame, name: str) -> str:
    """``name`` or a longer one that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def digest_columns(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "n_words", "n_hit", "n_items",
                         F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


ORACLE = f"""
with words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as ws from documents),
items as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as ws from benchmark),
win as (
  select distinct item_id, w, len(w) as n from (
    select item_id, unnest([ws[i:i + {WINDOW} - 1] for i in range(1, greatest(2, len(ws) - {WINDOW - 2}))]) as w
    from items where len(ws) > 0)),
sizes as (select distinct n from win),
grams as (
  select doc_id, n, unnest(range(1, len(ws) - n + 2)) as i, unnest([ws[i:i + n - 1] for i in range(1, len(ws) - n + 2)]) as w
  from words, sizes where len(ws) >= n),
found as (select doc_id, i, win.n, item_id from grams join win using (w)),
hit as (select doc_id, count(distinct p) as n_hit from (
  select doc_id, unnest(range(i, i + n)) as p from (select distinct doc_id, i, n from found)) group by doc_id),
own as (select doc_id, count(*) as n_items, string_agg(s, ',' order by s) as ids
  from (select distinct doc_id, cast(item_id as varchar) as s from found) group by doc_id)
select doc_id, cast(len(ws) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from words left join hit using (doc_id) left join own using (doc_id)
"""
