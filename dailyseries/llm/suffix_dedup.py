"""Repeated 200-byte strings by a logarithmic family of sparse suffix arrays.

Suffixes are sampled where content says so: a suffix is kept if the hash of
its first ``GRAM`` bytes is the least among the suffixes that start in some
``LENGTH``-byte string with room for the gram (leftmost on ties).  Every
``LENGTH``-byte string thus has one kept suffix, its anchor, at an offset that
only depends on the string, so equal strings share their anchor's gram.

A suffix array here is the sorted table of the grams' 64-bit fingerprints.
Only equality of long prefixes matters, so entries are ordered by fingerprint,
not by bytes.  New batches of documents get their array; it is merge-scanned
against the arrays of all levels for grams that occur before; arrays of equal
level are merged into the next, so a fingerprint is rewritten a logarithmic
number of times.

Grams that repeat only nominate.  Decisions are on whole strings, from coarse
to fine, so that few strings are ever compared one by one:

* The strings of one anchor form a cell (a run of start offsets).  Cells whose
  bytes repeat are covered as a whole.
* Where one gram has different cells, each kind of cell is cut into chunks of
  ``CHUNK`` offsets relative to the anchor.  Equal strings lie in the same chunk
  and share the chunk's core, the bytes that all its strings have in common.
  Chunks whose bytes repeat are covered as a whole.
* Only chunks that share a core but differ are taken apart into strings.

The texts are read in map-only passes and one join; what passes between them
is hashes, filtered by fixed-size bitmaps before every shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailyseries.llm.common import (U, bitmap_has, drop_table, key_bitmap, materialize, maybe_in, mix64, path_of,
                                    prefix_hash, range_hash, rows_of, signed,
                                    small_batches)
from dailyseries.llm.line_dedup import NULL_ID
from dailyseries.llm.runs import SortedRuns, sorted_run

LENGTH = 200
GRAM = 100
CHUNK = 8
BATCHES = 4
SEGMENT = (1 << 20) - 1024  # bytes handled at a time


def anchor_cells(data: np.ndarray, length: int, gram: int) -> Iterator[tuple]:
    """(segment start, prefix hash, gram hashes, anchors, first start, last
    start) for each segment of a text; positions are relative to the segment.

    A cell cut by a segment border is two cells, which later steps handle like
    any two cells of one gram.
    """
    if len(data) < length:
        return
    w = length - gram + 1  # grams in a string
    for at in range(0, len(data) - length + 1, SEGMENT):
        part = data[at:at + SEGMENT + length - 1]
        p = prefix_hash(part)
        n = len(part) - gram + 1
        i = np.arange(n)
        g = range_hash(p, i, i + gram)
        # leftmost least hash: the position breaks ties
        key = (g & ~U((1 << 20) - 1)) | i.astype(np.uint64)
        starts = len(part) - length + 1
        padded = np.full(-(-n // w) * w + w, np.iinfo(np.uint64).max, np.uint64)
        padded[:n] = key
        grid = padded.reshape(-1, w)
        before = np.minimum.accumulate(grid, axis=1).reshape(-1)
        after = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        anchor = (np.minimum(after[:starts], before[w - 1:w - 1 + starts]) & U((1 << 20) - 1)).astype(np.int64)
        first = np.concatenate(([0], np.flatnonzero(np.diff(anchor)) + 1))
        last = np.concatenate((first[1:] - 1, [starts - 1]))
        yield at, p, g, anchor[first], first, last


def cell_id(did: int, th: int, start: np.ndarray) -> np.ndarray:
    """A hash that names one cell (or chunk) of one document by its start."""
    base = mix64(np.array([did, th], np.int64).view(np.uint64)) * np.array([3, 1], np.uint64)
    return mix64(start.astype(np.uint64) + base.sum(dtype=np.uint64))


_GRAMS = pa.schema([("g", pa.int64())])
_CELLS = pa.schema([("g", pa.int64()), ("ck", pa.int64()), ("cell", pa.int64()), ("did", pa.int64()),
                    ("th", pa.int32()), ("start", pa.int64()), ("span", pa.int32())])
CELL_SCHEMA = "g long, ck long, cell long, did long, th int, start long, span int"
_CHUNKS = pa.schema([("core", pa.int64()), ("z", pa.int64()), ("ck", pa.int64()), ("chunk", pa.int64()),
                     ("did", pa.int64()), ("th", pa.int32()), ("start", pa.int64()), ("span", pa.int32())])
CHUNK_SCHEMA = "core long, z long, ck long, chunk long, did long, th int, start long, span int"
_STRINGS = pa.schema([("core", pa.int64()), ("wh", pa.int64()), ("z", pa.int64()), ("did", pa.int64()),
                      ("th", pa.int32()), ("start", pa.int64())])
STRING_SCHEMA = "core long, wh long, z long, did long, th int, start long"
ROWS_OUT = 1 << 16


def _emit(schema: pa.Schema, kept: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    columns = [np.concatenate(c) for c in zip(*kept, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _pass(keyed: DataFrame, schema: pa.Schema, ddl: str, work) -> DataFrame:
    """Run ``work(did, th, data)``, which yields column tuples, over all texts."""

    def run(batches):
        job = work()
        kept, rows = [], 0
        for batch in batches:
            for did, th, body in rows_of(batch):
                for columns in job(did, th, np.frombuffer(body.encode(), np.uint8)):
                    kept.append(columns)
                    rows += len(columns[0])
                    if rows >= ROWS_OUT:
                        yield _emit(schema, kept)
                        kept, rows = [], 0
        if kept:
            yield _emit(schema, kept)

    return keyed.select("did", "th", "body").mapInArrow(run, ddl)


def _keyed(docs: DataFrame) -> DataFrame:
    """did, th (a text hash that keeps rows sharing an id apart), body."""
    body = F.coalesce(docs["text"].cast("string"), F.lit(""))
    return docs.select(F.coalesce(docs["doc_id"].cast("long"), F.lit(NULL_ID)).alias("did"),
                       F.hash(body).alias("th"), body.alias("body"))


def repeated_grams(keyed: DataFrame, batches: int, length: int, gram: int) -> np.ndarray:
    """A bitmap of the fingerprints of kept suffixes' grams that occur more than
    once, found batch by batch against the levels of sorted arrays."""
    cuts = keyed.select(F.percentile_approx("did", [i / batches for i in range(1, batches)], 10_000).alias("q"))
    bounds = sorted(set(cuts.first()["q"] or []))

    def work():
        def job(did, th, data):
            for _, _, g, anchor, _, _ in anchor_cells(data, length, gram):
                yield (signed(g[anchor]),)
        return job

    levels, arrays = SortedRuns(["g"]), []
    for low, high in zip([None, *bounds], [*bounds, None], strict=True):
        batch = keyed if low is None else keyed.where(F.col("did") > low)
        batch = batch if high is None else batch.where(F.col("did") <= high)
        own = _pass(batch, _GRAMS, "g long", work).groupBy("g").agg(F.count("*").alias("c"))
        array = sorted_run(levels.mark(own), ["g"], "sa-batch")
        arrays.append(array)
        if high is not None:
            levels.add(array.where("not seen").select("g"))
    found = arrays[0].where("seen or c > 1").select("g")
    for array in arrays[1:]:
        found = found.unionByName(array.where("seen or c > 1").select("g"))
    bitmap = key_bitmap(found, F.col("g"))
    for table in [*arrays, *(run for level, runs in levels.levels.items() if level for run in runs)]:
        drop_table(keyed.sparkSession, path_of(table))
    return bitmap


def cell_keys(p: np.ndarray, anchor: np.ndarray, first: np.ndarray, last: np.ndarray, length: int) -> np.ndarray:
    """Equal for cells of equal bytes with equal offsets of their anchors."""
    return mix64(range_hash(p, first, last + length) + (anchor - first).astype(np.uint64) * U(0x9E3779B1)
                 + (last - first).astype(np.uint64))


def cell_chunks(p, g, anchor, first, last, length: int) -> tuple[np.ndarray, ...]:
    """(cell number, core key, bytes key, first start, last start) of the
    chunks of some cells."""
    near, far = (anchor - last) // CHUNK, (anchor - first) // CHUNK  # chunk numbers count from the anchor back
    n = far - near + 1
    of = np.repeat(np.arange(len(anchor)), n)
    number = near[of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    a = anchor[of]
    hi = np.minimum(a - number * CHUNK, last[of])
    lo = np.maximum(a - number * CHUNK - (CHUNK - 1), first[of])
    # in every string of the chunk, whichever of them the cell has
    core = range_hash(p, a - number * CHUNK, a - number * CHUNK - (CHUNK - 1) + length)
    core = mix64(core + g[a] * U(0xD6E8FEB86659FD93) + number.astype(np.uint64))
    return of, core, cell_keys(p, a, lo, hi, length), lo, hi


def covered_strings(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, batches: int = BATCHES) -> DataFrame:
    """(c_did, c_th, starts, ends): byte ranges of repeated strings, one row
    per document that has any; ranges may overlap."""
    if length - gram < CHUNK:
        raise ValueError("the gram must be shorter than the strings by a chunk")
    small_batches(docs.sparkSession)
    keyed = _keyed(docs)
    spark = docs.sparkSession
    gram_bits = spark.sparkContext.broadcast(repeated_grams(keyed, batches, length, gram))

    def cells():
        bits = gram_bits.value

        def job(did, th, data):
            for at, p, g, anchor, first, last in anchor_cells(data, length, gram):
                hit = np.flatnonzero(bitmap_has(bits, g[anchor]))
                if len(hit):
                    c, a, b = anchor[hit], first[hit], last[hit]
                    yield (signed(g[c]), signed(cell_keys(p, c, a, b, length)), signed(cell_id(did, th, at + a)),
                           np.full(len(a), did, np.int64), np.full(len(a), th, np.int32), at + a,
                           (b - a).astype(np.int32))
        return job

    cell = materialize(_pass(keyed, _CELLS, CELL_SCHEMA, cells), "sa-cells")
    kinds = materialize(cell.groupBy("g", "ck").agg(F.count("*").alias("n"), F.min("cell").alias("rep")), "sa-kinds")
    mixed = kinds.groupBy("g").agg(F.count("*").alias("kinds")).where("kinds > 1").select("g")
    # one cell of each kind stands for all in the comparisons below
    compare = materialize(kinds.join(mixed, "g").select("rep"), "sa-compare")
    rep_bits = spark.sparkContext.broadcast(key_bitmap(compare, F.col("rep")))
    owners = cell.join(compare, cell["cell"] == compare["rep"]).select("did", "th").distinct()
    few = keyed.where(maybe_in(owners, F.xxhash64("did", "th"))(F.xxhash64("did", "th")))

    def rep_cells(did, th, data):
        for at, p, g, anchor, first, last in anchor_cells(data, length, gram):
            hit = np.flatnonzero(bitmap_has(rep_bits.value, cell_id(did, th, at + first)))
            if len(hit):
                yield at, p, g, anchor[hit], first[hit], last[hit]

    def chunks():
        def job(did, th, data):
            for at, p, g, anchor, first, last in rep_cells(did, th, data):
                of, core, z, lo, hi = cell_chunks(p, g, anchor, first, last, length)
                n = len(of)
                yield (signed(core), signed(z), signed(cell_keys(p, anchor, first, last, length)[of]),
                       signed(cell_id(did, th, at + lo)), np.full(n, did, np.int64), np.full(n, th, np.int32), at + lo,
                       (hi - lo).astype(np.int32))
        return job

    chunk = materialize(_pass(few, _CHUNKS, CHUNK_SCHEMA, chunks), "sa-chunks")
    pieces = materialize(chunk.groupBy("core", "z").agg(F.min("ck").alias("lo"), F.max("ck").alias("hi"),
                                                        F.min("chunk").alias("rep")), "sa-pieces")
    unequal = pieces.groupBy("core").agg(F.count("*").alias("c")).where("c > 1").select("core")
    take_apart = key_bitmap(pieces.join(unequal, "core"), F.col("rep"))
    piece_bits = spark.sparkContext.broadcast(take_apart)

    def strings():
        bits = piece_bits.value

        def job(did, th, data):
            for at, p, g, anchor, first, last in rep_cells(did, th, data):
                _, core, z, lo, hi = cell_chunks(p, g, anchor, first, last, length)
                hit = np.flatnonzero(bitmap_has(bits, cell_id(did, th, at + lo)))
                if len(hit):
                    n = hi[hit] - lo[hit] + 1
                    of = np.repeat(hit, n)
                    s = lo[of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
                    yield (signed(core[of]), signed(range_hash(p, s, s + length)), signed(z[of]),
                           np.full(len(s), did, np.int64), np.full(len(s), th, np.int32), at + s)
        return job

    string = materialize(_pass(few, _STRINGS, STRING_SCHEMA, strings), "sa-strings")
    # a string in two different chunks, a chunk in two kinds of cells or a cell met twice: all occur again
    shared = (string.groupBy("core", "wh").agg(F.min("z").alias("lo"), F.max("z").alias("hi"))
              .where("lo <> hi").select("core", "wh"))
    one = string.join(shared, ["core", "wh"]).select("did", "th", "start", (F.col("start") + length).alias("end"))
    to_end = (F.col("start") + F.col("span") + length).alias("end")
    some = (chunk.join(pieces.where("lo <> hi").select("core", "z"), ["core", "z"])
            .select("did", "th", "start", to_end))
    whole = cell.join(kinds.where("n > 1").select("g", "ck"), ["g", "ck"]).select("did", "th", "start", to_end)
    ranges = (whole.unionByName(some).unionByName(one).groupBy("did", "th")
              .agg(F.collect_list(F.struct("start", "end")).alias("r"))
              .select(F.col("did").alias("c_did"), F.col("th").alias("c_th"), F.col("r.start").alias("starts"),
                      F.col("r.end").alias("ends")))
    ranges = materialize(ranges, "sa-ranges")
    for table in (cell, kinds, compare, chunk, pieces, string):
        drop_table(spark, path_of(table))
    return ranges


def merge_ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs: sorted, disjoint, not touching."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate(([True], starts[1:] > ends[:-1]))
    return starts[new], ends[np.concatenate((new[1:], [True]))]


def cut(text: str | None, starts, ends) -> tuple:
    """(bytes, removed bytes, removed runs, remaining bytes, their SHA-256)."""
    raw = (text or "").encode()
    spans, kept = [], raw
    if starts is not None and len(starts):
        s, e = merge_ranges(np.asarray(starts, np.int64), np.asarray(ends, np.int64))
        borders = np.concatenate(([0], np.column_stack((s, e)).reshape(-1), [len(raw)])).tolist()
        kept = b"".join(raw[x:y] for x, y in zip(borders[::2], borders[1::2], strict=True))
        spans = [{"start": int(x), "end": int(y)} for x, y in zip(s, e, strict=True)]
    return len(raw), len(raw) - len(kept), spans, kept, hashlib.sha256(kept).hexdigest()


def cut_udf(with_kept: bool):
    @F.pandas_udf("n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary, "
                  "kept_sha256 string")
    def run(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([cut(*x) if with_kept else (*(y := cut(*x))[:3], None, y[4])
                            for x in zip(texts, starts, ends, strict=True)],
                           columns=["n_bytes", "n_removed", "spans", "kept", "kept_sha256"])

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, batches: int = BATCHES,
                   with_kept: bool = True) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, spans (byte ranges), kept
    (remaining bytes; null unless ``with_kept``) and kept_sha256.

    Texts are UTF-8 bytes, null is empty.  Every byte covered by a
    ``length``-byte string that also starts anywhere else, in the same or any
    other document, is removed; overlapping occurrences count, and strings are
    judged on the input.  Texts shorter than ``length`` bytes lose nothing.
    Repeated rows repeat each other's strings, so they all lose them.  A very
    long text is judged whole.  An empty table gives no rows; other columns
    are not read, whatever their names.
    """
    ranges = covered_strings(docs, length, gram, batches)
    body = F.coalesce(docs["text"].cast("string"), F.lit(""))
    keyed = docs.select("doc_id", F.coalesce(docs["doc_id"].cast("long"), F.lit(NULL_ID)).alias("did"),
                        F.hash(body).alias("th"), body.alias("body"))
    # only documents that may lose something are shuffled
    maybe = maybe_in(ranges, F.xxhash64("c_did", "c_th"))(F.xxhash64("did", "th"))
    # the rest keep all their bytes, which needs no Python
    whole = F.encode("body", "UTF-8") if with_kept else F.lit(None).cast("binary")
    clear = keyed.where(~maybe).select(
        "doc_id", F.octet_length("body").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"), whole.alias("kept"),
        F.sha2("body", 256).alias("kept_sha256"))
    rest = keyed.where(maybe)
    rest = rest.join(ranges, (rest["did"] == ranges["c_did"]) & (rest["th"] == ranges["c_th"]), "left")
    rest = rest.withColumn("c", cut_udf(with_kept)("body", "starts", "ends")).select("doc_id", "c.*")
    return clear.unionByName(rest).select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                                          "spans", "kept", "kept_sha256")


def digest_columns(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
