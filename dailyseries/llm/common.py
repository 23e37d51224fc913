"""Shared helpers: table access, scratch tables, and byte/word hashing kernels.

Scratch tables live below the folder the cluster names in
``spark.checkpoint.dir`` (``dailyseries.session.scratch_path``), so a lost
executor never takes intermediate results with it and lineage stays short.
"""

from __future__ import annotations

import contextlib
import gc

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dailyseries.session import scratch_path

# Scratch tables still on disk, each with its number.
_LIVE: dict[str, int] = {}
_MADE = 0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BATCH_ROWS = 500


def small_batches(spark: SparkSession) -> None:
    """Send texts to Python in small Arrow batches.

    The default of 10,000 rows is made for numbers; as many texts are tens of
    MB in the JVM, in Arrow and again as Python strings, for every worker.  A
    session that sets the size itself keeps it.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) == 10_000:
        spark.conf.set(key, str(BATCH_ROWS))


@contextlib.contextmanager
def arrow_batches(spark: SparkSession, rows: int = BATCH_ROWS):
    """:func:`small_batches` for the jobs run inside the block only."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if int(before) == 10_000:
        spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder once and read it back.

    The shuffles that made it are garbage then, but Spark only deletes their
    files when the driver's JVM collects; asking for that keeps a job of many
    steps at the disk use of its largest step.
    """
    global _MADE
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    _LIVE[path] = _MADE
    _MADE += 1
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete one scratch table that no later step reads."""
    hp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hp, True)
    _LIVE.pop(path, None)


def path_of(df: DataFrame) -> str:
    """Folder of a frame returned by :func:`materialize`."""
    return df.inputFiles()[0].rsplit("/", 1)[0]


def scratch_mark() -> int:
    """A point in time for :func:`scratch_since`."""
    return _MADE


def scratch_since(mark: int) -> list[str]:
    """Scratch tables written since ``mark`` that are still there."""
    return [path for path, number in _LIVE.items() if number >= mark]


def release(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch tables.  Only for a caller that has already written all
    results that read them."""
    for path in paths:
        if path in _LIVE:
            drop_table(spark, path)


def ascii_lower(c):
    """Lower-case A-Z only; other characters stay.

    ``lower`` has a fast path for pure ASCII; ``translate`` keeps accented
    capitals where ``lower`` would change them.
    """
    upper, low = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, upper, low))


# ------------------------------------------------- fixed-size membership filter
FILTER_BITS = 27  # 16 MB, whatever the number of keys
_ROW_BITS = 15    # bits in one row of bitmap_construct_agg


def key_bitmap(keys: DataFrame, key_hash, bits: int = FILTER_BITS) -> np.ndarray:
    """A bitmap of ``2**bits`` bits with the bits of all key hashes set.

    Its size is fixed, so it may be collected and broadcast.  It never misses a
    key; as keys outgrow it, it lets more others through, so callers follow it
    with an exact join.
    """
    at = key_hash.bitwiseAND(F.lit((1 << bits) - 1))
    rows = (keys.select(F.shiftright(at, _ROW_BITS).alias("row"), at.bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("bit"))
            .groupBy("row").agg(F.bitmap_construct_agg("bit").alias("bits")))
    out = np.zeros((max(1, 1 << (bits - _ROW_BITS)), 1 << (_ROW_BITS - 3)), np.uint8)
    for r in rows.collect():  # at most 2**(bits - 15) rows of 4 KB
        out[r["row"]] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out.reshape(-1)


def bitmap_has(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.array(len(bitmap) * 8 - 1, hashes.dtype)
    return (bitmap[(at >> np.array(3, at.dtype)).astype(np.int64)] >> (at & np.array(7, at.dtype)).astype(np.uint8)) & 1 > 0


def maybe_in(keys: DataFrame, key_hash):
    """A predicate over hash columns: False only if no key has that hash."""
    shipped = keys.sparkSession.sparkContext.broadcast(key_bitmap(keys, key_hash))

    @F.pandas_udf("boolean")
    def maybe(hashes: pd.Series) -> pd.Series:
        return pd.Series(bitmap_has(shipped.value, hashes.to_numpy(np.int64)))

    return maybe


# --------------------------------------------------------------- hash kernels
U = np.uint64
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = U(0x9E3779B97F4A7C15)
_INV = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)  # fixed seed: same on every worker
SEGMENT = 1 << 20


def _powers(base: np.uint64, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


class _Powers:
    """Powers of the hash base and of its inverse, grown on demand."""

    up = _powers(_BASE, SEGMENT + 1)
    down = _powers(_INV, SEGMENT + 1)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(cls.up):
            return _powers(_BASE, n), _powers(_INV, n)
        return cls.up, cls.down


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers (xor-shift, odd multiplications)."""
    x = x ^ (x >> U(33))
    x *= U(0xFF51AFD7ED558CCD)
    x ^= x >> U(29)
    x *= U(0xC4CEB9FE1A85EC53)
    x ^= x >> U(32)
    return x


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """P with P[i] = sum of byte values times base powers before i."""
    up, _ = _Powers.upto(len(data) + 1)
    p = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=p[1:], dtype=np.uint64)
    return p


def range_hash(p: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range; equal ranges get equal hashes anywhere."""
    _, down = _Powers.upto(len(p))
    return mix64((p[end] - p[start]) * down[start])


def _segment_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the white-space separated words of a segment."""
    solid = np.zeros(len(data) + 2, np.int8)
    solid[1:-1] = ~_SPACE[data]
    edge = np.flatnonzero(np.diff(solid))
    starts, ends = edge[::2], edge[1::2]
    return starts, range_hash(prefix_hash(data), starts, ends)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes of all texts in order, number of words of each text).

    A-Z is lower-cased and words are runs of bytes other than
    ``[\\x20\\x09-\\x0D]``.  Short texts are hashed together; a text above one
    segment is cut at white space, so temporary arrays stay at a few MB.
    """
    hashes: list[np.ndarray] = []
    counts = np.zeros(len(texts), np.int64)
    group: list[int] = []
    size = 0

    def flush() -> None:
        nonlocal size
        if group:
            joined = np.frombuffer(b" ".join(texts[i] for i in group).translate(LOWER), np.uint8)
            starts, h = _segment_words(joined)
            ends = np.cumsum([len(texts[i]) + 1 for i in group])
            counts[group] = np.diff(np.searchsorted(starts, ends), prepend=0)
            hashes.append(h)
        group.clear()
        size = 0

    for i, text in enumerate(texts):
        if len(text) <= SEGMENT:
            if size + len(text) > SEGMENT:
                flush()
            group.append(i)
            size += len(text) + 1
            continue
        flush()
        at = 0
        lowered = np.frombuffer(text.translate(LOWER), np.uint8)
        while at < len(lowered):
            end = at + SEGMENT
            if end < len(lowered):
                gap = np.flatnonzero(_SPACE[lowered[at:end]])
                if len(gap):
                    end = at + int(gap[-1]) + 1
                else:  # one word longer than a segment: up to its end
                    while end < len(lowered) and not _SPACE[lowered[end]]:
                        end += 1
            _, h = _segment_words(lowered[at:end])
            hashes.append(h)
            counts[i] += len(h)
            at = end
    flush()
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), counts


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Sorted distinct ``width``-word shingle hashes of each text.

    A text of fewer words gives one shingle, its whole sequence; a text
    without words gives none.
    """
    words, counts = word_hashes(texts)
    acc = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for j in range(width):
        acc = acc * U(0x9FB21C651E98DF25) + words[j:len(words) - width + 1 + j]
    acc = mix64(acc)
    out = []
    at = 0
    for n in counts.tolist():
        if n >= width:
            out.append(np.unique(acc[at:at + n - width + 1]))
        elif n:
            h = U(n)
            with np.errstate(over="ignore"):
                for w in words[at:at + n]:
                    h = h * U(0xD6E8FEB86659FD93) + w
            out.append(mix64(np.array([h], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def rows_of(batch, size: int = 256):
    """Rows of an Arrow batch as tuples, few Python objects at a time."""
    for at in range(0, batch.num_rows, size):
        part = batch.slice(at, size)
        yield from zip(*(c.to_pylist() for c in part.columns), strict=True)
