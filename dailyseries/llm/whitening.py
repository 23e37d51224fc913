"""Whitening of embeddings from exact bit-sliced cross-products.

Entries become integers, and all statistics are exact up to the
eigendecomposition:

* Each dimension's integers, shifted by the dimension's minimum, are packed as
  bit planes, 64 rows to a word; a plane of ones stands for the constant 1.
  The scatter of two dimensions is the sum over their planes k and l of
  ``2**(k + l)`` times the population count of the two planes' AND.
* Every task adds up the scatter of its blocks of rows and emits one row per
  pair of dimensions and 32-bit limb, so sums over tasks stay exact in 64
  bits.
* ``n * n`` times the covariance is ``n * sum(uv) - sum(u) * sum(v)``, taken in
  integers; only then it is divided and decomposed.

The driver holds one matrix of dimension by dimension numbers, whatever the
number of rows; rows are projected by a map.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailyseries.llm.common import materialize

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
BLOCK = 1 << 20      # entries of a block of bit planes
LIMB = 32            # bits of a limb of an exact sum
LEAST = 1e-10        # eigenvalues up to this share of the largest count as zero
LARGEST = 2.0 ** 60  # integers beyond it are no finite entries
WORD = 64


def integer_rows(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, x): the rows whose vector has only finite, non-null entries c,
    with x = floor(64 c) + 1000000 each; entries beyond ``LARGEST`` count as
    not finite."""
    c = F.transform(column, lambda e: e.cast("double"))
    good = F.forall("c", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < LARGEST / SCALE))
    rows = vectors.where(F.col(column).isNotNull()).select("vec_id", c.alias("c")).where(good)
    return rows.select("vec_id", F.transform("c", lambda e: F.floor(e * SCALE) + F.lit(SHIFT).cast("long")).alias("x"))


def same_width(rows: DataFrame) -> tuple[DataFrame, int]:
    """``rows`` with shorter ``x`` filled up with ``SHIFT``, an entry of 0, and
    the width of all (0 for an empty table)."""
    width = rows.agg(F.max(F.size("x"))).first()[0] or 0
    zeros = F.array_repeat(F.lit(SHIFT).cast("long"), F.lit(width) - F.size("x"))
    return rows.withColumn("x", F.when(F.size("x") == width, F.col("x")).otherwise(F.concat("x", zeros))), width


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def bit_planes(u: np.ndarray, bits: list[int]) -> np.ndarray:
    """Planes of the columns of ``u`` (not negative), lowest bit first, as words
    of 64 rows."""
    rows = -(-len(u) // WORD) * WORD
    planes = np.zeros((sum(bits), rows // 8), np.uint8)
    at = 0
    for d, k in enumerate(bits):
        for b in range(k):
            packed = np.packbits((u[:, d] >> b) & 1 > 0, bitorder="little")
            planes[at, :len(packed)] = packed
            at += 1
    return planes.view(np.uint64)


def plane_counts(planes: np.ndarray) -> np.ndarray:
    """Population counts of the ANDs of all pairs of planes."""
    out = np.zeros((len(planes),) * 2, np.int64)
    for p in range(len(planes)):
        out[p, p:] = np.bitwise_count(planes[p] & planes[p:]).sum(axis=1, dtype=np.int64)
    return np.triu(out) + np.triu(out, 1).T


def scatter(u: np.ndarray, bits: list[int]) -> np.ndarray:
    """Exact ``u.T @ u`` of a block; Python integers where 64 bits are too few."""
    weights = [1 << b for k in bits for b in range(k)]
    roomy = 2 * max(bits) + len(u).bit_length() < 62
    w = np.array(weights, np.int64 if roomy else object)
    starts = np.concatenate(([0], np.cumsum(bits)[:-1]))
    weighted = plane_counts(bit_planes(u, bits)).astype(w.dtype) * w[:, None] * w
    return np.add.reduceat(np.add.reduceat(weighted, starts, axis=0), starts, axis=1)


def scatter_rows(low: list[int], high: list[int]):
    """Map a partition of distinct ``x`` to its scatter (i, j, limb, part),
    i <= j; dimension ``len(low)`` is the constant 1."""
    width, block = len(low), max(WORD, BLOCK // len(low))
    bits = [max(1, int(h - lo).bit_length()) for lo, h in zip(low, high, strict=True)] + [1]
    schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("limb", pa.int32()), ("part", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, size = np.zeros((width + 1,) * 2, object), [], 0

        def flush() -> None:
            nonlocal size
            if size:
                u = np.ones((size, width + 1), np.int64)
                u[:, :width] = np.concatenate(held) - np.array(low, np.int64)
                for at in range(0, size, block):
                    total[...] += scatter(u[at:at + block], bits).astype(object)
            held.clear()
            size = 0

        for batch in batches:
            held.append(_matrix(batch.column(0), width))
            size += batch.num_rows
            if size >= block:
                flush()
        flush()
        rows = [(i, j, limb, int(total[i, j]) >> LIMB * limb & (1 << LIMB) - 1) for i in range(width + 1)
                for j in range(i, width + 1) for limb in range(-(-int(total[i, j]).bit_length() // LIMB))]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types, strict=True)],
                                             schema=schema)

    return run


@dataclass
class Whitening:
    """The fitted transform: n distinct vectors, minima ``low`` and exact sums
    ``above`` of what lies above them, eigenvalues and unit eigenvectors
    (columns) by falling eigenvalue, trace of the covariance."""

    n: int
    low: list[int]
    above: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float


def fit(distinct: DataFrame, width: int, components: int = COMPONENTS) -> Whitening:
    """Fit over the distinct vectors ``x`` of a table that is not empty."""
    ends = (distinct.select(F.posexplode("x").alias("d", "e")).groupBy("d")
            .agg(F.min("e").alias("lo"), F.max("e").alias("hi")).orderBy("d").collect())  # one row a dimension
    low = [r["lo"] for r in ends]
    parts = distinct.select("x").mapInArrow(scatter_rows(low, [r["hi"] for r in ends]), "i int, j int, limb int, part long")
    sums: dict[tuple[int, int], int] = {}
    for r in parts.groupBy("i", "j", "limb").agg(F.sum("part").alias("part")).collect():  # rows by dimension pair and limb
        sums[r["i"], r["j"]] = sums.get((r["i"], r["j"]), 0) + (r["part"] << LIMB * r["limb"])
    n = sums[width, width]
    above = [sums.get((d, width), 0) for d in range(width)]
    cov = np.zeros((width, width))
    for i in range(width):
        for j in range(i, width):
            cov[i, j] = cov[j, i] = (n * sums.get((i, j), 0) - above[i] * above[j]) / n ** 2
    values, vectors = np.linalg.eigh(cov)
    keep = [k for k in range(width - 1, -1, -1) if values[k] > LEAST * max(values[-1], 0)][:components]
    trace = sum(n * sums.get((d, d), 0) - above[d] ** 2 for d in range(width)) / n ** 2
    return Whitening(n, low, above, values[keep], vectors[:, keep], trace)


def centred(model: Whitening, x: np.ndarray) -> np.ndarray:
    """``n * x - S``, exact; Python integers where 64 bits are too few."""
    u = x - np.array(model.low, np.int64)  # both within 2**62
    most = int(np.abs(u).max(initial=0)) * model.n + max(map(abs, model.above))
    if most < 1 << 62:
        return u * model.n - np.array(model.above, np.int64)
    return u.astype(object) * model.n - np.array(model.above, object)


def projected(model: Whitening, c: np.ndarray) -> np.ndarray:
    """Whitened rows from ``n * x - S``."""
    mean_free = c / model.n if c.dtype != object else np.array([[v / model.n for v in row] for row in c], float)
    return mean_free.reshape(len(c), -1) @ (model.vectors / np.sqrt(model.values))


def deviations(c: np.ndarray) -> list[int | None]:
    """Exact sums of squares of the rows; None beyond 64 bits."""
    if c.dtype != object and int(np.abs(c).max(initial=0)) ** 2 * max(1, c.shape[1]) < 1 << 63:
        return (c * c).sum(axis=1).tolist()
    sums = [sum(int(v) ** 2 for v in row) for row in c]
    return [s if s < 1 << 63 else None for s in sums]


def moment_rows(model: Whitening):
    """Map distinct vectors to the sums (i, j, total) of products of whitened
    components; component ``len(values)`` is the constant 1."""
    k = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))
        for batch in batches:
            z = np.ones((batch.num_rows, k + 1))
            z[:, :k] = projected(model, centred(model, _matrix(batch.column(0), len(model.low))))
            total += z.T @ z
        i, j = np.triu_indices(k + 1)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])],
                                         names=["i", "j", "total"])

    return run


def identity_error(model: Whitening, distinct: DataFrame) -> float:
    """Largest absolute entry of the measured covariance of the whitened fit
    list minus the identity.  Components have a mean of 0 up to rounding, so
    the mean's product can be taken off the moments."""
    k = len(model.values)
    sums = distinct.select("x").mapInArrow(moment_rows(model), "i int, j int, total double")
    m = np.zeros((k + 1, k + 1))
    for r in sums.groupBy("i", "j").agg(F.sum("total").alias("total")).collect():  # 17 * 9 rows
        m[r["i"], r["j"]] = m[r["j"], r["i"]] = r["total"]
    mean = m[:k, k] / model.n
    return float(np.abs(m[:k, :k] / model.n - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))


def whiten(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error):
    one row per kept row of ``vectors`` and component.

    Rows whose vector is null or holds null, NaN or infinite entries (or
    entries beyond 2**54) are left out.  A vector shorter than the longest one
    is filled up with zeros.  A null vec_id is an id like any other, and
    repeated rows each get their own rows; they count once in the fit.
    Components of equal eigenvalue come in the solver's order.  Components
    without variance (eigenvalue up to 1e-10 of the largest) can't be
    scaled to one and are left out, so fewer than ``components`` may come;
    one distinct vector alone or an empty table gives no rows.  ``deviation``
    is exact, and null where it is beyond 64 bits.  Other columns are not
    read, whatever their names.
    """
    rows, width = same_width(integer_rows(vectors, column))
    out = (f"vec_id {dict(rows.dtypes)['vec_id']}, component int, n long, deviation long, whitened double, "
           "explained double, identity_error double")
    none = vectors.sparkSession.createDataFrame([], out)
    if not width:
        return none
    distinct = materialize(rows.select("x").distinct(), "wh-distinct")
    model = fit(distinct, width, components)
    if not len(model.values):
        return none
    error, explained, k = identity_error(model, distinct), model.values / model.trace, len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = centred(model, _matrix(batch.column(1), width))
            rep = np.repeat(np.arange(batch.num_rows), k)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(rep)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), batch.num_rows)),
                pa.array(np.full(len(rep), model.n, np.int64)),
                pa.array(deviations(c), pa.int64()).take(pa.array(rep)),
                pa.array(projected(model, c).reshape(-1)),
                pa.array(np.tile(explained, batch.num_rows)),
                pa.array(np.full(len(rep), error)),
            ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, out)
