"""Order statistics by counting, without sorting rows.

* ``Selection`` -- the rows at given positions of a total order over integer
  and date columns.  A pass counts rows per bin of the range that still
  holds a position, and the next pass looks into that bin only; once one value
  is left, the next order column decides.  A pass is one aggregation that
  combines before its shuffle: no row is sorted or numbered.
* ``column_quantiles`` -- exact quantiles of many columns at once.  Sketches
  bracket each rank, counts say exactly how many values lie below the bracket,
  and the few values inside it are looked at.  Rows stay rows: no
  (column, value) table is made.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce
from math import ceil, floor
from operator import or_

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dailyseries.plans.ranking import exact_quantiles

BINS = 4096          # counts per range and pass
CELLS = 100          # ranges counted in one pass
ACCURACY = 10_000    # of the sketches: ranks are off by n / ACCURACY at most
FEW = 1000           # values looked at per column

_WHOLE = ("tinyint", "smallint", "int", "bigint")


def _number(c: str, kind: str) -> Column | None:
    """An order-preserving long of a column, if its type has one."""
    if kind in _WHOLE or kind == "boolean":
        return F.col(c).cast("long")
    if kind == "date":
        return F.unix_date(c).cast("long")
    if kind == "timestamp":
        return F.unix_micros(c)
    return None


def _value(n: int, kind: str) -> Column:
    """The column value of a number of :func:`_number`."""
    if kind == "date":
        return F.date_from_unix_date(F.lit(n).cast("int"))
    if kind == "timestamp":
        return F.timestamp_micros(F.lit(n).cast("long"))
    return F.lit(n).cast("long").cast(kind)


def countable(df: DataFrame, columns: Sequence[str]) -> bool:
    """Whether all ``columns`` have types that positions can be counted on."""
    types = dict(df.dtypes)
    return all(types[c] in (*_WHOLE, "boolean", "date", "timestamp") for c in columns)


@dataclass(frozen=True)
class _Cell:
    """A range that holds positions: fixed values of the first order columns and
    bounds of the next; ``before`` rows come ahead of it."""

    fixed: tuple[int, ...]
    low: int
    high: int
    before: int


class Selection:
    """Rows at positions of the order over ``columns``, which must identify a row:
    a null or a tie among them raises, since such rows have no defined place."""

    def __init__(self, df: DataFrame, columns: Sequence[str]):
        self.columns = list(columns)
        self.types = dict(df.dtypes)
        names = [f"k{i}" for i in range(len(self.columns))]
        self.keys = df.select(*[_number(c, self.types[c]).alias(k) for c, k in zip(self.columns, names)])
        self.keys = self.keys.persist(StorageLevel.DISK_ONLY)  # narrow, read once per pass
        self.names = names
        null = reduce(or_, [F.col(k).isNull() for k in names])
        row = F.struct(F.col("c"), *[F.col(k) for k in names])
        seen = self.keys.groupBy(*names).agg(F.count(F.lit(1)).alias("c")).agg(
            F.sum("c").alias("n"), F.max(F.when((F.col("c") > 1) | null, row)).alias("bad"),
            F.min("k0").alias("low"), F.max("k0").alias("high")).first()
        if seen["bad"] is not None:
            self.close()
            raise ValueError(f"order columns {self.columns} must be unique and not null; found {seen['bad']}")
        self.n = seen["n"] or 0
        self.top = _Cell((), seen["low"], seen["high"], 0) if self.n else None

    def close(self) -> None:
        """Give the kept order columns back; positions found stay."""
        self.keys.unpersist()

    def _bin(self, cell: _Cell) -> Column:
        k, span = F.col(f"k{len(cell.fixed)}"), cell.high - cell.low
        width = -(-(span + 1) // BINS)
        if span < 1 << 62:
            return F.call_function("div", k - F.lit(cell.low).cast("long"), F.lit(width).cast("long"))
        return F.floor((k.cast("double") - float(cell.low)) / float(width)).cast("long")  # as good for a first cut

    def _inside(self, cell: _Cell) -> Column:
        at = F.col(f"k{len(cell.fixed)}").between(cell.low, cell.high)
        return reduce(lambda a, b: a & b, [F.col(f"k{i}") == v for i, v in enumerate(cell.fixed)], at)

    def _count(self, cells: Sequence[_Cell]) -> dict[int, list]:
        """Rows of each cell by bin, with the bounds of the bin's values in this
        order column and the next."""
        none, j = F.lit(None).cast("long"), [len(c.fixed) for c in cells]

        def of_cell(values: Sequence[Column]) -> Column:
            at = F.col("cell")
            return reduce(lambda out, i: F.when(at == i, values[i]).otherwise(out), range(len(cells)), none)

        cell = reduce(lambda out, i: F.when(self._inside(cells[i]), i).otherwise(out), range(len(cells)),  # they don't overlap
                      F.lit(None).cast("int"))
        here = [F.col(self.names[d]) for d in j]
        after = [F.col(self.names[d + 1]) if d + 1 < len(self.names) else none for d in j]
        rows = (self.keys.withColumn("cell", cell).where(F.col("cell").isNotNull())
                .select("cell", of_cell([self._bin(c) for c in cells]).alias("bin"), of_cell(here).alias("v"),
                        of_cell(after).alias("w"), *self.names).groupBy("cell", "bin")
                .agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("least"), F.max("v").alias("most"),
                     F.min("w").alias("next_least"), F.max("w").alias("next_most"), *[F.min(k).alias(k) for k in self.names]))
        out: dict[int, list] = {}
        for r in rows.collect():  # at most BINS rows a cell
            out.setdefault(r["cell"], []).append(r)
        return {i: sorted(b, key=lambda r: r["least"]) for i, b in out.items()}

    def rows(self, positions: Sequence[int]) -> dict[int, tuple[int, ...]]:
        """The order columns, as numbers, at 0-based ``positions`` below ``n``."""
        found: dict[int, tuple[int, ...]] = {}
        open_cells: dict[_Cell, list[int]] = {}
        wanted = sorted({p for p in positions if 0 <= p < self.n})
        if wanted:
            open_cells[self.top] = wanted
        while open_cells:
            batch = list(open_cells)[:CELLS]
            counted = self._count(batch)
            for i, cell in enumerate(batch):
                here = open_cells.pop(cell)
                before = cell.before
                for b in counted[i]:
                    inside = [p for p in here if before <= p < before + b["c"]]
                    if inside and b["c"] == 1:  # the minima are the row itself
                        found |= dict.fromkeys(inside, tuple(b[k] for k in self.names))
                    elif inside and b["least"] < b["most"]:
                        open_cells[replace(cell, low=b["least"], high=b["most"], before=before)] = inside
                    elif inside:  # several rows of one value: the next column tells them apart
                        open_cells[_Cell((*cell.fixed, b["least"]), b["next_least"], b["next_most"], before)] = inside
                    before += b["c"]
        return found

    def values(self, numbers: Sequence[int]) -> list[Column]:
        """Numbers of one row as values of the order columns."""
        return [_value(n, self.types[c]) for n, c in zip(numbers, self.columns, strict=True)]


# ------------------------------------------------------------------ column quantiles
@dataclass
class _Bracket:
    """Values that hold the two neighbouring ranks of a quantile: strictly between
    ``low`` and ``high`` or equal to one of them; None is unbounded."""

    n: int
    below: int = 0            # values before the bracket
    inside: int = 0           # values in it
    low: float | None = None
    high: float | None = None


def _sketch(c: Column, b: _Bracket, first: int, last: int) -> Column:
    """Bounds of the values of ranks first..last among the bracket's values."""
    slack = 2 / ACCURACY
    lo, hi = max(0.0, first / b.inside - slack), min(1.0, (last + 1) / b.inside + slack)
    return F.percentile_approx(c, [lo, hi], ACCURACY)


def _within(c: str, b: _Bracket) -> Column:
    x = F.col(c)
    return F.when((x >= b.low) & (x <= b.high) if b.low is not None else x.isNotNull(), x)


def column_quantiles(df: DataFrame, columns: Sequence[str], q: float) -> dict[str, float | None]:
    """The exact ``q``-quantile of every column, linear between neighbouring
    values; None for a column without values.  NaN must be null before."""
    columns = list(columns)
    if not columns:
        return {}
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).persist(StorageLevel.DISK_ONLY)
    try:
        row = rows.agg(*[F.count(c).alias(c) for c in columns]).first()
        brackets = {c: _Bracket(row[c], 0, row[c]) for c in columns}
        out: dict[str, float | None] = {c: None for c, b in brackets.items() if not b.n}
        while todo := [c for c in columns if c not in out]:
            ranks = {c: (floor((brackets[c].n - 1) * q), ceil((brackets[c].n - 1) * q)) for c in todo}
            small = [c for c in todo if brackets[c].inside <= FEW]
            if small:
                out |= _looked_up(rows, {c: brackets[c] for c in small}, ranks, q)
                continue
            got = rows.agg(*[_sketch(_within(c, brackets[c]), brackets[c], ranks[c][0] - brackets[c].below,
                                     ranks[c][1] - brackets[c].below).alias(c) for c in todo]).first()
            bounds = {c: got[c] for c in todo}
            counts = rows.agg(*[x for c in todo for x in (
                F.count_if(F.col(c) < bounds[c][0]).alias(f"{c}_below"), F.count_if(F.col(c) <= bounds[c][0]).alias(f"{c}_low"),
                F.count_if(F.col(c) < bounds[c][1]).alias(f"{c}_high"), F.count_if(F.col(c) <= bounds[c][1]).alias(f"{c}_to"))]).first()
            for c in todo:
                (lo, hi), (first, last), b = bounds[c], ranks[c], brackets[c]
                below, low, high, to = (counts[f"{c}_{x}"] for x in ("below", "low", "high", "to"))
                values = {lo: (below, low), hi: (high, to)}
                at = [next((v for v, (a, z) in values.items() if a <= k < z), None) for k in (first, last)]
                if None not in at:  # both ranks are copies of a bound
                    out[c] = at[0] + ((b.n - 1) * q - first) * (at[1] - at[0])
                elif not (below <= first and last < to):
                    out[c] = exact_quantiles(rows, c, [q]).first()["value"]  # the sketch was off: sort instead
                elif to - below < b.inside:
                    brackets[c] = _Bracket(b.n, below, to - below, lo, hi)
                else:  # many copies of a bound: leave them out
                    out[c] = _between(rows, c, (lo, low), (hi, high), (first, last), (b.n - 1) * q - first)
        return {c: out[c] for c in columns}
    finally:
        rows.unpersist()


def _looked_up(rows: DataFrame, brackets: dict[str, _Bracket], ranks: dict[str, tuple[int, int]], q: float) -> dict[str, float]:
    got = rows.agg(*[F.sort_array(F.collect_list(_within(c, b))).alias(c) for c, b in brackets.items()]).first()
    out = {}
    for c, b in brackets.items():  # at most FEW values a column
        first, last = (got[c][k - b.below] for k in ranks[c])
        out[c] = first + ((b.n - 1) * q - ranks[c][0]) * (last - first)
    return out


def _between(rows: DataFrame, c: str, low: tuple[float, int], high: tuple[float, int], ranks: tuple[int, int],
             share: float) -> float:
    """A quantile whose ranks are copies of a bound or lie strictly between two."""
    (lo, to_low), (hi, to_high) = low, high
    inner = rows.where((F.col(c) > lo) & (F.col(c) < hi)).select(c)
    value = {}
    for k in ranks:
        if k < to_low:
            value[k] = lo
        elif k >= to_high:
            value[k] = hi
        else:  # a column of its own, and a smaller one
            n = to_high - to_low
            value[k] = column_quantiles(inner, [c], (k - to_low) / (n - 1) if n > 1 else 0.0)[c]
    return value[ranks[0]] + share * (value[ranks[1]] - value[ranks[0]])
