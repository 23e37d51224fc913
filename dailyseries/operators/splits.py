"""Chronological splits and validation folds.

A split only needs its cut points.  So the rows at the cut positions are found
by counting (``plans.selection``: rows per bin, then inside the boundary bins;
nothing is sorted), and every row is assigned by a lexicographic comparison
against them -- a plain predicate on the wide frame: no join, no checkpoint,
no single-task window.  Order columns that can't be counted on (text, reals)
are ranked with ``global_row_number`` instead.
Per-series splits use ``row_number`` over the series window.

Sizes follow the reference exactly: ``int(n * ratio)`` in Python float
arithmetic, scikit-learn's fold sizes for k-fold, stratified k-fold and
the expanding time-series folds.  Order columns must be unique per row and
not null (daily series: (time, series_key)); anything else raises.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dailyseries.operators.windows import KEY, TIME
from dailyseries.plans.ranking import global_row_number
from dailyseries.plans.selection import Selection, countable


def positions(df: DataFrame, order_cols: Sequence[str] = (TIME, KEY), per_series: bool = False,
              key: str = KEY, time: str = TIME, pos: str = "_pos", n: str = "_n") -> DataFrame:
    """Add 0-based position ``pos`` and the population size ``n``.

    ``per_series=True`` positions rows inside their own series (bounded by the
    series length); otherwise one global order over ``order_cols`` and ``n``
    is a literal.
    """
    if per_series:
        w = Window.partitionBy(key).orderBy(time)
        return df.withColumns({pos: F.row_number().over(w) - 1,
                               n: F.count(F.lit(1)).over(Window.partitionBy(key))})
    ranked, total = global_row_number(df, list(order_cols), name="_rn")
    return ranked.withColumns({pos: F.col("_rn") - 1, n: F.lit(total)}).drop("_rn")


def _int_mul(n: Column, ratio: float) -> Column:
    """Python's ``int(n * ratio)`` for n >= 0 (same double multiply, floored)."""
    return F.floor(n.cast("double") * F.lit(float(ratio)))


class _Ranked:
    """:class:`Selection` for order columns of any type, by a distributed rank."""

    def __init__(self, df: DataFrame, columns: Sequence[str]):
        self.columns, self.types = list(columns), dict(df.dtypes)
        self.ranked, self.n = global_row_number(df.select(*self.columns), self.columns, name="_rn")
        null = reduce(or_, [F.col(c).isNull() for c in self.columns])
        bad = self.ranked.groupBy(*self.columns).count().where((F.col("count") > 1) | null).limit(1).collect()
        if bad:
            raise ValueError(f"order columns {self.columns} must be unique and not null; found {bad[0]}")

    def rows(self, positions: Sequence[int]) -> dict[int, tuple]:
        want = [int(p) + 1 for p in positions]
        return {r["_rn"] - 1: tuple(r[c] for c in self.columns) for r in self.ranked.where(F.col("_rn").isin(want)).collect()}

    def values(self, row: Sequence) -> list[Column]:
        return [F.lit(v).cast(self.types[c]) for c, v in zip(self.columns, row, strict=True)]


class Cuts:
    """Rows at given 0-based positions of a total order, for predicates.

    The order columns must identify a row: a null or a tie among them raises,
    since such rows have no defined side of a cut.
    """

    def __init__(self, df: DataFrame, order_cols: Sequence[str]):
        self.order_cols = list(order_cols)
        kind = Selection if countable(df, self.order_cols) else _Ranked
        self.order = kind(df, self.order_cols)
        self.n = self.order.n
        self._rows: dict[int, tuple] = {}

    def fetch(self, positions: Sequence[int]) -> None:
        """Find the rows at ``positions``; as many as the caller's folds, not as the data."""
        want = sorted({int(p) for p in positions if 0 <= p < self.n} - set(self._rows))
        if want:
            self._rows |= self.order.rows(want)

    def row(self) -> Column:
        return F.struct(*[F.col(c).alias(c) for c in self.order_cols])

    def point(self, position: int) -> Column:
        """The order columns at ``position`` (0 <= position < n)."""
        self.fetch([position])
        return F.struct(*[v.alias(c) for c, v in zip(self.order_cols, self.order.values(self._rows[position]))])

    def before(self, position: int) -> Column:
        """Predicate: the row's position is < ``position``."""
        if position <= 0:
            return F.lit(False)
        if position >= self.n:
            return F.lit(True)
        return self.row() < self.point(position)

    def segment(self, positions: Sequence[int]) -> Column:
        """How many of the ascending ``positions`` are at or before the row."""
        self.fetch(positions)
        always = sum(p <= 0 for p in positions)
        points = [self.point(p) for p in positions if 0 < p < self.n]
        if not points:
            return F.lit(always)
        row = self.row()
        return F.size(F.filter(F.array(*points), lambda p: p <= row)) + always


def chrono_split(df: DataFrame, train_ratio: float = 0.7, val_ratio: float = 0.15,
                 order_cols: Sequence[str] = (TIME, KEY), per_series: bool = False,
                 split_col: str = "split", key: str = KEY, time: str = TIME,
                 cuts: "Cuts | None" = None) -> DataFrame:
    """L1: first int(n*train_ratio) rows train, next int(n*val_ratio) val, rest test.

    ``cuts`` may be a ``Cuts`` already built on the same rows and order."""
    if per_series:
        p = positions(df, order_cols, True, key, time)
        tr = _int_mul(F.col("_n"), train_ratio)
        va = tr + _int_mul(F.col("_n"), val_ratio)
        split = F.when(F.col("_pos") < tr, "train").when(F.col("_pos") < va, "val").otherwise("test")
        return p.withColumn(split_col, split).drop("_pos", "_n")
    cuts = cuts or Cuts(df, order_cols)
    tr = int(cuts.n * train_ratio)
    va = tr + int(cuts.n * val_ratio)
    cuts.fetch([tr, va])
    split = F.when(cuts.before(tr), "train").when(cuts.before(va), "val").otherwise("test")
    return df.withColumn(split_col, split)


def _fold_columns(cuts: Cuts, starts: Sequence[int], size_of, df: DataFrame) -> DataFrame:
    """Test fold k covers [starts[k], starts[k] + size_of(k)).  Adds ``fold``
    (test fold or null), ``train_end`` (first test position of that fold) and
    ``train_from`` (first fold whose training rows [0, starts[k]) include the
    row: 0 before the first test window, j + 1 inside fold j's window, null
    after the last window)."""
    if not starts:
        none = F.lit(None)
        return df.withColumns({"fold": none.cast("int"), "train_end": none.cast("long"), "train_from": F.lit(0)})
    # fold k starts where the one before it ends
    ends = [s0 + size_of(k) for k, s0 in enumerate(starts)]
    seg = cuts.segment([starts[0], *ends])  # 0 before the first fold, k + 1 in fold k
    inside = (seg > 0) & (seg <= len(starts))
    return df.withColumns({
        "fold": F.when(inside, seg - 1).cast("int"),
        "train_end": F.when(inside, F.get(F.array(*[F.lit(s0) for s0 in starts]), seg - 1)).cast("long"),
        "train_from": F.when(seg <= len(starts), seg).cast("int")})


def walk_forward_folds(df: DataFrame, initial_train_size: float = 0.6, test_size: float = 0.1,
                       order_cols: Sequence[str] = (TIME, KEY), key: str = KEY, time: str = TIME) -> DataFrame:
    """L2: test fold index of each row (null if in no test window).

    Fold k trains on [0, e_k) and tests on [e_k, e_k + s) with
    e_k = int(n*initial) + k*s, s = int(n*test_size), while e_k + s <= n.
    Adds ``train_end`` (= e_k) on test rows.  s = 0 raises (the reference
    loops forever there).
    """
    cuts = Cuts(df, order_cols)
    e0, s = int(cuts.n * initial_train_size), int(cuts.n * test_size)
    if s <= 0:
        raise ValueError("test_size gives 0 rows per fold")
    starts = list(range(e0, cuts.n - s + 1, s))
    return _fold_columns(cuts, starts, lambda k: s, df)


def time_series_folds(df: DataFrame, n_splits: int = 5, order_cols: Sequence[str] = (TIME, KEY),
                      key: str = KEY, time: str = TIME) -> DataFrame:
    """L3: expanding-window folds: test size n // (k+1), tests at the end.

    Adds ``fold`` (test fold or null) and ``train_end`` (first test row)."""
    cuts = Cuts(df, order_cols)
    ts = cuts.n // (n_splits + 1)
    if ts <= 0:
        raise ValueError(f"cannot make {n_splits} folds of {cuts.n} rows")
    starts = [cuts.n - n_splits * ts + i * ts for i in range(n_splits)]
    return _fold_columns(cuts, starts, lambda k: ts, df)


def kfold(df: DataFrame, k: int = 3, order_cols: Sequence[str] = (TIME, KEY)) -> DataFrame:
    """Unshuffled contiguous k-fold; the first n % k folds get one extra row."""
    cuts = Cuts(df, order_cols)
    q, rem = divmod(cuts.n, k)
    sizes = [q + 1 if i < rem else q for i in range(k)]
    starts = [sum(sizes[:i]) for i in range(k)]
    out = _fold_columns(cuts, starts, lambda i: sizes[i], df)
    return out.drop("train_end", "train_from")


def stratified_folds(df: DataFrame, label: str = "y", k: int = 5,
                     order_key: str | Sequence[str] = "player_id") -> DataFrame:
    """L4: unshuffled stratified k-fold with scikit-learn's allocation.

    Classes sorted; in the label-sorted array class c spans [a_c, b_c); fold i
    receives #{j in [a_c, b_c): j = i mod k} rows of class c, taken in
    ``order_key`` order.
    """
    keys = [order_key] if isinstance(order_key, str) else list(order_key)
    cuts = Cuts(df, [label, *keys])
    sizes = sorted((r[0], r[1]) for r in df.groupBy(label).count().collect())  # one row per class

    def cnt(m: int, i: int) -> int:  # #{j in [0, m): j mod k == i}
        return max(0, (m - i + k - 1) // k)

    ends, folds = [], []
    a = 0
    for _, nc in sizes:
        b, cum = a + nc, 0
        for i in range(k):
            cum += cnt(b, i) - cnt(a, i)
            ends.append(a + cum)
            folds.append(i)
        a = b
    if not ends:
        return df.withColumn("fold", F.lit(None).cast("int"))
    fold = F.get(F.array(*[F.lit(i) for i in folds]), cuts.segment(ends))
    return df.withColumn("fold", fold.cast("int"))
