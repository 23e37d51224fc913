"""CSV records with quoted newlines, read in as many tasks as the file has splits.

Physical lines come from the splittable text source, with their file, their
byte range and their order in it.  Whether a line ends inside a quoted field
depends on whether it began inside one, so every line is a function on
{outside, inside}: constant, unchanged or flipped.  These functions compose, so

* a window per byte range gives every line its state for a given state at the
  range's start,
* a table of one row per byte range, folded in file order, gives these,
* lines that begin outside begin a record; the lines of records that span
  several are put together by (range, record), all others pass through.

A quote opens a field only at the field's start, and a doubled quote inside a
field is a character, as the CSV parser reads it.  ``from_csv`` then
parses every record on its own.
"""

from __future__ import annotations

import csv
import io
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

OUT, IN, CLOSED = 0, 1, 2  # outside a quoted field, inside, just behind its closing quote
RANGE = ["file", "start"]


def physical_lines(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> DataFrame:
    """(file, start, at, line): lines in the order ``at`` of byte range ``start``."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                       F.monotonically_increasing_id().alias("at"),
                       F.decode(F.col("value").cast("binary"), encoding).alias("line"))


def _ends_open(line: Column, began: int, delimiter: str) -> Column:
    """Whether a line that begins outside (0) or inside (1) a field ends inside one."""
    between = F.split(line, '"')  # the last piece ends at no quote
    first = F.lit(True)
    begin = F.struct(F.lit(began).alias("state"), first.alias("first"))

    def step(acc: Column, piece: Column) -> Column:
        opens = (piece.endswith(delimiter) | (acc["first"] & (piece == ""))  # at a field's start
                 | ((acc["state"] == CLOSED) & (piece == "")))               # a doubled quote
        state = F.when(acc["state"] == IN, CLOSED).when(opens, IN).otherwise(OUT)
        return F.struct(state.alias("state"), F.lit(False).alias("first"))

    last = F.aggregate(F.slice(between, 1, F.size(between) - 1), begin, step, lambda acc: acc["state"] == IN)
    return F.when(line.contains('"'), last).otherwise(F.lit(bool(began)))


def _composed(rows: DataFrame, by: list[str], order: str, start: Column, out: str) -> DataFrame:
    """``rows`` with ``out``: the state before each row, when ``start`` is the
    state before the first; ``t0`` and ``t1`` are the row's function."""
    upto = Window.partitionBy(*by).orderBy(order)
    before = upto.rowsBetween(Window.unboundedPreceding, -1)
    flip = (F.col("t0") & ~F.col("t1")).cast("int")
    rows = rows.withColumn("_f", F.sum(flip).over(upto.rowsBetween(Window.unboundedPreceding, 0)))
    fixed = F.when(F.col("t0") == F.col("t1"), F.struct(F.col("t0").alias("c"), F.col("_f").alias("f")))
    rows = rows.withColumns({"_fixed": F.last(fixed, ignorenulls=True).over(before),
                             "_b": F.coalesce(F.lag("_f", 1).over(upto), F.lit(0))})
    base = F.coalesce(F.col("_fixed.c"), start)
    flips = F.col("_b") - F.coalesce(F.col("_fixed.f"), F.lit(0))
    return rows.withColumn(out, base != (flips % 2 == 1)).drop("_f", "_fixed", "_b")


def records(lines: DataFrame, delimiter: str = ",") -> DataFrame:
    """(file, start, number, record): logical records of :func:`physical_lines`;
    ``number`` counts the records that begin in the byte range ``start``."""
    rows = lines.withColumns({"t0": _ends_open(F.col("line"), 0, delimiter), "t1": _ends_open(F.col("line"), 1, delimiter)})
    # both states of a range at once: it begins outside or inside
    both = _composed(_composed(rows, RANGE, "at", F.lit(False), "s0"), RANGE, "at", F.lit(True), "s1")
    upto = Window.partitionBy(*RANGE).orderBy("at")
    begun = upto.rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumns({f"n{k}": F.sum((~F.col(f"s{k}")).cast("long")).over(begun) for k in (0, 1)}
                            | {f"next{k}": F.lead(f"s{k}", 1).over(upto) for k in (0, 1)})
    # what a whole range does: the state behind its last line, and how many records begin
    ends = [F.max_by(F.when(F.col(f"s{k}"), F.col("t1")).otherwise(F.col("t0")), "at").alias(f"t{k}") for k in (0, 1)]
    ranges = both.groupBy(*RANGE).agg(*ends, F.max("n0").alias("m0"), F.max("n1").alias("m1"))
    ranges = _composed(ranges, ["file"], "start", F.lit(False), "inside")
    in_file = Window.partitionBy("file").orderBy("start")
    m = F.when(F.col("inside"), F.col("m1")).otherwise(F.col("m0"))
    with_records = F.when(m > 0, F.struct(F.col("start").alias("start"), m.alias("number")))
    ranges = ranges.select(
        F.col("file").alias("r_file"), F.col("start").alias("r_start"), "inside",
        F.last(with_records, ignorenulls=True).over(in_file.rowsBetween(Window.unboundedPreceding, -1)).alias("before"),
        F.lead("inside", 1).over(in_file).alias("after"))
    j = both.join(ranges, (both["file"] == ranges["r_file"]) & (both["start"] == ranges["r_start"]))

    def of(name: str) -> Column:
        return F.when(F.col("inside"), F.col(f"{name}1")).otherwise(F.col(f"{name}0"))

    number, more = of("n"), F.coalesce(of("next"), F.col("after"), F.lit(False))
    own = F.struct(F.col("start").alias("start"), number.alias("number"))
    j = j.select("file", "start", "at", "line", F.when(number > 0, own).otherwise(F.col("before")).alias("key"),
                 (~of("s") & ~more).alias("whole"))
    single = j.where("whole").select("file", "key", "line")
    pieces = F.array_sort(F.collect_list(F.struct("start", "at", "line")))
    joined = (j.where("not whole").groupBy("file", "key").agg(pieces.alias("p"))
              .select("file", "key", F.array_join(F.transform("p", lambda x: x["line"]), "\n").alias("line")))
    return (single.unionByName(joined)
            .select("file", "key.start", "key.number", F.regexp_replace("line", "\r$", "").alias("record")))


def has_quoted_newlines(lines: DataFrame, delimiter: str = ",") -> bool:
    """Whether any record goes over a line's end: then some line that begins
    outside ends inside.  One pass without a shuffle of lines."""
    return not lines.where(_ends_open(F.col("line"), 0, delimiter)).select("file").limit(1).isEmpty()


def read_quoted_csv(spark: SparkSession, path: str, encoding: str = "ISO-8859-1", delimiter: str = ",") -> DataFrame:
    """All columns as text, like the headed multi-line CSV reader, by as many
    tasks as there are byte ranges.

    Every file's first record is its header; the first file's names the
    columns.  Blank lines between records are skipped."""
    rows = records(physical_lines(spark, path, encoding), delimiter).where("trim(record) <> ''")
    # a file's first record begins in its range 0
    head = rows.where("start = 0 and number = 1").orderBy("file").select("record").first()
    if head is None:
        return spark.createDataFrame([], "value string")
    names = column_names(head["record"], delimiter)
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    parsed = F.from_csv("record", F.lit(schema), {"escape": '"', "sep": delimiter, "mode": "PERMISSIVE"})
    body = rows.where("not (start = 0 and number = 1)")
    return body.select(parsed.alias("r")).select("r.*")


def column_names(record: str, delimiter: str = ",") -> list[str]:
    """Names that the CSV reader gives the columns of a header record: an empty
    name becomes ``_c`` and its place, a repeated one gets its place."""
    fields = next(csv.reader(io.StringIO(record, newline=""), delimiter=delimiter))
    often = Counter(f.lower() for f in fields)
    return [f"_c{i}" if not f else f"{f}{i}" if often[f.lower()] > 1 else f for i, f in enumerate(fields)]
