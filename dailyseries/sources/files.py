"""File scans and sinks.

* ``scan_csv_folder`` -- every ``*.csv`` entry of a folder (suffix in any
  case; a plain file or a Spark output folder) becomes one dataset keyed
  by its stem.  Latin-1, header, pandas' NA tokens to null, column types
  found in ONE aggregation (integer, else double, else text), ``ht``
  converted to centimetres in the same projection.
* ``scan_splits`` / ``write_splits`` -- one table partitioned by split,
  or the reference's ``X_{split}.csv`` / ``y_{split}.csv`` layout joined
  back on the row key.
* ``write_daily_payload`` / ``ingest_daily_payload`` -- documents of
  parallel daily arrays, one per (series, year), to and from rows.
* ``write_submission``, predictions and report round trips.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from dailyseries.functions.height import height_to_cm
from dailyseries.session import path_exists
from dailyseries.sources.quoted import has_quoted_newlines, physical_lines, read_quoted_csv

# fixed values: pandas' default missing-value tokens
PANDAS_NA = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
             "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
SPLITS = ("train", "val", "test")


def _list(spark: SparkSession, folder: str) -> list[tuple[str, str]]:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [(st.getPath().getName(), st.getPath().toString()) for st in fs.listStatus(p)]


def read_csv_typed(spark: SparkSession, path: str, text_columns: Sequence[str] = (),
                   na_values: Sequence[str] = PANDAS_NA, multi_line: bool | None = None) -> DataFrame:
    """Read a headed latin-1 CSV as text, null the NA tokens, then give each
    column the narrowest of boolean / bigint / double / string in ONE aggregation.

    Files are read in splits.  Where a first pass finds a record that goes over
    a line's end (a newline inside a quoted field), records are put together
    from the splits (``sources.quoted``); ``multi_line`` says beforehand whether
    there are such records."""
    if multi_line is None:
        multi_line = has_quoted_newlines(physical_lines(spark, path))
    if multi_line:
        raw = read_quoted_csv(spark, path)
    else:
        raw = (spark.read.option("header", True).option("encoding", "ISO-8859-1")
               .option("inferSchema", False).option("escape", '"').csv(path))
    na = F.array(*[F.lit(v) for v in na_values])
    clean = raw.select(*[F.when(F.array_contains(na, F.col(c)) | F.col(c).isNull(), F.lit(None).cast("string"))
                         .otherwise(F.col(c)).alias(c) for c in raw.columns])
    cand = [c for c in clean.columns if c not in set(text_columns)]
    kinds = {}
    if cand:
        row = clean.agg(*[F.count_if(F.col(c).isNotNull() & F.col(c).try_cast("bigint").isNull()).alias(f"i_{c}")
                          for c in cand],
                        *[F.count_if(F.col(c).isNotNull() & F.col(c).try_cast("double").isNull()).alias(f"d_{c}")
                          for c in cand],
                        *[F.count_if(F.col(c).isNotNull() & ~F.lower(c).isin("true", "false")).alias(f"b_{c}")
                          for c in cand], *[F.count(c).alias(f"n_{c}") for c in cand]).first()
        for c in cand:
            if row[f"n_{c}"] and not row[f"b_{c}"]:
                kinds[c] = "boolean"
                continue
            kinds[c] = "bigint" if row[f"i_{c}"] == 0 else ("double" if row[f"d_{c}"] == 0 else "string")
    return clean.select(*[F.col(c).cast(kinds.get(c, "string")).alias(c) for c in clean.columns])


def scan_csv_folder(spark: SparkSession, folder: str, height_column: str = "ht",
                    multi_line: bool | None = None) -> dict[str, DataFrame]:
    """All ``*.csv`` datasets of a folder; missing folder -> FileNotFoundError."""
    if not path_exists(spark, folder):
        raise FileNotFoundError(f"Data folder not found: {folder}")
    out = {}
    for name, path in sorted(_list(spark, folder)):
        if not name.lower().endswith(".csv"):
            continue
        df = read_csv_typed(spark, path, text_columns=[height_column], multi_line=multi_line)
        if height_column in df.columns:
            df = df.withColumn(height_column, height_to_cm(height_column))
        out[name[:-4]] = df
    return out


def write_splits(df: DataFrame, folder: str, split_col: str = "split", fmt: str = "parquet") -> None:
    """ONE table partitioned by split (X and y stay in the same rows)."""
    df.write.mode("overwrite").partitionBy(split_col).format(fmt).option("header", True).save(folder)


def write_reference_splits(df: DataFrame, folder: str, label: str, key: str = "player_id",
                           split_col: str = "split") -> None:
    """S5 in the reference's file layout: X_{split}.csv and y_{split}.csv
    (y only for train and val), each keeping the row key so scans can
    re-align them by key instead of by position."""
    for s in SPLITS:
        part = df.where(F.col(split_col) == s).drop(split_col)
        part.drop(label).write.mode("overwrite").option("header", True).csv(f"{folder}/X_{s}.csv")
        if s != "test":
            part.select(key, label).write.mode("overwrite").option("header", True).csv(f"{folder}/y_{s}.csv")


def scan_splits(spark: SparkSession, folder: str, key: str = "player_id", split_col: str = "split") -> DataFrame:
    """Read the split files present (absent ones skipped) into one table
    with a ``split`` column; labels joined on the row key."""
    parts = []
    for s in SPLITS:
        xp, yp = f"{folder}/X_{s}.csv", f"{folder}/y_{s}.csv"
        if not path_exists(spark, xp):
            continue
        x = read_csv_typed(spark, xp)
        if path_exists(spark, yp):
            x = x.join(read_csv_typed(spark, yp), key, "left")
        parts.append(x.withColumn(split_col, F.lit(s)))
    if not parts:
        raise FileNotFoundError(f"no split files in {folder}")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


# ------------------------------------------------------------------ S3 / S4
def payload_schema(measures: Sequence[tuple[str, str]]) -> StructType:
    types = {"int": IntegerType(), "double": DoubleType(), "bigint": LongType()}
    daily = StructType([StructField("time", ArrayType(StringType()))]
                       + [StructField(m, ArrayType(types[t])) for m, t in measures])
    return StructType([StructField("series_key", LongType()), StructField("latitude", DoubleType()),
                       StructField("longitude", DoubleType()), StructField("daily", daily)])


def write_daily_payload(df: DataFrame, path: str, key: str = "series_key", time: str = "time") -> list[tuple[str, str]]:
    """Write daily rows as payload documents {series_key, daily: {time: [...], m: [...]}},
    one per (series, calendar year) -- a group of at most 366 days."""
    measures = [(c, t) for c, t in df.dtypes if c not in (key, time)]
    rows = F.sort_array(F.collect_list(F.struct(F.col(time).cast("string").alias("_t"),
                                                *[F.col(m) for m, _ in measures])))
    docs = (df.groupBy(key, F.year(time).alias("_y")).agg(rows.alias("_r"))
              .select(F.col(key).cast("bigint").alias("series_key"), F.struct(
                  F.transform("_r", lambda s: s["_t"]).alias("time"),
                  *[F.transform("_r", _field(m)).alias(m) for m, _ in measures]).alias("daily")))
    docs.write.mode("overwrite").json(path)
    return measures


def _field(name: str):
    return lambda s: s[name]


CORRUPT = "_corrupt"


def _payload(spark: SparkSession, path: str, measures: Sequence[tuple[str, str]], multi_line: bool) -> DataFrame:
    schema = payload_schema(measures).add(CORRUPT, StringType())
    return (spark.read.schema(schema).option("multiLine", multi_line).option("columnNameOfCorruptRecord", CORRUPT)
            .json(path))


def _broken(docs: DataFrame) -> str | None:
    """A record that doesn't parse or holds no daily values, if there is one."""
    text = F.coalesce(F.col(CORRUPT), F.lit("no daily values"))
    rows = docs.where(F.col(CORRUPT).isNotNull() | F.col("daily").isNull()).select("series_key", "latitude", text.alias("t"))
    first = rows.first()
    return None if first is None else first["t"]


def ingest_daily_payload(spark: SparkSession, path: str, measures: Sequence[tuple[str, str]],
                         start: str | None = None, end: str | None = None,
                         multi_line: bool | None = None) -> DataFrame:
    """Payload documents -> one row per day (``inline(arrays_zip)``),
    ``time`` to date, optional inclusive date range.

    Files hold one document a line, which are read in splits, or one document
    laid out over many lines; a first pass tells, or ``multi_line`` says it.
    A record that doesn't parse either way raises, and so does a file with
    several laid-out documents: no document is passed over.
    A document without ``series_key``, as the weather service sends it, is
    keyed by a hash of its latitude and longitude."""
    if multi_line is None:
        multi_line = _broken(_payload(spark, path, measures, False)) is not None
    docs = _payload(spark, path, measures, multi_line)
    bad = _broken(docs)
    if bad is not None:
        raise ValueError(f"not a payload document: {bad[:200]!r}")
    if multi_line:
        begun = (spark.read.text(path).where(F.col("value").startswith("{")).groupBy(F.input_file_name().alias("file"))
                 .count().where(F.col("count") > 1).limit(1).collect())
        if begun:
            raise ValueError(f"{begun[0]['file']} holds several documents laid out over lines; write one a line")
    docs = docs.drop(CORRUPT).withColumn("series_key", F.coalesce("series_key", F.xxhash64("latitude", "longitude")))
    names = ["time"] + [m for m, _ in measures]
    rows = docs.select("series_key", F.inline(F.arrays_zip(*[F.col(f"daily.{n}") for n in names])))
    out = rows.withColumn("time", F.to_date("time"))
    return scan_date_range(out, start, end)


def scan_date_range(df: DataFrame, start: str | None, end: str | None, time: str = "time") -> DataFrame:
    """Inclusive [start, end]; on a parquet date column the bounds reach the scan."""
    if start:
        df = df.where(F.col(time) >= F.lit(start).cast("date"))
    if end:
        df = df.where(F.col(time) <= F.lit(end).cast("date"))
    return df


# ------------------------------------------------------------------ S6-S8
def write_submission(df: DataFrame, path: str) -> None:
    """``player_id, drafted`` CSV with header, no index."""
    df.select("player_id", "drafted").write.mode("overwrite").option("header", True).csv(path)


def read_submission(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.option("header", True)
            .schema("player_id bigint, drafted double").csv(path))


def save_predictions(df: DataFrame, path: str) -> None:
    """Scores to parquet (the reference's .npy)."""
    df.write.mode("overwrite").parquet(path)


def load_predictions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_report(df: DataFrame, path: str) -> None:
    """Evaluation report rows as JSON (types converted by the writer)."""
    df.write.mode("overwrite").json(path)


def load_report(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)
