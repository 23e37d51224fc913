"""Training-corpus pipeline: five stages over ``documents``.

Each stage works on everything the stage before it kept.  Its result is
written as Parquet and read again as the next stage's input, so a stage
drops the scratch tables that the stage called before it made, and no others.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dailyseries.llm import decontam, langid, line_dedup, minhash, mixing
from dailyseries.llm.common import drop_table, release, scratch_mark, scratch_since, table
from dailyseries.session import scratch_path


# scratch tables behind the result of the stage called last
_BEHIND: list[str] = []


def stage(function: Callable[[SparkSession, DataFrame, str], DataFrame]):
    """A stage that frees the scratch of the stage called before it, whose
    result has been written by then, and notes its own."""

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark, _BEHIND)
        mark = scratch_mark()
        try:
            return function(spark, docs, sf_dir)
        finally:
            _BEHIND[:] = scratch_since(mark)

    return run_stage


@stage
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; rejected ones go."""
    own = {c: f"__in_{c}" for c in langid.ADDED if c in docs.columns}
    found = langid.identify(docs.withColumnsRenamed(own), langid.fit(docs))
    return found.where(~F.col("rejected")).select(*[F.col(own.get(c, c)).alias(c) for c in docs.columns])


@stage
def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; text and n_chars follow, no document goes."""
    own = {c: f"__in_{c}" for c in line_dedup.ADDED if c in docs.columns}
    out = line_dedup.dedup_lines(docs.withColumnsRenamed(own))
    text = F.when(F.col("n_dropped") > 0, F.col("kept_text")).otherwise(F.col("text"))
    changed = {"text": text}
    if "n_chars" in docs.columns:
        changed["n_chars"] = (F.when(F.col("n_dropped") > 0, F.char_length("kept_text").cast("long"))
                              .otherwise(F.col("n_chars")))
    return out.select(*[changed.get(c, F.col(own.get(c, c))).alias(c) for c in docs.columns])


@stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (five-word shingles, 0.8)."""
    return minhash.drop_near_duplicates(docs)


@stage
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go."""
    own = {c: f"__in_{c}" for c in decontam.ADDED if c in docs.columns}
    found = decontam.decontaminate(docs.withColumnsRenamed(own), table(spark, sf_dir, "benchmark"))
    return found.where(~F.col("contaminated")).select(*[F.col(own.get(c, c)).alias(c) for c in docs.columns])


@stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their place in the mixed order."""
    return mixing.schedule(docs, mixing.TARGET, mixing.TARGET_REST)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup_stage), ("near_dedup", near_dedup),
          ("decontaminate", decontaminate), ("mix", mix)]

# Language ID, MinHash candidates and their components have no SQL form; the
# stages are tested one by one and the whole against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, function in STAGES[:-1]:
        path = scratch_path(spark, f"stage-{name}")
        out = function(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if before:  # the stage that read it has been written
            drop_table(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
