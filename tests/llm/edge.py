"""Small tables with the awkward cases that every operator must take."""

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "drops string, s string, body string, stream string, rejected string, contaminated string, n int, label int")


def words(seed: int, n: int) -> list[str]:
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 9))) for _ in range(n)]


def frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows of (doc_id, text[, lang[, source]]) with clashing extra columns."""
    full = [((r + (None, None))[:4]) for r in rows]
    return spark.createDataFrame(
        [(i, t, lang, src, None if t is None else len(t), "x", None, "b", "st", "r", "c", 7, None)
         for i, t, lang, src in full], SCHEMA)


def awkward() -> list[tuple]:
    """Nulls, empty and very long texts, ties, repeated rows, shared ids."""
    base = " ".join(words(1, 120))
    long = " ".join(words(2, 30_000))
    return [
        (5, base, "en", "a"), (6, base, "en", "a"), (6, base, "en", "a"),   # copies, a repeated row
        (7, base.upper() + " tail", "en", "b"), (8, None, "en", "b"), (9, "", None, None),
        (10, "  \t\n ", "en", ""), (None, base + " more", "en", "a"), (None, None, None, None),
        (11, "one two", "de", "a"), (11, "three four five six seven", "de", "c"),  # one id, two texts
        (12, long, "de", "c"), (13, "x" * 70_000, "de", "c"), (14, "é" * 300 + "\n" + "É" * 300, "fr", "c"),
        (15, "\x00\x01 nul", "fr", "c"), (16, "𝒳𝒴 𝒵 emoji 😀", "fr", "c"),
    ]
