import pytest

from dailyseries.functions.height import height_to_cm

# golden cases: text -> centimetres (None = not parseable)
CASES = [
    ("6'11''", 210.82), ("6'12''", None), ("1-Jun", 185.42), ("11/May", 180.34), ("5 may", 165.1),
    ("12-Jun", None), ("0-Jun", 182.88), ("5-Sept", 287.02), ("5-Junk", 195.58), ("6'11\"", None),
    ("", None), ("   ", None), (None, None), ("7'0''", 213.36), (" 6' 3'' ", 190.5), ("3-Foo", None),
    ("10-December", 391.16),
]


def test_height_golden(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(CASES)], "i int, ht string")
    got = {r["i"]: r["cm"] for r in df.select("i", height_to_cm("ht").alias("cm")).collect()}
    for i, (s, want) in enumerate(CASES):
        if want is None:
            assert got[i] is None, (s, got[i])
        else:
            assert got[i] == pytest.approx(want, abs=1e-9), (s, got[i])
