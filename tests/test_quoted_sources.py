"""CSV records with quoted newlines read by splits; payload layouts."""

import json
import random

import pytest
from pyspark.sql import functions as F

from dailyseries.sources import files as io
from dailyseries.sources import quoted as q


def whole(spark, path):
    """The same file by the multi-line reader, one task a file."""
    return (spark.read.option("header", True).option("encoding", "ISO-8859-1").option("multiLine", True)
            .option("escape", '"').csv(str(path)))


def messy(seed, n):
    """CSV text with quoted newlines, doubled quotes, stray quotes, blank lines and commas."""
    r = random.Random(seed)
    pieces = ["a", "b c", "x,y", 'say "hi"', "line\nbreak", "two\n\nbreaks", '"', '""\n"', "é", ",", " lead", "tail "]
    out = ["id,name,note"]
    for i in range(n):
        fields = [str(i)]
        for _ in range(2):
            v = "".join(r.choice(pieces) for _ in range(r.randint(1, 4)))
            fields.append('"' + v.replace('"', '""') + '"')
        if r.random() < 0.3:
            fields[1] = r.choice(["plain", "6'11", "5'7\" tall", "", "NA"])
        out.append(",".join(fields))
        if r.random() < 0.1:
            out.append("")
    return "\n".join(out) + "\n"


@pytest.mark.parametrize("split_bytes", [64, 500, 1 << 20])
def test_quoted_newlines_by_splits_match_the_multi_line_reader(spark, tmp_path, split_bytes):
    (tmp_path / "x.csv").write_text(messy(1, 300), encoding="latin-1")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        lines = q.physical_lines(spark, str(tmp_path / "x.csv"))
        tasks = lines.select(F.spark_partition_id().alias("p")).distinct().count()
        assert tasks > 1 or split_bytes == 1 << 20
        got = q.read_quoted_csv(spark, str(tmp_path / "x.csv"))
        expected = whole(spark, tmp_path / "x.csv")
        assert got.columns == expected.columns == ["id", "name", "note"]
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)
        assert got.count() == 300
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_a_record_longer_than_several_splits(spark, tmp_path):
    text = 'id,note\n1,"' + "\n".join(f"line {i}" for i in range(400)) + '"\n2,"b"\n3,"' + '""\n' * 50 + '"\n'
    (tmp_path / "x.csv").write_text(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        got = sorted(map(tuple, q.read_quoted_csv(spark, str(tmp_path / "x.csv")).collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [("1", "\n".join(f"line {i}" for i in range(400))), ("2", "b"), ("3", '"\n' * 50)]


def test_line_ends_and_folders_of_files(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'id,note\r\n1,"x\r\ny"\r\n2,z\r\n')
    (tmp_path / "b.csv").write_bytes(b'id,note\r\n3,"p,q"\r\n')
    got = sorted(map(tuple, q.read_quoted_csv(spark, str(tmp_path)).collect()))
    assert got == [("1", "x\r\ny"), ("2", "z"), ("3", "p,q")]


def test_only_files_with_quoted_newlines_take_the_second_pass(spark, tmp_path):
    (tmp_path / "plain.csv").write_text('id,note\n1,"a,b"\n2,5\'7" tall\n3,"say ""hi"""\n')
    (tmp_path / "over.csv").write_text('id,note\n1,"a\nb"\n')
    assert not q.has_quoted_newlines(q.physical_lines(spark, str(tmp_path / "plain.csv")))
    assert q.has_quoted_newlines(q.physical_lines(spark, str(tmp_path / "over.csv")))
    rows = io.read_csv_typed(spark, str(tmp_path / "plain.csv")).orderBy("id").collect()
    assert [r.note for r in rows] == ["a,b", "5'7\" tall", 'say "hi"']
    assert [r.note for r in io.read_csv_typed(spark, str(tmp_path / "over.csv")).collect()] == ["a\nb"]


def test_column_names_follow_the_reader():
    assert q.column_names('id,"a\nb",,x,X') == ["id", "a\nb", "_c2", "x3", "X4"]


def test_payload_layouts(spark, tmp_path):
    doc = {"latitude": 1.5, "longitude": 3.0, "daily": {"time": ["2020-01-01", "2020-01-02"], "rain_sum": [1.0, None]}}
    laid, lines, broken, several = (tmp_path / n for n in ("laid", "lines", "broken", "several"))
    for d in (laid, lines, broken, several):
        d.mkdir()
    (laid / "1.json").write_text(json.dumps(doc, indent=1))
    (laid / "2.json").write_text(json.dumps(doc | {"latitude": 2.5}, indent=1))
    (lines / "1.json").write_text(json.dumps(doc) + "\n" + json.dumps(doc | {"latitude": 2.5}) + "\n")
    measures = [("rain_sum", "double")]
    same = [sorted(map(str, io.ingest_daily_payload(spark, str(d), measures).collect())) for d in (laid, lines)]
    assert same[0] == same[1] and len(same[0]) == 4  # neither layout loses a document
    (broken / "1.json").write_text(json.dumps(doc)[:-5])
    with pytest.raises(ValueError, match="not a payload"):
        io.ingest_daily_payload(spark, str(broken), measures)
    with pytest.raises(ValueError, match="not a payload"):
        io.ingest_daily_payload(spark, str(laid), measures, multi_line=False)
    (several / "1.json").write_text(json.dumps(doc, indent=1) + "\n" + json.dumps(doc, indent=1))
    with pytest.raises(ValueError, match="several documents"):
        io.ingest_daily_payload(spark, str(several), measures)
