"""The pipeline: stage contracts, brute force per stage, and the whole."""

from collections import Counter

import pytest
from edge import awkward, frame
from test_near_and_exact import brute_lines, brute_near
from test_text_operators import brute_hits

import corpus_pipeline
from dailyseries.llm import minhash, mixing
from dailyseries.llm.common import materialize, release, scratch_mark, scratch_since
from dailyseries.llm.queries import ORACLE, QUERIES

SF0001 = "/root/testdata/sf0.001"


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Every stage's input and output on the smallest tables."""
    folder, out = tmp_path_factory.mktemp("stages"), []
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, SF0001)
        result.write.parquet(f"{folder}/{name}")
        result = spark.read.parquet(f"{folder}/{name}")
        out.append((name, docs, result))
        docs = result
    return {name: (a, b) for name, a, b in out}


def test_stage_list(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontaminate", "mix"]
    for name in list(stages)[:-1]:
        assert stages[name][1].columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_language_id_keeps_clean_documents(stages):
    before, after = map(rows_of, stages["language_id"])
    assert set(after) <= set(before) and len(after) >= 0.99 * len(before)


def test_line_dedup_stage(stages):
    before, after = stages["line_dedup"]
    assert sorted(rows_of(after), key=str) == sorted(((i, t) for i, _, _, t in brute_lines(rows_of(before))), key=str)
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_near_dedup_stage(stages):
    before, after = map(rows_of, stages["near_dedup"])
    expected = {i for i, _, c in brute_near(before, 5) if i == c}
    assert {i for i, _ in after} == expected and set(after) <= set(before)


def test_decontamination_stage(spark, stages):
    before, after = map(rows_of, stages["decontaminate"])
    items = [tuple(r) for r in spark.read.parquet(f"{SF0001}/benchmark.parquet").select("item_id", "text").collect()]
    hit = {x[0] for x in brute_hits(before, items) if x[-1]}
    assert sorted(after) == sorted(x for x in before if x[0] not in hit)


def test_mix_stage(stages):
    before, after = stages["mix"]
    assert sorted(rows_of(after)) == sorted(rows_of(before))
    got = sorted(after.collect(), key=lambda r: (r.slot, r.place))
    quota = mixing.quotas(mixing.TARGET, mixing.TARGET_REST)
    assert all(r.stream == (r.source if r.source in mixing.TARGET else mixing.REST) for r in got)
    last = Counter()
    for r in got:
        assert r.block in (last[r.stream], last[r.stream] + 1) or not last[r.stream]
        last[r.stream] = r.block
        assert r.slot // mixing.PERIOD == r.block // quota[r.stream]


def test_run_equals_the_stages(spark, stages):
    want = stages["mix"][1]
    got = corpus_pipeline.run(spark, SF0001)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_every_stage_takes_awkward_and_empty_tables(spark, tmp_path):
    for name, rows in (("awkward", awkward()), ("empty", [])):
        docs = frame(spark, rows)
        for k, (stage_name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SF0001)
            if k < 4:
                assert out.columns == docs.columns
            out.write.parquet(f"{tmp_path}/{name}-{stage_name}")
            docs = spark.read.parquet(f"{tmp_path}/{name}-{stage_name}")
        assert docs.count() <= len(rows)


def test_registry():
    from __spark_entry__ import oracle_sql, queries
    assert set(QUERIES) < set(queries()) and "pipeline" in queries() and set(ORACLE) < set(oracle_sql())


def test_older_lazy_results_survive_a_run(spark):
    """A run frees the scratch of its own stages only."""
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    older = minhash.near_duplicates(docs)
    n = corpus_pipeline.run(spark, SF0001).count()
    assert 0 < n <= docs.count()
    assert older.count() == docs.count()
    mark = scratch_mark()
    materialize(docs.limit(1), "own")
    own = scratch_since(mark)
    release(spark, own)
    assert len(own) == 1 and scratch_since(mark) == [] and older.count() == docs.count()
