"""WARC round trip, exact Hamming search and Pfair mixing."""

import gzip
import hashlib
import io
import random
import re

import numpy as np
import pytest
from edge import awkward, frame

from dailyseries.llm import hamming, mixing, warc


# ------------------------------------------------------------------------ WARC
def page_rows():
    big = "<html>" + "p" * 1200 + "</html>"
    return [(1, "http://a/1", big), (2, "http://a/2", big), (7, None, big), (3, "http://a/\r\nX: y", "small"), (4, "u", "small"),
            (5, "u", None), (6, "u", ""), (None, "u", big), (8, "u", "é" * 600), (9, "u", "é" * 600), (9, "u", "é" * 600),
            (10, "u", "q\r\n\r\nWARC/1.1\r\n\r\n" * 100), (None, None, None), (11, "u", "z" * 3_000_000),
            (None, "u", "n" * 2000), (None, "u", "n" * 2000)]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, archive string, nth int")


@pytest.mark.parametrize("archive_bytes", [warc.ARCHIVE_BYTES, 2000])
def test_warc_round_trip(spark, monkeypatch, archive_bytes):
    monkeypatch.setattr(warc.write_monolithic, "__defaults__", (archive_bytes,))
    rows = page_rows()
    got = warc.round_trip(pages(spark, rows).repartition(3), payload=True).collect()
    assert len(got) == len(rows)
    key = lambda h: (h or "").encode()
    for r in got:
        assert r.payload is None or hashlib.sha1(bytes(r.payload)).hexdigest() == r.payload_digest
    by = sorted(((r.page_id, r.payload_bytes, r.payload_digest) for r in got), key=str)
    assert by == sorted(((i, len(key(h)), hashlib.sha1(key(h)).hexdigest()) for i, _, h in rows), key=str)
    groups = {}
    for r in got:
        groups.setdefault(r.payload_digest, []).append(r)
    for g in groups.values():
        first = [r for r in g if r.record_type == "response"]
        if g[0].payload_bytes < warc.MIN_REVISIT_BYTES:
            assert len(first) == len(g)
            continue
        top = max((r.page_id for r in g if r.page_id is not None), default=None)
        assert len(first) == 1 and first[0].page_id == top
        assert all(r.refers_to == top for r in g if r.record_type == "revisit")
    assert all(r.refers_to is None for r in got if r.record_type == "response")


def test_archives_hold_one_member_per_record(spark, tmp_path):
    rows = page_rows()
    entries = warc.write_monolithic(pages(spark, rows).repartition(2), f"{tmp_path}/raw")
    index = warc.normalise(entries, warc.decide(entries), f"{tmp_path}/raw", f"{tmp_path}/records").collect()
    assert len(index) == len(rows)
    for name in {r.archive for r in index}:
        raw, out = (tmp_path / "raw" / name).read_bytes(), (tmp_path / "records" / name).read_bytes()
        assert sum(r.length for r in index if r.archive == name) == len(out)
        whole = gzip.decompress(raw)
        assert whole.count(b"WARC-Type: response") >= 1 and gzip.decompress(out)  # both are plain gzip files
        heads = [h["warc-type"] for h, _ in warc.parse_stream(warc.inflate(io.BytesIO(out)))]
        assert heads == [r.record_type for r in sorted((r for r in index if r.archive == name), key=lambda r: r.offset)]
    assert not [p for p in (tmp_path / "raw").iterdir() if p.name.startswith(".") and not p.name.endswith(".crc")]


def test_warc_of_an_empty_table_and_cut_streams(spark):
    assert warc.round_trip(pages(spark, [])).collect() == []
    record = warc.record_bytes("response", 1, "u", b"body", "d", 4)
    with pytest.raises(ValueError, match="cut off"):
        list(warc.parse_stream(iter([record[:-6]])))
    assert [p for _, p in warc.parse_stream(iter([bytes([b]) for b in record * 2]))] == [b"body", b"body"]


# --------------------------------------------------------------------- Hamming
def brute_top(rows, queries, k):
    codes = {}
    for i, v in rows:
        if i is not None and v is not None:
            bits = [x is not None and (x >= 0 or x != x) for x in v] + [False] * (128 - len(v))
            c = [sum(1 << d for d in range(64) if bits[at + d]) for at in (0, 64)]
            c = [x - ((x >> 63) << 64) for x in c]  # words are signed
            codes[i] = min(c, codes.get(i, c))
    out = []
    for q in sorted(queries & codes.keys()):
        near = sorted((sum(((a ^ b) & ((1 << 64) - 1)).bit_count() for a, b in zip(codes[q], c, strict=True)), i)
                      for i, c in codes.items() if i != q)[:k]
        out += [(q, n + 1, i, d) for n, (d, i) in enumerate(near)]
    return out


@pytest.mark.parametrize("k", [1, 10])
def test_top_k_matches_brute_force(spark, k):
    r = random.Random(k)
    base = [r.gauss(0, 1) for _ in range(64)]
    rows = [(i, [r.gauss(0, 1) for _ in range(64)]) for i in range(120)]
    rows += [(200 + i, [x if r.random() < 0.9 else -x for x in base]) for i in range(100)]   # a cluster
    rows += [(400 + i, list(base)) for i in range(150)]                                       # one common vector
    rows += [(900, None), (None, base), (901, []), (902, [None] * 64), (903, [float("nan")] * 3), (904, base * 2), (5, base), (5, rows[5][1])]
    df = spark.createDataFrame([(*x, 1, "x") for x in rows], "vec_id long, embedding array<double>, code int, ids string")
    ids = {i for i, _ in rows if i is not None and i % 20 == 0}
    got = hamming.top_k(df, df.where("vec_id % 20 = 0"), k).collect()
    assert sorted((x.query_id, x.rank, x.vec_id, x.distance) for x in got) == brute_top(rows, ids, k)


def test_top_k_of_few_or_no_rows(spark):
    schema = "vec_id long, embedding array<double>"
    assert hamming.top_k(*[spark.createDataFrame([], schema)] * 2).collect() == []
    df = spark.createDataFrame([(1, [1.0] * 64), (2, [-1.0] * 64)], schema)
    assert [tuple(r) for r in hamming.top_k(df, df.where("vec_id = 1")).collect()] == [(1, 1, 2, 64)]


def test_codes_have_a_bit_for_every_dimension(spark):
    """Vectors that differ beyond dimension 64 only are told apart."""
    r = random.Random(3)
    one = [r.gauss(0, 1) for _ in range(64)]
    rows = [(20 * i, one + [1.0 if d < i else -1.0 for d in range(64)]) for i in range(40)] + [(7, one)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = hamming.top_k(df, df.where("vec_id % 20 = 0"), 3).collect()
    assert sorted((x.query_id, x.rank, x.vec_id, x.distance) for x in got) == brute_top(rows, {i for i, _ in rows if i != 7}, 3)
    assert [x.distance for x in got if x.query_id == 0 and x.rank == 1] == [0]  # 7 has no bit there either
    assert [x.distance for x in got if x.query_id == 400] and min(x.distance for x in got if x.query_id == 400) == 1


def test_occupied_values_are_those_of_the_index(spark):
    r = random.Random(4)
    for values in ([0], [65535], [32767, 32768, 32769, 1, 2], r.sample(range(1 << 16), 5000)):
        rows = spark.createDataFrame([(s, v) for s in (0, 2) for v in values], "seg int, val int")
        bits = hamming.occupied_values(rows, 3)
        got = [np.flatnonzero(np.unpackbits(b)).tolist() for b in bits]
        assert got == [sorted(values), [], sorted(values)]


def test_probes_do_not_grow_with_the_values_of_the_index(spark):
    """A query is one row for each part that holds a value at the radius, however many do."""
    r = random.Random(5)
    owns = [0, 65535, *r.sample(range(1 << 16), 6)]
    rows = spark.createDataFrame([(0, o) for o in owns], "seg int, own int")
    for held in (r.sample(range(1 << 16), 3000), range(1 << 16)):
        bits = np.zeros(1 << 16, bool)
        bits[list(held)] = True
        for radius in (0, 1, 4, 8, 16):
            near = hamming.near_parts_udf(spark, [np.packbits(bits)], radius, 12)
            got = {x.own: x.near for x in rows.select("own", near("seg", "own").alias("near")).collect()}
            assert got == {o: sorted({v >> 12 for v in held if (v ^ o).bit_count() == radius}) for o in owns}
            assert max(map(len, got.values())) <= 16


def test_parts_cut_into_chunks_and_shares_lose_nothing(spark, monkeypatch):
    r = random.Random(6)
    base = [[r.gauss(0, 1) for _ in range(64)] for _ in range(2)]
    rows = [(i, [x if r.random() < 0.95 else -x for x in base[i % 2]]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    ids = {i for i, _ in rows if i % 20 == 0}
    for name, value in {"PART_CODES": 8, "PART_BITS": (4, 6), "CHUNK_CODES": 2, "QUERY_CODES": 3, "CELLS": 16}.items():
        monkeypatch.setattr(hamming, name, value)
    got = hamming.top_k(df, df.where("vec_id % 20 = 0"), 5).collect()
    assert sorted((x.query_id, x.rank, x.vec_id, x.distance) for x in got) == brute_top(rows, ids, 5)


# ---------------------------------------------------------------------- mixing
@pytest.mark.parametrize("weights", [mixing.TARGET, {"a": 0.9, "b": 0.05}, {f"s{i}": 1 for i in range(60)} | {"big": 60.0}, {"x": 1 / 3, "y": 1 / 7}])
def test_every_prefix_of_the_schedule_is_within_one_block(weights):
    quota = mixing.quotas(weights, 0.01)
    period = sum(quota.values())
    assert period == mixing.PERIOD and min(quota.values()) >= 1
    done = dict.fromkeys(quota, 0)
    for t, (s, i, slot) in enumerate(mixing.slot_table(quota)):
        assert slot == t and i == done[s]
        done[s] += 1
        for x, q in quota.items():
            assert abs(done[x] * period - q * (t + 1)) < period
    assert done == quota


def test_schedule_matches_brute_force(spark):
    r = random.Random(3)
    rows = [(i, f"t{i}", "en", r.choice(["src0"] * 6 + ["src1", "src12", "other", None])) for i in range(3000)]
    rows += [x for x in awkward()]
    weights, rest, block, period = {"src0": 0.5, "src1": 0.3, "src12": 0.1}, 0.1, 7, 40
    out = mixing.schedule(frame(spark, rows), weights, rest, block, period)
    assert out.columns == [c for c in frame(spark, []).columns if c != "stream"] + ["stream", "block", "slot", "place"]
    got = out.collect()
    quota = mixing.quotas(weights, rest, period)
    at = {(s, i): slot for s, i, slot in mixing.slot_table(quota)}
    md5 = lambda i: hashlib.md5(("null" if i is None else str(i)).encode()).hexdigest()
    streams = {}
    for x in rows:
        streams.setdefault(x[3] if x[3] in weights else mixing.REST, []).append(x[0])
    exp = []
    for s, ids in streams.items():
        for n, i in enumerate(sorted(ids, key=lambda i: (md5(i), i or 0))):
            b = n // block
            exp.append((i, s, b, at[s, b % quota[s]] + b // quota[s] * period, n % block))
    assert sorted(((x.doc_id, x.stream, x.block, x.slot, x.place) for x in got), key=str) == sorted(exp, key=str)
    assert len({(x.slot, x.place) for x in got}) == len(rows)


def test_mixing_of_an_empty_table_bad_weights_and_plan(spark):
    out = mixing.schedule(frame(spark, []), mixing.TARGET, mixing.TARGET_REST)
    assert out.collect() == [] and not re.search("Python|Pandas|Arrow", out._jdf.queryExecution().toString())
    with pytest.raises(ValueError, match="positive"):
        mixing.quotas({"a": 0}, 1)
