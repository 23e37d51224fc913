"""SimHash ball hashing, bit-sliced whitening and conversation repair against brute force."""

import hashlib
import math
import random
import zlib
from fractions import Fraction
from functools import cache
from itertools import product

import numpy as np
import pytest
import xxhash
from edge import awkward, frame, words
from pyspark.sql import functions as F

from dailyseries.llm import conversations as cv
from dailyseries.llm import simhash, whitening
from dailyseries.llm.common import LOWER


# --------------------------------------------------------------------- SimHash
def brute_print(text):
    w = (text or "").encode().translate(LOWER).split()
    sh = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows):
    prints = [brute_print(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                up[find(a)] = find(b)
    groups = {}
    for k in range(len(rows)):
        groups.setdefault(find(k), []).append(rows[k][0])
    low = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    return sorted(((rows[k][0], f"{prints[k]:016x}", low[find(k)]) for k in range(len(rows))), key=str)


def test_simhash_matches_brute_force(spark):
    r, rows = random.Random(5), [x[:2] for x in awkward()]
    for g in range(4):  # families of long texts with few edits: small distances
        base = words(30 + g, 400)
        for c in range(25):
            w = list(base)
            for _ in range(r.randint(0, 3)):
                w[r.randrange(400)] = f"e{c}"
            rows.append((100 * (g + 1) + c, " ".join(w)))
    rows += [(900, "a b"), (901, "A \t b"), (902, "a b c"), (903, "a b c d"), (904, "x y x y x y"), (905, "")]
    got = simhash.digest_columns(simhash.near_duplicates(frame(spark, rows))).collect()
    assert sorted(((x.doc_id, x.fingerprint, x.component_id) for x in got), key=str) == brute_components(rows)
    assert all(x.kept == (x.doc_id == x.component_id) for x in got)
    assert len({x.component_id for x in got}) < len(got) - 60  # the families are linked


def test_links_of_chosen_fingerprints(spark):
    r = random.Random(8)
    hub = [r.getrandbits(64) for _ in range(30)]
    prints = set(hub)
    for x in hub:
        prints |= {x ^ 1 << r.randrange(64) for _ in range(4)} | {x ^ 1 << r.randrange(64) ^ 1 << r.randrange(64) for _ in range(4)}
        prints.add(x ^ 7 << r.randrange(60))
    signed = [p - (p >> 63 << 64) for p in prints]
    links = simhash.ball_links(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()
    assert len(links) == len(set(links)) and all(((a ^ b) & (1 << 64) - 1).bit_count() <= 2 for a, b in links)

    def reach(edges):
        up = {p: p for p in signed}

        def find(x):
            while up[x] != x:
                x = up[x]
            return x

        for a, b in edges:
            up[find(a)] = find(b)
        groups = {}
        for p in signed:
            groups.setdefault(find(p), set()).add(p)
        return sorted(map(sorted, groups.values()))

    every = [(a, b) for a, b in product(signed, signed) if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 2]
    assert reach(links) == reach(every)


def test_variants_hold_a_bounded_group(spark):
    """All one-bit variants of a print meet in it: 65 members in one row."""
    rows = spark.createDataFrame([(0,)] + [(1 << k,) for k in range(63)] + [(-(1 << 63),)], "fp long")
    top = simhash.variants(rows).where("v = 0").collect()
    assert len(top) == 1 and top[0].itself and top[0].flips == -1
    assert simhash.ball_links(rows).where("a = 0 or b = 0").count() >= 1
    assert simhash.ball_links(rows).select("a").union(simhash.ball_links(rows).select("b")).distinct().count() == 65


def test_simhash_of_a_very_long_text_and_an_empty_table(spark):
    long = " ".join(random.Random(1).choices(words(3, 500), k=2 * simhash.BLOCK + 77))
    assert simhash.fingerprint(long) == brute_print(long)
    assert simhash.near_duplicates(frame(spark, [])).collect() == []


# ------------------------------------------------------------------- whitening
def brute_whitening(rows):
    """Exact covariance in fractions, numpy's eigenvectors of it."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max(len(v) for _, v in kept)
    xs = [(i, tuple(math.floor(64 * c) + 1_000_000 for c in v) + (1_000_000,) * (width - len(v))) for i, v in kept]
    fit = sorted({x for _, x in xs})
    n, sums = len(fit), [sum(x[d] for x in fit) for d in range(width)]
    cov = [[sum(Fraction(n * x[a] - sums[a], n) * Fraction(n * x[b] - sums[b], n) for x in fit) / n for b in range(width)]
           for a in range(width)]
    values, vectors = np.linalg.eigh(np.array([[float(c) for c in row] for row in cov]))
    return xs, n, sums, cov, values[::-1], vectors[:, ::-1]


def vector_rows():
    r = random.Random(11)
    scale = [2.0 ** (d / 4) for d in range(20)]
    rows = [(i, [float(np.float32(r.gauss(0, 1) * s)) for s in scale]) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(150)] + [(5, rows[5][1]), (5, rows[6][1]), (None, rows[7][1])]
    return rows + [(2000, None), (2001, [None] * 20), (2002, [float("nan")] + [0.0] * 19), (2003, [float("inf")] * 20),
                   (2004, []), (2005, [0.5, 0.25]), (2006, [0.0] * 20)]


def test_whitening_matches_exact_covariance(spark):
    rows = vector_rows()
    df = spark.createDataFrame([(*x, 1, "x") for x in rows], "vec_id long, embedding array<double>, n int, x string")
    got = whitening.whiten(df.repartition(5)).collect()
    xs, n, sums, cov, values, vectors = brute_whitening(rows)
    assert len(got) == 16 * len(xs) and {g.n for g in got} == {n}
    trace = float(sum(cov[d][d] for d in range(20)))
    dev = sorted(((i, sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True))) for i, x in xs), key=str)
    assert sorted(((g.vec_id, g.deviation) for g in got if g.component == 3), key=str) == dev
    assert max(g.identity_error for g in got) < 1e-9 and len({g.identity_error for g in got}) == 1
    for k in range(16):
        expected = {}
        for i, x in xs:
            z = sum(float(Fraction(n * c - s, n)) * q for c, s, q in zip(x, sums, vectors[:, k], strict=True))
            expected.setdefault(i, []).append(z / math.sqrt(values[k]))
        mine = {}
        for g in got:
            if g.component == k + 1:
                mine.setdefault(g.vec_id, []).append(g.whitened)
                assert abs(g.explained / (values[k] / trace) - 1) < 1e-9
        far = max(expected, key=lambda i: abs(expected[i][0]))
        sign = 1 if mine[far][0] * expected[far][0] > 0 else -1
        assert all(np.allclose(sorted(sign * z for z in mine[i]), sorted(expected[i]), atol=1e-7) for i in expected)


@pytest.mark.parametrize("high", [1, 70, 1 << 20, 1 << 40])
def test_scatter_is_exact(high):
    r = random.Random(high)
    rows = [[r.randrange(high + 1) for _ in range(5)] + [1] for _ in range(200)]
    u = np.array(rows, np.int64)
    got = whitening.scatter(u, [max(1, int(u[:, d].max()).bit_length()) for d in range(6)])
    assert [[int(v) for v in row] for row in got] == [[sum(x[a] * x[b] for x in rows) for b in range(6)] for a in range(6)]


def test_whitening_of_few_rows_and_wide_ranges(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, []), (2, None)], schema)).collect() == []
    two = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 2.0])], schema)).collect()
    assert [(g.vec_id, g.component, g.n, g.deviation, abs(g.whitened), g.explained) for g in sorted(two)] == [
        (1, 1, 2, 128 ** 2, 1.0, 1.0), (2, 1, 2, 128 ** 2, 1.0, 1.0)]
    wide = whitening.whiten(spark.createDataFrame([(1, [1e15, 0.0]), (2, [-1e15, 1.0]), (3, [0.0, 5.0])], "vec_id long, embedding array<double>"))
    assert {g.deviation for g in wide.collect()} == {None, 0 + (3 * 1_000_000 - 3_000_000) ** 2 + (3 * 320 - 384) ** 2}


# ---------------------------------------------------------- conversation repair
def brute_edits(seq):
    """(cost, audit) over (initial, fault) rows, forward by plain recursion."""
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}

    @cache
    def best(i, last, room):
        out = [(0, "")] if i == len(seq) and last in ("", "a") else []
        if i < len(seq):
            initial, fault = seq[i]
            more = 3 if fault == "truncated" else 0
            out += [(c + 4, "D" + a) for c, a in best(i + 1, last, 2)]
            if fault not in ("blank", "duplicate"):
                if initial and initial in follow[last]:
                    out += [(c + more, "K" + a) for c, a in best(i + 1, initial, 2)]
                for to in set(follow[last]) & set("ua"):
                    out += [(c + 3 + more, "R" + a) for c, a in best(i + 1, to, 2)]
        if room:
            for to in set(follow[last]) & set("ua"):
                out += [(c + 3, "I" + a) for c, a in best(i, to, room - 1)]
        return [min(out)] if out else []

    return best(0, "", 2)[0]


def brute_report(rows, damaged=True):
    groups = {}
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        own = groups.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        hit = zlib.crc32(key.encode()) % 20 if damaged else 9
        if hit == 1:
            text = ""
        if hit == 2:
            text = "".join(c for c in text if c not in ".!?")
        own.extend([(turn is not None, turn or 0, "user" if hit == 4 else role, text)] * {0: 0, 3: 2}.get(hit, 1))
    out = []
    for conv, own in groups.items():
        own.sort(key=lambda r: (r[0], r[1], r[2].encode(), hashlib.sha256(r[3].encode()).hexdigest()))
        seen, seq = set(), []
        for _, _, role, text in own:
            bare = text.strip(" \t\n\x0b\f\r")
            fault = ("blank" if not bare else "duplicate" if (role, text) in seen
                     else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
            seq.append((role[:1], fault))
        cost, audit = brute_edits(tuple(seq))
        at, lines, turn = iter(own), [], 0
        for e in audit:
            row = None if e == "I" else next(at)
            if e == "K" and row[2][:1] == "s":
                lines.append(f"{row[2]}:{row[3]}")
            elif e != "D":
                turn += 1
                role = row[2] if e == "K" else "user" if turn % 2 else "assistant"
                lines.append(f"{role}:{row[3] if row else ''}")
        turns = {r[1] for r in own if r[0]}
        faults = [f for _, f in seq]
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(seq, seq[1:], strict=False))
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("blank"),
                    faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def conversation_rows():
    r = random.Random(21)
    roles = ["user", "assistant", "system", "tool", "", None, "User", "u2"]
    texts = ["Yes.", "No", "Why?", "", None, " \n", "Ok! \t", "a.b", " ", "é. ", "Same.", "Same."]
    rows = [(c, t, r.choices(roles, [6, 6, 2, 1, 1, 1, 1, 1])[0], r.choice(texts)) for c in range(150)
            for t in range(r.randint(0, 9))]
    rows += [(200 + c, t, ("user", "assistant")[t % 2], f"Line {t}.") for c in range(40) for t in range(6)]
    rows += [(None, 1, "user", "Hi."), (None, None, "assistant", "Hm."), (None, None, None, None), (None, 5, "user", "x" * 200_000),
             (300, 1, "assistant", "B."), (300, 1, "user", "A."), (300, 1, "user", "A."), (300, 9, "user", "A.")]
    rows += [(301, t % 7, "user", "again") for t in range(200)] + [(302, None, "system", "s.")]
    return rows


def chats(spark, rows):
    return spark.createDataFrame([(*x, "x", 1) for x in rows],
                                 "conv_id long, turn long, role string, text string, audit string, codes int")


@pytest.mark.parametrize("damaged", [True, False])
def test_report_matches_brute_force(spark, monkeypatch, damaged):
    monkeypatch.setattr(cv, "PIECE", 3)
    rows = conversation_rows()
    df = chats(spark, rows).repartition(6)
    got = cv.report(*cv.damage(df)) if damaged else cv.report(df)
    assert sorted(map(tuple, got.collect()), key=str) == brute_report(rows, damaged)


def test_repaired_lines_give_the_reported_digest(spark):
    df = chats(spark, conversation_rows())
    lines = {}
    for x in cv.repair(df).orderBy("place").collect():
        lines.setdefault(x.conv_id, []).append(x)
    for x in cv.report(df).collect():
        own = lines.get(x.conv_id, [])
        assert [o.place for o in own] == list(range(len(own)))
        assert "".join(o.edit for o in own) == x.audit.replace("D", "")
        said = "\n".join(f"{o.role}:{o.text}" for o in own)
        assert hashlib.sha256(said.encode()).hexdigest() == x.repaired_sha256
        initials = "".join(o.role[0] for o in own)
        assert initials == "" or initials.removeprefix("s") == "ua" * (len(initials) // 2)


def test_checkpoints_change_nothing():
    r, faults = random.Random(2), {0: "", 1: "blank", 2: "duplicate", 3: "truncated"}
    for n in [*range(12), 40, 99, 100, 101]:
        for _ in range(20):
            codes = bytes(r.randrange(16) for _ in range(n))
            assert cv.cheapest_edits(codes) == brute_edits(tuple(("suax"[c // 4], faults[c % 4]) for c in codes))
    cost, audit = cv.cheapest_edits(bytes([cv.code(cv.USER, cv.FINE), cv.code(cv.ASSISTANT, cv.FINE)] * 50_000))
    assert cost == 0 and audit == "K" * 100_000


def test_one_conversation_over_many_partitions(spark):
    """A conversation is cut by the range partitioning and put together from pieces."""
    rows = [(7, t, ("user", "assistant")[t % 2], f"T{t}.") for t in range(5000)] + [(8, 0, "user", "Q?")]
    df = chats(spark, rows)
    pieces = cv.coded_pieces(cv.prepared(df).drop("text").repartition(4)).where("conv_id = 7")
    assert pieces.agg(F.sum("turns")).first()[0] == 5000
    got = {x.conv_id: x for x in cv.report(df).collect()}
    assert got[7].audit == "K" * 5000 and got[7].gaps == 0 and got[8].audit == "KI" and got[8].cost == 3


def test_conversations_of_an_empty_table(spark):
    assert cv.report(chats(spark, [])).collect() == [] and cv.repair(chats(spark, [])).collect() == []
