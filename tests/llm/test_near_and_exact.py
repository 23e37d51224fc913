"""MinHash near-dedup, line dedup and suffix-array dedup against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from dailyseries.llm import line_dedup, minhash, suffix_dedup
from dailyseries.llm.common import LOWER, _segment_words, shingle_sets, word_hashes
from dailyseries.llm.components import connected_components
from dailyseries.llm.runs import SortedRuns, sorted_run
from edge import awkward, frame, words

WHITE = " \t\n\x0b\f\r"


def shingles(text, width):
    w = (text or "").encode().translate(LOWER).split()
    return frozenset(tuple(w[j:j + width]) for j in range(max(1, len(w) - width + 1))) if w else frozenset()


def brute_near(rows, width, percent=80):
    """Expected (doc_id, n, component_id) of each row."""
    sets = [shingles(r[1], width) for r in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            i = len(sets[a] & sets[b])
            if i and 100 * i >= percent * (len(sets[a]) + len(sets[b]) - i):
                up[find(a)] = find(b)
    groups = {}
    for k in range(len(rows)):
        groups.setdefault(find(k), []).append(rows[k][0])
    low = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    return sorted(((rows[k][0], len(sets[k]), low[find(k)] if sets[k] else rows[k][0]) for k in range(len(rows))), key=str)


def near_group(n=60, edits=12, size=90, seed=3):
    """Edited copies of one text whose similarities lie on both sides of the threshold."""
    r, base = random.Random(seed), words(seed, size)
    out = []
    for k in range(n):
        w = list(base)
        for _ in range(r.randint(0, edits)):
            w[r.randrange(size)] = f"edit{k}x{r.randrange(4)}"
        out.append((1000 + k, " ".join(w)))
    return out


@pytest.mark.parametrize("width", [4, 5])
def test_near_duplicates_match_brute_force(spark, width):
    rows = [r[:2] for r in awkward()] + near_group() + near_group(20, 4, 40, 9)
    got = minhash.near_duplicates(frame(spark, rows), width=width).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute_near(rows, width)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


@pytest.mark.parametrize("width", [4, 5])
def test_edited_copies_without_their_original(spark, width):
    rows = []
    for g in range(6):  # two changes a copy, at places of its own: Jaccard below 80 %
        base = words(50 + g, 100 + width - 1)
        for c in range(3):
            w = list(base)
            for k, at in enumerate((15 + 30 * c, 30 + 30 * c)):
                w[at] = f"edit{g}x{c}x{k}"
            rows.append((10 * g + c, " ".join(w)))
    expected = brute_near(rows, width)
    assert all(i == c for i, _, c in expected)
    got = minhash.near_duplicates(frame(spark, rows), width=width).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == expected


def brute_groups(rows, width=5, percent=80):
    """A number per row: equal for rows of one component, None without words."""
    sets, up = [shingles(r[1], width) for r in rows], list(range(len(rows)))

    def find(k):
        while up[k] != k:
            k = up[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            i = len(sets[a] & sets[b])
            if i and 100 * i >= percent * (len(sets[a]) + len(sets[b]) - i):
                up[find(a)] = find(b)
    return [find(k) if sets[k] else None for k in range(len(rows))]


def test_drop_near_duplicates_keeps_one_of_each_group(spark):
    rows = [r[:2] for r in awkward()] + near_group()
    docs = frame(spark, rows)
    out = minhash.drop_near_duplicates(docs)
    assert out.columns == docs.columns
    kept = Counter((r.doc_id, r.text) for r in out.collect())
    groups = {}
    for row, g in zip(rows, brute_groups(rows), strict=True):
        groups.setdefault(g, []).append(row)
    wordless = groups.pop(None)
    left = kept - Counter(wordless)
    assert sum(kept.values()) - sum(left.values()) == len(wordless)  # documents without words all stay
    for own in groups.values():  # one row of each group, with its smallest id, even where groups share an id
        mine = [row for row in left.elements() if row in own]
        assert len(mine) == 1
        assert mine[0][0] == min((i for i, _ in own if i is not None), default=None)
    assert sum(left.values()) == len(groups)


def test_drop_near_duplicates_collapses_rows_of_one_group_only(spark):
    one, two, three, four = (" ".join(words(70 + k, 60)) for k in range(4))
    rows = [(None, one), (None, one), (None, two), (None, three + " end"), (None, three),  # null ids, three groups
            (None, None), (None, " "), (None, ""),                                          # no words
            (4, four), (4, four), (4, one[::-1]), (4, two[::-1]), (5, four)]               # one id, three groups
    out = [(r.doc_id, r.text) for r in minhash.drop_near_duplicates(frame(spark, rows)).collect()]
    assert set(out) <= set(rows)
    third = [r for r in out if r in ((None, three), (None, three + " end"))]
    assert len(third) == 1
    assert Counter(r for r in out if r not in third) == Counter(
        [(None, one), (None, two), (None, None), (None, " "), (None, ""), (4, four), (4, one[::-1]), (4, two[::-1])])


def test_near_duplicates_of_an_empty_table(spark):
    assert minhash.near_duplicates(frame(spark, [])).collect() == []
    assert minhash.drop_near_duplicates(frame(spark, [])).collect() == []


def test_permutations_are_circulant_and_estimate_similarity():
    r = np.random.default_rng(5)
    a = r.integers(0, 1 << 63, 4000, dtype=np.uint64)
    b = np.concatenate((a[:3200], r.integers(0, 1 << 63, 800, dtype=np.uint64)))  # J = 2/3
    s = minhash.signatures([a, b], 512)
    assert abs((s[0] == s[1]).mean() - 2 / 3) < 0.07
    x = minhash.sigma(a)
    assert (s[0][7] == minhash.pi(x - np.uint64(7)).min())
    assert len(np.unique(minhash.pi(np.arange(100_000, dtype=np.uint64)))) == 100_000


def test_word_hashes_of_segments_equal_the_whole():
    import dailyseries.llm.common as common
    text = " ".join(words(4, 5000)).encode()
    whole, _ = word_hashes([text])
    size, common.SEGMENT = common.SEGMENT, 1000
    try:
        parts, counts = word_hashes([b"a b", text, b"", b"c"])
    finally:
        common.SEGMENT = size
    assert counts.tolist() == [2, 5000, 0, 1] and (parts[2:-1] == whole).all()
    assert len(_segment_words(np.frombuffer(b" a  b ", np.uint8))[0]) == 2
    assert [len(s) for s in shingle_sets([b"a b c d a b c d", b"a", b""], 4)] == [4, 1, 0]


def test_connected_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 40)] + [(500, 500), (600, 601), (601, 602), (602, 600)]
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    groups = {}
    for node, label in got.items():
        groups.setdefault(label, set()).add(node)
    assert sorted(map(sorted, groups.values())) == [list(range(40)), list(range(100, 161)), [600, 601, 602]]


def test_sorted_runs_compact_by_level(spark):
    runs, seen = SortedRuns(["k"]), set()
    for batch in ([1, 2], [2, 3], [4], [1, 5], [6], [7, 3], [8], []):
        df = sorted_run(runs.mark(spark.createDataFrame([(x,) for x in batch], "k long")), ["k"], "t")
        assert {r.k for r in df.where("seen").collect()} == seen & set(batch)
        runs.add(df.where("not seen").select("k"))
        seen |= set(batch)
    assert {k: len(v) for k, v in runs.levels.items() if v} == {3: 1}
    assert sorted(r.k for r in runs.runs()[0].collect()) == sorted(seen)


# ------------------------------------------------------------------ line dedup
def brute_lines(rows):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda x: x.strip(WHITE).translate(low)
    holders = {}
    first = lambda i: (i is not None, i or 0)
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 10:
                holders.setdefault(key(x), set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < 2 or i == min(holders[key(x)], key=first)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def line_rows():
    shared, r = ["Shared line number one", "  shared LINE number one\t", "Übergroße Zeile", "übergroße Zeile", "short", "0123456789"], random.Random(1)
    rows = [(r.randrange(40), "\n".join(r.choice([*shared, *words(k, 3)]) for _ in range(r.randint(1, 9)))) for k in range(60)]
    rows += [(None, "Shared line number one\nown line of the null id"), (100, None), (101, ""), (102, "\n\n"), (3, "0123456789\n0123456789")]
    return rows + rows[:3] + [r[:2] for r in awkward()]


@pytest.mark.parametrize("batches", [1, 4, 8])
def test_line_dedup_matches_brute_force(spark, batches):
    rows = line_rows()
    docs = frame(spark, rows)
    out = line_dedup.dedup_lines(docs, batches=batches)
    assert out.columns == [*docs.columns, "kept_text", "n_lines", "n_dropped"]
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in out.collect()), key=str)
    assert got == brute_lines(rows)


def test_line_dedup_of_an_empty_table(spark):
    assert line_dedup.dedup_lines(frame(spark, [])).collect() == []


def test_line_dedup_plans_have_no_python(spark):
    out = line_dedup.dedup_lines(frame(spark, [(1, "a"), (2, "b")]))
    assert not re.search("Python|Pandas|Arrow", out._jdf.queryExecution().toString())


# -------------------------------------------------------------- suffix arrays
def brute_strings(rows, length):
    raw = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(b[s:s + length] for _, b in raw for s in range(len(b) - length + 1))
    out = []
    for i, b in raw:
        cover = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if count[b[s:s + length]] > 1:
                cover[s:s + length] = b"\1" * length
        kept = bytes(x for x, m in zip(b, cover, strict=True) if not m)
        out.append((i, len(b), sum(cover), len(re.findall(b"\1+", bytes(cover))), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def passage_rows():
    r, out = random.Random(7), []
    passages = [" ".join(words(s, 30)) for s in range(4)]
    for k in range(40):
        parts = []
        for _ in range(r.randint(1, 4)):
            p = r.choice(passages)
            a = r.randrange(len(p) // 2)
            parts += [" ".join(words(1000 * k + len(parts), r.randint(1, 30))), p[a:a + r.randint(20, len(p))]]
        out.append((k, " ".join(parts)))
    return out + [(90, "ab" * 300), (91, "z" * 500), (92, "é" * 150), (93, passages[0] * 2)]


@pytest.mark.parametrize(("length", "gram", "batches"), [(200, 100, 4), (200, 32, 1), (60, 16, 3), (50, 42, 2)])
def test_suffix_dedup_matches_brute_force(spark, length, gram, batches):
    rows = passage_rows() + [r[:2] for r in awkward() if r[0] not in (12, 13)]
    out = suffix_dedup.remove_repeats(frame(spark, rows), length, gram, batches).collect()
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out), key=str)
    assert got == brute_strings(rows, length)
    for r in out:
        assert len(r.kept) == r.n_bytes - r.n_removed == r.n_bytes - sum(s.end - s.start for s in r.spans)


def test_suffix_dedup_across_segments(spark, monkeypatch):
    import dailyseries.llm.suffix_dedup as sd
    rows = passage_rows()[:12]
    cells = {}
    for size in (sd.SEGMENT, 97):
        monkeypatch.setattr(sd, "SEGMENT", size)
        found = set()
        for _, t in rows:
            data = np.frombuffer(t.encode(), np.uint8)
            for at, _, g, anchor, first, last in sd.anchor_cells(data, 60, 16):
                for a, b, c in zip(anchor, first, last, strict=True):
                    found.update((t, at + s, at + int(a), int(g[a])) for s in range(int(b), int(c) + 1))
        cells[size] = found
    assert len(set(map(frozenset, cells.values()))) == 1  # every string keeps its anchor


def test_suffix_dedup_of_an_empty_table(spark):
    assert suffix_dedup.remove_repeats(frame(spark, [])).collect() == []
