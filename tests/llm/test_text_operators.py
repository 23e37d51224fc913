"""Language ID, PII, token counts and decontamination."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from edge import awkward, frame, words

from dailyseries.llm import decontam, langid, pii, token_counts

SF001 = "/root/testdata/sf0.01"


# ----------------------------------------------------------------- language ID
def test_language_id_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    model = langid.fit(docs)
    rows = langid.identify(docs, model).withColumn("held", langid.held_out(docs["doc_id"])).collect()
    held = [r for r in rows if r.held]
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.98
    assert sum(r.rejected for r in rows) <= 0.005 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_training_reads_only_permitted_rows(spark):
    rows = [(i, f"text number {i}", "bad" if zlib.crc32(str(i).encode()) % 3 == 1 else "ok") for i in range(60)]
    rows += [(None, "no id", "none"), (61, None, "null"), (62, "123", "digits"), (63, "unlabelled", None)]
    assert {r[0] for r in langid.sample_rows(frame(spark, rows))} == {"ok"}


def test_every_label_is_sampled_and_the_bound_is_per_language(spark, monkeypatch):
    ids = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 3 != 1]
    rows = [(i, f"words of {i}", f"l{k % 230}") for k, i in enumerate(ids[:460])]
    rows += [(ids[0], f"again {k}", "l0") for k in range(50)]
    docs = frame(spark, rows)
    got = Counter(r[0] for r in langid.sample_rows(docs))
    assert got == Counter(r[2] for r in rows)
    # all rows of one id are chosen together: the bound cuts them, and no other language
    again = [Counter(r[0] for r in langid.sample_rows(docs.repartition(n), 10)) for n in (1, 7)]
    assert again[0] == again[1] and again[0]["l0"] <= 20
    assert all(again[0][f"l{k}"] == 2 for k in range(1, 230))
    monkeypatch.setattr(langid, "SAMPLE_ROWS", 460)  # two rows a language
    assert Counter(r[0] for r in langid.sample_rows(docs))["l0"] <= 4
    monkeypatch.setattr(langid, "SAMPLE_ROWS", 229)
    with pytest.raises(ValueError, match="229 languages"):
        langid.sample_rows(docs)


def plain_counts(text):
    """N-gram counts by loops: 1 to 4 bytes with a word's byte at their heart."""
    b = [c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in f" {text.lower()} ".encode()]
    counts = Counter()
    for i in range(len(b)):
        for n, heart in ((1, (0,)), (2, (0, 1)), (3, (1,)), (4, (1, 2))):
            gram = b[i:i + n]
            if len(gram) < n:
                continue
            solid = [gram[j] != 32 for j in heart]
            if any(solid) if n == 2 else all(solid):
                number = sum(c << 8 * j for j, c in enumerate(gram))
                counts[(number * int(langid._MULT[n - 1]) & 0xFFFFFFFF) >> (32 - langid.BUCKET_BITS)] += 1
    return counts


def test_prediction_equals_a_plain_second_version(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").orderBy("doc_id").limit(40)
    model = langid.fit(spark.read.parquet(f"{SF001}/documents.parquet"))
    for r in langid.identify(docs, model).collect():
        if not langid.has_letter(r.text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        counts = plain_counts(r.text)
        mean = sum(n * model.embeddings[k] for k, n in counts.items()) / sum(counts.values())
        z = [(sum(float(mean[d]) * float(model.weights[d, j]) for d in range(langid.DIM)) + model.bias[j]) / model.temperature
             for j in range(len(model.langs))]
        chance = [math.exp(v - max(z)) for v in z]
        best = max(range(len(z)), key=lambda j: chance[j])
        assert r.lang_pred == model.langs[best] and r.score == pytest.approx(chance[best] / sum(chance), abs=1e-9)
        assert r.rejected == (r.score < model.min_score)


def test_language_id_of_awkward_rows(spark):
    docs = frame(spark, awkward())
    for model in (langid.fit(docs), langid.train([])):
        out = langid.identify(docs, model)
        assert out.columns == [*(c for c in docs.columns if c != "rejected"), "lang_pred", "score", "rejected"]
        for r in out.collect():
            blank = not model.langs or r.text is None or not any(map(str.isalpha, r.text))
            assert (r.lang_pred == "und") == blank and (not blank or (r.score == 0 and r.rejected))
    assert langid.fit(frame(spark, [])).langs == []
    assert langid.identify(frame(spark, []), model).collect() == []


def test_grams_of_long_texts_are_counted_once(monkeypatch):
    text = " ".join(words(3, 4000)) + " ü1 é"
    whole = langid.gram_counts(text)
    monkeypatch.setattr(langid, "SEGMENT", 501)
    assert (langid.gram_counts(text) == whole).all()
    b = f" {text.lower()} ".encode()
    spaced = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in b)
    n = sum(len(spaced[i:i + k]) == k and spaced[i:i + k].strip(b" ") != b"" and b" " not in spaced[i + 1:i + k - 1]
            for k in range(1, 5) for i in range(len(spaced)))
    assert whole.sum() == n


def test_temperature_softens_wrong_scores():
    z = np.array([[8.0, 0.0]] * 10)
    y = np.array([0] * 7 + [1] * 3)
    t = langid.fit_temperature(z, y)
    assert abs(langid.softmax(z[0] / t)[0] - 0.7) < 0.02


# ------------------------------------------------------------------------- PII
BASE = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def luhn(d):
    t = 0
    for k, c in enumerate(reversed(d)):
        x = int(c) * (1 + k % 2)
        t += x - 9 if x > 9 else x
    return t % 10 == 0


def brute_base(text):
    out = []
    for kind, p in BASE:
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            if (kind == "email" or (kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")))
                    or (kind == "card" and 16 <= len(d) <= 19 and luhn(d)) or (kind == "phone" and 8 <= len(d) <= 15)):
                out.append((kind, m.start(), m.end()))
    return out


PII_TEXTS = [
    "mail a.b+c@x-y.example.com_d@e.fg, then z@z and q@r.s.", "a@b.c@d.e@f.g h@i..j %@-.-", "1.2.3.4.5.6.7.8 256.1.1.1 0001.002.3.255",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 4111111111111111 1", "+1 (386) 555-3733 +12 +1234567 +1.2.3.4.5.6.7.8 ++1 23456789",
    "😀 é a@b.co 𝒳 +49 30 1234567 10.0.0.1", "5500 0000 0000 0004 4", "1" * 5000, "a" * 5000 + "@", "+1" + "(" * 3000, "1." * 3000,
    "", None, "x\n4012 8888 8888 1881\ny@y.yy\n"]


def test_base_spans_match_python(spark):
    r = random.Random(2)
    noise = ["".join(r.choice("ab1290.@+- ()%_é") for _ in range(r.randint(0, 60))) for _ in range(300)]
    rows = list(enumerate(PII_TEXTS + noise)) + [(None, "n@u.ll"), (3, PII_TEXTS[3]), (3, "other q@q.qq")]
    got = pii.report(frame(spark, rows)).collect()
    exp = []
    for i, t in rows:
        s = brute_base(t)
        n = Counter(k for k, _, _ in s)
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in s)
        exp.append((i, n["email"], n["ip"], n["card"], n["phone"], hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got), key=str) == sorted(exp, key=str)
    for r, spans in ((r, (r.spans or "")) for r in got):
        assert hashlib.sha256(",".join(x for x in spans.split(",") if x and not x.startswith("term")).encode()).hexdigest() == r.base_sha256


def secret_rows():
    rows = [(i, f"Meeting of Falconer with person {i} on topic {words(i, 3)[0]}") for i in range(200)]
    rows += [(300 + i, f"The project zephyrus is led by chief@corp.example, note {' '.join(words(500 + i, 4))}") for i in range(4)]
    rows += [(310, "Ask about ZEPHYRUS, budget only"), (311, "zephyruses are winds")]
    return rows


def brute_terms(rows):
    docs = []
    for _, t in rows:
        body = t or ""
        ents = {(k, body[a:b].lower()) for k, a, b in brute_base(body)}
        for _, p in BASE:
            body = re.sub(p, " ", body)
        docs.append((ents, {w for w in re.split(r"[^\w]+|_", body.lower()) if len(w) >= pii.MIN_TERM}))
    n_t, n_e, n_te = Counter(), Counter(), Counter()
    for ents, terms in docs:
        n_t.update(terms)
        n_e.update(ents)
        n_te.update((t, e) for t in terms for e in ents)
    n, out = len(docs), {}
    for (t, e), c in n_te.items():
        if c >= pii.MIN_SUPPORT and n_e[e] < n:
            ratio = math.log(c * n / (n_t[t] * n_e[e])) / math.log(n / n_e[e])
            if ratio >= pii.THRESHOLD:
                out[t] = max(out.get(t, -9), ratio)
    return out


@pytest.mark.parametrize("shipped", [0, 1000])
def test_disclosing_terms_match_brute_force(spark, monkeypatch, shipped):
    monkeypatch.setattr(pii, "BROADCAST_TERMS", shipped)
    rows = secret_rows()
    spans, terms = pii.find_spans(frame(spark, rows))
    got = {r.term: r.strength for r in terms.collect()}
    exp = brute_terms(rows)
    assert got.keys() == exp.keys() and all(abs(got[t] - exp[t]) < 1e-9 for t in exp)
    assert "zephyrus" in got and "meeting" not in got
    texts = dict(rows)
    found = {(r.did, r.start, r.end) for r in spans.where("kind = 4").collect()}
    want = {(i, m.start(), m.end()) for i, t in texts.items() for w in exp
            for m in re.finditer(rf"(?<!\w){w}(?!\w)", t, re.I) if not any(a < m.end() and m.start() < b for _, a, b in brute_base(t))}
    assert found == want and any(i == 310 for i, _, _ in found) and not any(i == 311 for i, _, _ in found)


def test_spans_match_the_sql(spark):
    import duckdb
    import pandas as pd

    from dailyseries.llm.oracles import PII

    rows = secret_rows() + [(1000 + i, t) for i, t in enumerate(PII_TEXTS)]
    documents = pd.DataFrame(rows, columns=["doc_id", "text"])  # noqa: F841
    rel = duckdb.connect().execute(PII)
    names = [d[0] for d in rel.description]
    got = [tuple(r[c] for c in names) for r in pii.digest_columns(pii.report(frame(spark, rows))).collect()]
    assert sorted(got) == sorted(rel.fetchall()) and sum(r[names.index("n_term")] for r in got) > 4


def test_sanitize(spark):
    rows = secret_rows() + [(400, None), (401, ""), (402, "plain"), (403, "+1 (386) 555-3733")]
    out = pii.sanitize(frame(spark, rows))
    got = {r.doc_id: r.clean_text for r in out.collect()}
    assert got[400] is None and got[401] == "" and got[402] == "plain" and got[403] == "[PHONE]"
    assert got[300].startswith("The [WORD] [WORD]") or "zephyrus" not in got[300]
    assert "[EMAIL]" in got[300] and "chief@corp" not in got[300] and "ZEPHYRUS" not in got[310]


def test_pii_of_awkward_rows_and_plan(spark):
    out = pii.report(frame(spark, awkward()))
    assert out.count() == len(awkward())
    assert not re.search("Python|Pandas|Arrow", out._jdf.queryExecution().toString())
    assert pii.report(frame(spark, [])).collect() == []


# ---------------------------------------------------------------- token counts
def test_token_histogram_answers_every_limit(spark):
    rows = [r[:2] for r in awkward()] + [(i, " ".join(words(i, i * 37 % 1900))) for i in range(80)]
    encode = token_counts.encoder(token_counts.default_vocabulary()).encode_ordinary
    lengths = [len(encode(t)) if t else 0 for _, t in rows]
    sums = token_counts.length_table(frame(spark, rows)).cache()
    got = {r.length: r for r in sums.collect()}
    assert {k: r.n_docs for k, r in got.items()} == Counter(lengths)
    for k, r in got.items():
        assert r.docs_from == sum(x >= k for x in lengths) and r.tokens_from == sum(x for x in lengths if x >= k)
        assert r.all_docs == len(rows) and r.all_tokens == sum(lengths)
        assert r.tokens_cut_here == sum(min(x, k) for x in lengths)
        assert r.share_up_to == sum(x <= k for x in lengths) / len(rows)
    limits = [0, 1, 17, 512, 1024, 4096, max(lengths), 10 ** 9]
    assert {r.limit: r.tokens for r in token_counts.truncated_totals(sums, limits).collect()} == {
        x: sum(min(x, n) for n in lengths) for x in limits}
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    order = sorted(lengths)
    assert {r.probability: r.length for r in token_counts.length_quantiles(sums, probs).collect()} == {
        p: order[max(0, math.ceil(p * len(order)) - 1)] for p in probs}


def test_token_counts_of_an_empty_table(spark):
    sums = token_counts.length_table(frame(spark, []))
    assert sums.collect() == []
    assert [r.tokens for r in token_counts.truncated_totals(sums, [5]).collect()] == [0]
    assert [r.length for r in token_counts.length_quantiles(sums, [0.5]).collect()] == [None]


# ------------------------------------------------------------- decontamination
def brute_hits(rows, items, size=10):
    split = lambda t: re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().translate(
        bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))))
    wins = [(i, tuple(w[k:k + size])) for i, t in items if (w := split(t)) for k in range(max(1, len(w) - size + 1))]
    out = []
    for i, t in rows:
        w = split(t)
        hit, ids = set(), set()
        for item, p in wins:
            for k in range(len(w) - len(p) + 1):
                if tuple(w[k:k + len(p)]) == p:
                    hit.update(range(k, k + len(p)))
                    ids.add(item)
        ids = sorted(str(x) for x in ids if x is not None)
        out.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def bench_rows():
    items = [(k, " ".join(words(700 + k, 14))) for k in range(12)]
    items += [(20, "Two words"), (21, None), (22, " ,.! "), (None, "null item id"), (23, items[0][1]), (23, items[1][1]), (9, "Ünïcode-Wörter 42")]
    r, rows = random.Random(4), []
    for k in range(40):
        parts = []
        for _ in range(3):
            w = r.choice(items)[1] or ""
            cut = w.split()[r.randint(0, 3):r.randint(9, 14)]
            parts += [", ".join(words(k * 10 + len(parts), 3)), r.choice([" ", "-", "\n"]).join(cut).title()]
        rows.append((k, " ".join(parts)))
    return rows + [(50, "two  WORDS"), (51, "two wordsx"), (52, "Ünïcode wörter 42?"), (53, "null ITEM id!")] + [r[:2] for r in awkward()], items


@pytest.mark.parametrize("block_bytes", [1 << 20, 150])
def test_decontamination_matches_brute_force(spark, block_bytes):
    rows, items = bench_rows()
    bench = spark.createDataFrame([(*x, "extra") for x in items], "item_id long, text string, n_words string")
    docs = frame(spark, rows)
    out = decontam.decontaminate(docs, bench, block_bytes=block_bytes)
    got = out.collect()
    digest = decontam.digest_columns(out).collect()
    assert sorted((tuple(r) for r in digest), key=str) == brute_hits(rows, items)
    for r in got:  # offsets point into the original text
        seen = [r.text[s.start:s.end] for s in r.hit_spans]
        assert bool(seen) == r.contaminated and all(x == x.strip(" ,.!?-\n") for x in seen)
    assert any(x == "Ünïcode wörter 42" for r in got for s in r.hit_spans for x in [r.text[s.start:s.end]])


def test_decontamination_with_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in decontam.decontaminate(frame(spark, awkward()), none).collect())
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontam.decontaminate(frame(spark, []), bench).collect() == []


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_decontamination_keeps_columns_with_its_inner_names(spark, block_bytes):
    bench = spark.createDataFrame([(1, " ".join(words(1, 12))), (2, " ".join(words(2, 12)))], "item_id long, text string")
    rows = [(1, " ".join(words(1, 12)), 7, "x"), (2, None, 8, "y"), (3, " ".join(words(2, 30)), None, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __hits int, __NEW string")
    out = decontam.decontaminate(docs, bench, block_bytes=block_bytes)
    assert out.columns[:4] == docs.columns
    got = sorted(out.collect())
    assert [tuple(r)[:4] for r in got] == rows and [r.contaminated for r in got] == [True, False, True]
    assert [r.item_ids for r in got] == [["1"], [], ["2"]]
