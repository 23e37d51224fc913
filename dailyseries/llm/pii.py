"""Personal data: base patterns plus information-theoretic sanitisation.

Base spans come from fixed patterns (email, ip, card, phone).  Their values
are the protected entities.  A term discloses an entity when seeing it makes
the entity nearly certain: with document counts over the whole corpus,

    PMI(t; e) = log( n(t, e) * N / (n(t) * n(e)) )  >=  threshold * IC(e),
    IC(e) = log( N / n(e) ),

where PMI = IC means that the entity is in every document with the term.
Terms above ``remove`` times the information content are removed, the others
above ``threshold`` are generalised to their shape.  A pair counts only from
``min_support`` documents on; one document alone proves no association.

DataFrame functions only.  Character positions come from the lengths of what
lies between matches, summed per document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dailyseries.llm.common import ascii_lower, materialize
from dailyseries.llm.line_dedup import NULL_ID

KINDS = ["email", "ip", "card", "phone"]
TERM = len(KINDS)  # number of the added kind
THRESHOLD = 0.9
REMOVE = 0.98
MIN_SUPPORT = 3
MIN_TERM = 4
BROADCAST_TERMS = 500_000  # at most so many short strings are shipped to the tasks

# A match starts at the head of its run of characters or where the last match
# ended; other starts can't match or aren't leftmost.  With possessive
# quantifiers every pattern is linear and needs no deep stack.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
GUARDS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    back = F.reverse(digits)

    def step(total, i):
        d = F.substring(back, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0


def _valid(kind: Column, hit: Column) -> Column:
    digits = _digits(hit)
    return (F.when(kind == KINDS.index("ip"), hit.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"))
            .when(kind == KINDS.index("card"),
                  F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(False))
            .when(kind == KINDS.index("phone"), F.length(digits).between(8, 15))
            .otherwise(True))


def _keyed(docs: DataFrame) -> DataFrame:
    """did, th (a text hash that keeps rows sharing an id apart), body."""
    body = F.coalesce(docs["text"].cast("string"), F.lit(""))
    return docs.select(F.coalesce(docs["doc_id"].cast("long"), F.lit(NULL_ID)).alias("did"),
                       F.xxhash64(body).alias("th"), body.alias("body"))


def _pieces(body: Column, pattern: Column | str, kind: Column) -> Column:
    """(kind, i, gap, hit) of each match: the length of what lies before it
    since the last match, and its text."""
    p = F.lit(pattern) if isinstance(pattern, str) else pattern
    hits = F.regexp_extract_all(body, p, F.lit(0))
    gaps = F.call_function("split", body, p, F.lit(-1))
    return F.transform(F.arrays_zip(hits.alias("hit"), F.slice(gaps, F.lit(1), F.size(hits)).alias("gap")),
                       lambda x, i: F.struct(kind.alias("kind"), i.alias("i"), F.char_length(x["gap"]).alias("gap"),
                                             x["hit"].alias("hit")))


def _placed(pieces: DataFrame) -> DataFrame:
    """Turn gaps into code-point offsets, end exclusive."""
    own = Window.partitionBy("did", "th", "kind").orderBy("i")
    end = F.sum(F.col("gap") + F.char_length("hit")).over(own)
    return (pieces.distinct().withColumn("end", end)
            .select("did", "th", "kind", (F.col("end") - F.char_length("hit")).alias("start"), "end", "hit"))


def base_spans(docs: DataFrame) -> DataFrame:
    """(did, th, kind, start, end, hit): all valid base spans."""
    keyed = _keyed(docs)
    found = [F.when(F.col("body").rlike(GUARDS[k]), _pieces(F.col("body"), PATTERNS[k], F.lit(n)))
             .otherwise(F.array()) for n, k in enumerate(KINDS)]
    pieces = keyed.select("did", "th", F.explode(F.concat(*found)).alias("x")).select("did", "th", "x.*")
    return _placed(pieces).where(_valid(F.col("kind"), F.col("hit")))


def entity(kind: Column, hit: Column) -> Column:
    return F.concat_ws(":", kind.cast("string"), F.when(kind == 0, ascii_lower(hit)).when(kind == 1, hit)
                       .otherwise(_digits(hit)))


def _entities_of(body: Column, kind: int) -> Column:
    hits = F.regexp_extract_all(body, F.lit(PATTERNS[KINDS[kind]]), F.lit(0))
    valid = F.filter(hits, lambda h: _valid(F.lit(kind), h))
    found = F.transform(valid, lambda h: entity(F.lit(kind), h))
    return F.when(body.rlike(GUARDS[KINDS[kind]]), found).otherwise(F.array().cast("array<string>"))


def _entities(body: Column) -> Column:
    """The distinct protected entities of a text."""
    return F.array_distinct(F.concat(*[_entities_of(body, k) for k in range(len(KINDS))]))


def _terms(body: Column) -> Column:
    """Distinct lower-case words of a text, its personal data left out."""
    for k in KINDS:
        body = F.when(body.rlike(GUARDS[k]), F.regexp_replace(body, PATTERNS[k], " ")).otherwise(body)
    words = F.call_function("split", F.lower(body), F.lit(r"[^\p{L}\p{N}]+"), F.lit(-1))
    return F.filter(F.array_distinct(words), lambda w: F.char_length(w) >= MIN_TERM)


def disclosing_terms(docs: DataFrame, threshold: float = THRESHOLD, remove: float = REMOVE,
                     min_support: int = MIN_SUPPORT) -> DataFrame:
    """(term, strength): terms whose strongest PMI / IC reaches ``threshold``.

    All counts are numbers of rows over the whole table.  Entities and terms
    of a text meet in its own row, so no text is shuffled; pairs come from
    texts with personal data only, and term counts are combined before the
    shuffle to one row per term and task.
    """
    keyed = _keyed(docs)
    texts = keyed.select("body", _entities(F.col("body")).alias("es")).where(F.size("es") > 0)
    texts = materialize(texts.select("es", _terms(F.col("body")).alias("terms")), "pii-texts")
    each = texts.select("terms", F.explode("es").alias("e"))
    often = each.groupBy("e").agg(F.count("*").alias("n_e")).where(F.col("n_e") >= min_support)
    pairs = (each.join(often, "e").select("e", "n_e", F.explode("terms").alias("term")).groupBy("term", "e", "n_e")
             .agg(F.count("*").alias("n_te")).where(F.col("n_te") >= min_support))
    pairs = materialize(pairs.select("term", "e", "n_e", "n_te"), "pii-pairs")
    counts = (keyed.select(F.explode(_terms(F.col("body"))).alias("term")).groupBy("term")
              .agg(F.count("*").alias("n_t")).where(F.col("n_t") >= min_support))
    total = float(docs.count())
    ratio = F.log(F.col("n_te") * total / (F.col("n_t") * F.col("n_e"))) / F.log(F.lit(total) / F.col("n_e"))
    # an entity in every document has no information to disclose
    scored = (counts.join(pairs, "term").where(F.col("n_e") < total)
              .groupBy("term").agg(F.max(ratio).alias("strength")).where(F.col("strength") >= threshold))
    return scored.withColumn("removed", F.col("strength") >= remove)


def term_spans(docs: DataFrame, base: DataFrame, terms: DataFrame) -> DataFrame:
    """(did, th, kind, start, end, hit) of every occurrence of a disclosing
    term outside base spans.

    The term list is measured: up to ``BROADCAST_TERMS`` terms it is shipped
    to the tasks, beyond that the words are shuffled to it.
    """
    keyed = _keyed(docs)
    listed = terms.select("term")
    if terms.count() <= BROADCAST_TERMS:
        # in one pass; only texts that hold a term are shuffled
        words = keyed.select("did", "th", "body", F.explode(_terms(F.col("body"))).alias("term"))
        own = (words.join(F.broadcast(listed), "term").groupBy("did", "th")
               .agg(F.collect_set("term").alias("own"), F.first("body").alias("body")))
    else:
        own = (keyed.select("did", "th", F.explode(_terms(F.col("body"))).alias("term")).join(listed, "term")
               .groupBy("did", "th").agg(F.collect_set("term").alias("own"))
               .withColumnsRenamed({"did": "o_did", "th": "o_th"}))
        own = keyed.join(own, (F.col("did") == F.col("o_did")) & (F.col("th") == F.col("o_th")))
    # terms are letters and digits only, so they need no quoting
    pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), F.array_join("own", "|"), F.lit(r")(?![\p{L}\p{N}])"))
    pieces = (own.select("did", "th", F.explode(_pieces(F.col("body"), pattern, F.lit(TERM))).alias("x"))
              .select("did", "th", "x.*"))
    placed = _placed(pieces)
    taken = base.groupBy("did", "th").agg(F.collect_list(F.struct("start", "end")).alias("b"))
    inside = F.exists("b", lambda x: (x["start"] < F.col("end")) & (F.col("start") < x["end"]))
    return (placed.join(taken, ["did", "th"], "left").where(F.col("b").isNull() | ~inside)
            .select("did", "th", "kind", "start", "end", "hit"))


def find_spans(docs: DataFrame, threshold: float = THRESHOLD, remove: float = REMOVE,
               min_support: int = MIN_SUPPORT) -> tuple[DataFrame, DataFrame]:
    """(spans, terms): all spans (did, th, kind, start, end, hit) and the
    disclosing terms (term, strength, removed)."""
    base = materialize(base_spans(docs), "pii-base")
    terms = materialize(disclosing_terms(docs, threshold, remove, min_support), "pii-terms")
    spans = base.unionByName(term_spans(docs, base, terms))
    return spans, terms


def _spans_per_document(docs: DataFrame, spans: DataFrame) -> DataFrame:
    per = (spans.groupBy("did", "th").agg(F.array_sort(F.collect_list(F.struct("kind", "start", "end", "hit"))).alias("s"))
           .withColumnsRenamed({"did": "s_did", "th": "s_th"}))
    return per


def _text_of(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in [*KINDS, "term"]])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])), ",")


def _count(spans: str, kind: int) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")


def report(docs: DataFrame, **options) -> DataFrame:
    """Per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone, n_term,
    base_sha256 and spans.

    A null text is empty and has no spans; empty and span-free texts give the
    digest of the empty string.  Rows that share a doc_id are judged each by
    its own text; repeated rows get equal results.  A very long text is
    searched whole.  An empty table gives no rows; other columns are not read,
    whatever their names.
    """
    spans, _ = find_spans(docs, **options)
    per = _spans_per_document(docs, spans)
    body = F.coalesce(docs["text"].cast("string"), F.lit(""))
    keys = docs.select(docs["doc_id"].alias("doc_id"), F.coalesce(docs["doc_id"].cast("long"), F.lit(NULL_ID)).alias("did"),
                       F.xxhash64(body).alias("th"))
    s = F.coalesce("s", F.array().cast("array<struct<kind:int,start:bigint,end:bigint,hit:string>>"))
    out = keys.join(per, (F.col("did") == F.col("s_did")) & (F.col("th") == F.col("s_th")), "left").withColumn("s", s)
    counts = [_count("s", n).alias(f"n_{k}") for n, k in enumerate([*KINDS, "term"])]
    return out.select("doc_id", *counts,
                      F.sha2(_text_of(F.filter("s", lambda x: x["kind"] < TERM)), 256).alias("base_sha256"),
                      _text_of(F.col("s")).alias("spans"))


def sanitize(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with ``clean_text`` added: base spans become their kind in
    brackets, strongly disclosing terms are removed, the others become their
    shape.  Where base spans of two kinds overlap, the one that starts first
    (then the earlier kind) is replaced, the rest of the other is removed.  A
    null text stays null.
    """
    spans, terms = find_spans(docs, **options)
    strong = terms.select(F.col("term").alias("t_term"), "removed")
    lettered = F.col("hit").rlike(r"^\p{L}+$")
    label = (F.when(F.col("kind") < TERM, F.concat(F.lit("["), F.upper(F.get(F.array(*[F.lit(k) for k in KINDS]),
                                                                             F.col("kind"))), F.lit("]")))
             .when(F.col("removed"), F.lit("")).when(lettered, F.lit("[WORD]")).otherwise(F.lit("[CODE]")))
    named = spans.join(strong, (F.col("kind") == TERM) & (F.lower("hit") == F.col("t_term")), "left")
    per = (named.groupBy("did", "th")
           .agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end", label.alias("label")))).alias("__s"))
           .withColumnsRenamed({"did": "__s_did", "th": "__s_th"}))
    base = docs.drop("clean_text")
    text = F.col("text").cast("string")
    body = F.coalesce(text, F.lit(""))
    keyed = base.withColumns({"__did": F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)), "__th": F.xxhash64(body)})
    out = keyed.join(per, (F.col("__did") == F.col("__s_did")) & (F.col("__th") == F.col("__s_th")), "left")

    def step(acc, x):
        fresh = x["start"] >= acc["at"]
        gap = F.when(fresh, F.substring(body, (acc["at"] + 1).cast("int"), (x["start"] - acc["at"]).cast("int")))
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"),
                        F.concat(acc["out"], F.when(fresh, F.concat(gap, x["label"])).otherwise("")).alias("out"))

    clean = F.aggregate("__s", F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out")), step,
                        lambda acc: F.concat(acc["out"], F.substring(body, (acc["at"] + 1).cast("int"),
                                                                     F.char_length(body))))
    return out.select(*base.columns, F.when(F.col("__s").isNull(), text).otherwise(clean).alias("clean_text"))


def digest_columns(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_term")
