"""Language ID: averaged hashed subword embeddings with a linear softmax.

A text's vector is the mean of the embeddings of its hashed character n-grams
(1 to 4 bytes inside words, word borders included).  Embeddings and softmax
are trained together by stochastic gradient descent in numpy, on a bounded
sample of labelled rows.  A part of the sample is kept out of training to
calibrate the scores (temperature scaling); a text is rejected when the
calibrated chance of its best language is below ``min_score``.

Every task gets the embeddings, a table of fixed size, and one softmax vector
per language.  The driver sees as many sampled rows as ``SAMPLE_ROWS``, dealt
evenly to the languages, as packed counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dailyseries.llm.common import small_batches

UNKNOWN = "und"
ADDED = ["lang_pred", "score", "rejected"]
BUCKET_BITS = 14
DIM = 16
ROWS_PER_LANG = 800   # labelled rows sampled per language, in expectation
SAMPLE_ROWS = 16_000  # and of all languages together
EPOCHS = 6
RATE = 0.5
CALIBRATION_SHARE = 5  # one row in five calibrates
MIN_SCORE = 0.5        # reject where an error is likelier than not
SEGMENT = 1 << 20

# Letters of ASCII are lower-cased, bytes of other characters stay, the rest separates words.
_CLASS = np.array([c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)], np.uint32)
_MULT = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)]


def gram_counts(text: str, bits: int = BUCKET_BITS) -> np.ndarray:
    """How often each bucket's n-grams occur in the whole text."""
    raw = np.frombuffer(f" {text.lower()} ".encode(), np.uint8)
    counts = np.zeros(1 << bits, np.int64)
    shift = np.uint32(32 - bits)
    for at in range(0, max(1, len(raw) - 3), SEGMENT):
        # segments share three bytes, so every n-gram is counted once
        b = _CLASS[raw[at:at + SEGMENT + 3]]
        stop = min(SEGMENT, len(b))
        solid = b != 32
        gram = b.copy()
        for n in range(1, 5):
            if n > 1:
                gram = gram[:-1] | (b[n - 1:] << np.uint32(8 * (n - 1)))
            if n == 1:
                valid = solid
            elif n == 2:
                valid = solid[:-1] | solid[1:]
            elif n == 3:
                valid = solid[1:-1]
            else:
                valid = solid[1:-2] & solid[2:-1]
            h = ((gram[:stop] * _MULT[n - 1]) >> shift)[valid[:stop]]
            counts += np.bincount(h, minlength=1 << bits)
    return counts


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


@dataclass
class Model:
    langs: list[str]
    embeddings: np.ndarray  # (buckets, dimensions)
    weights: np.ndarray     # (dimensions, languages)
    bias: np.ndarray
    temperature: float = 1.0
    min_score: float = MIN_SCORE

    def logits(self, counts: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(counts)
        return counts[at] / max(1, counts.sum()) @ self.embeddings[at] @ self.weights + self.bias

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, calibrated score, rejected)."""
        if not self.langs or not has_letter(text):
            return UNKNOWN, 0.0, True
        p = softmax(self.logits(gram_counts(text)) / self.temperature)
        k = int(p.argmax())
        return self.langs[k], float(p[k]), bool(p[k] < self.min_score)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


def train(rows: list[tuple[str, np.ndarray, np.ndarray]], epochs: int = EPOCHS, dim: int = DIM, rate: float = RATE,
          bits: int = BUCKET_BITS, seed: int = 17) -> Model:
    """Fit on (language, bucket numbers, counts) rows; the last share calibrates."""
    langs = sorted({r[0] for r in rows})
    if not langs:
        return Model([], np.zeros((1 << bits, dim)), np.zeros((dim, 0)), np.zeros(0))
    y = np.array([langs.index(r[0]) for r in rows])
    held = np.arange(len(rows)) % CALIBRATION_SHARE == 0
    if len(rows) < 10 * CALIBRATION_SHARE:
        held[:] = False
    rng = np.random.default_rng(seed)
    e = rng.uniform(-1 / dim, 1 / dim, (1 << bits, dim))
    w = np.zeros((dim, len(langs)))
    b = np.zeros(len(langs))
    fit = np.flatnonzero(~held)
    total, step = epochs * len(fit), 0
    for _ in range(epochs):
        for i in rng.permutation(fit):
            _, idx, cnt = rows[i]
            share = cnt / cnt.sum()
            x = share @ e[idx]
            g = softmax(x @ w + b)
            g[y[i]] -= 1
            lr = rate * (1 - step / total)
            back = w @ g
            w -= lr * np.outer(x, g)
            b -= 0.1 * lr * g
            # the mean spreads the gradient over the text; undo the 1/length for a usable step
            e[idx] -= lr * 50 * np.outer(share, back)
            step += 1
    model = Model(langs, e, w, b)
    sample = np.flatnonzero(held) if held.any() else fit
    z = np.array([rows[i][2] / rows[i][2].sum() @ e[rows[i][1]] @ w + b for i in sample])
    model.temperature = fit_temperature(z, y[sample])
    return model


def fit_temperature(z: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least negative log-likelihood, at least 1: a
    sample without errors would otherwise push every score to 1."""
    def loss(t: float) -> float:
        s = z / t
        s = s - s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(y)), y]).mean())

    grid = np.geomspace(1, 50, 121)
    return float(grid[int(np.argmin([loss(t) for t in grid]))])


def held_out(doc_id) -> object:
    """Whether a document is kept from training; a null id is neither."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def sample_rows(docs: DataFrame, per_lang: int = ROWS_PER_LANG) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """N-gram counts of about ``per_lang`` labelled rows per language, chosen
    by hash among those that may be learned from, and of no more than about
    ``SAMPLE_ROWS`` in all; whole texts are counted in the tasks, and the
    driver gets vectors of bounded size.  Every label is sampled; more labels
    than ``SAMPLE_ROWS`` raise, for there would be no row for each."""
    small_batches(docs.sparkSession)
    text = F.col("text").cast("string")
    lang = F.col("lang").cast("string")
    usable = docs.where(lang.isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % 3 != 1) & text.rlike(r"\p{L}"))
    sizes = (usable.groupBy(lang.alias("lang")).count().orderBy(F.desc("count"), "lang").limit(SAMPLE_ROWS + 1).collect())
    if len(sizes) > SAMPLE_ROWS:
        raise ValueError(f"more than {SAMPLE_ROWS} languages: no row would be left for each")
    if not sizes:
        return []
    per_lang = max(1, min(per_lang, SAMPLE_ROWS // len(sizes)))
    shares = docs.sparkSession.createDataFrame([(r["lang"], min(1.0, per_lang / r["count"])) for r in sizes],
                                               "__lang string, __share double")
    # a salt of its own: nothing else picks the same rows
    place = F.pmod(F.xxhash64(F.lit("langid"), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))

    @F.pandas_udf("idx binary, cnt binary")
    def vector(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            c = gram_counts(t)
            idx = np.flatnonzero(c)
            rows.append((idx.astype(np.int32).tobytes(), np.minimum(c[idx], (1 << 31) - 1).astype(np.int32).tobytes()))
        return pd.DataFrame({"idx": [r[0] for r in rows], "cnt": [r[1] for r in rows]})

    usable = usable.select(lang.alias("__l"), place.alias("__place"), "doc_id", "text")
    # SAMPLE_ROWS rows of two numbers at most
    chosen = (usable.join(F.broadcast(shares), F.col("__l") == F.col("__lang")).where("__place < __share")
              .select(F.col("__l").alias("lang"), F.xxhash64("doc_id").alias("h"), F.xxhash64("doc_id", text).alias("o"),
                      vector(text).alias("v")))
    # cuts only if one id repeats very often; equal rows are interchangeable
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("o"))
    chosen = chosen.withColumn("nth", nth).where(F.col("nth") <= 2 * per_lang)
    got = sorted(chosen.collect(), key=lambda r: (r["h"], r["lang"], r["o"]))
    return [(r["lang"], np.frombuffer(bytes(r["v"]["idx"]), np.int32), np.frombuffer(bytes(r["v"]["cnt"]), np.int32))
            for r in got]


def fit(docs: DataFrame, per_lang: int = ROWS_PER_LANG) -> Model:
    return train(sample_rows(docs, per_lang))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred, score and rejected added (columns of these
    names are replaced).

    Only the text is read.  A text that is null or has no letter is ``und``
    with score 0 and rejected; so is every text if the model knows no
    language (no labelled rows).  Of languages with the same chance the first
    in alphabetical order is predicted.  A very long text is counted whole, a
    segment at a time.  Repeated rows get equal results; an empty table gives
    no rows.
    """
    small_batches(docs.sparkSession)
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shipped.value
        for texts in batches:
            yield pd.DataFrame([m.predict(t) for t in texts], columns=["lang_pred", "score", "rejected"])

    base = docs.drop(*ADDED, "__p")
    out = base.withColumn("__p", predict(F.col("text").cast("string")))
    return out.select(*base.columns, "__p.lang_pred", "__p.score", "__p.rejected")
