"""Language identification by error-correcting output codes.

Each learned language gets a codeword; for each bit a binary classifier on
hashed byte n-grams tells the languages whose bit is one from the others.
The classifiers are log-odds of smoothed n-gram frequencies, the languages of
a side weighing alike, so a language that fills a third of the rows gains
nothing by it.  They are fitted on all training rows: every task sums its
counts and Spark adds them up.  A second pass measures how often each bit is
right on each language; decoding takes the codeword with the smallest loss,
each bit's logistic loss weighted by that rate.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

BITS = 13
SIZES = (1, 2, 3, 4)
MAX_LANGUAGES = 1000

_BLANK = bytes(c if chr(c).isalpha() or c >= 128 else 32 for c in range(256))


def letters(text: str | None) -> bytes | None:
    """The lower-cased text with ASCII non-letters as single blanks; None if
    it has no letter."""
    if not text:
        return None
    low = b" ".join(text.lower().encode().translate(_BLANK).split())
    if not low or (low.upper() == low and not any(map(str.isalpha, text))):
        return None
    return b" " + low + b" "


def counts(data: bytes):
    """How often each n-gram bucket occurs."""
    import numpy as np

    from .ngrams import ngram_buckets, pieces
    total = np.zeros(1 << BITS, np.int64)
    for part in pieces(data):
        for n in SIZES:
            total += np.bincount(ngram_buckets(part, n, BITS), minlength=1 << BITS)
    return total


def code_matrix(k: int):
    """Codewords (k rows of +1 and -1), far from one another.  Up to 6
    languages: every split into two sides.  Beyond: 15 log2(k) random splits,
    the best of 50 draws (fixed seed) by the least distance."""
    import numpy as np
    if k < 2:
        return np.ones((k, 0), np.int8)
    if k <= 6:
        cols = [[1] + [1 if m >> j & 1 else -1 for j in range(k - 1)] for m in range(2 ** (k - 1) - 1)]
        return np.array(cols, np.int8).T
    rng, best = np.random.default_rng(42), (-1, None)
    for _ in range(50):
        m = rng.choice(np.array([-1, 1], np.int8), (k, math.ceil(15 * math.log2(k))))
        m = m[:, (m.min(0) < 0) & (m.max(0) > 0)]
        dist = (m.shape[1] - m.astype(int) @ m.T.astype(int)) // 2 + np.eye(k, dtype=int) * 10 ** 6
        best = max(best, (int(dist.min()), m), key=lambda x: x[0])
    return best[1]


@dataclass
class LanguageModel:
    """What prediction needs; bounded by the number of languages."""

    names: list[str]
    code: object                    # languages x bits
    weights: object                 # buckets x bits
    trust: object                   # languages x bits, each row sums to 1
    margin: float = 0.2             # ambiguous: best and second score nearer than this

    def margins(self, data: bytes):
        c = counts(data)
        return c @ self.weights / math.sqrt(max(1, c.sum()))

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, ambiguous); `und`, 0 without a letter or model."""
        import numpy as np
        data = letters(text)
        if data is None or not self.names:
            return "und", 0.0, True
        if len(self.names) == 1:
            return self.names[0], 1.0, False
        loss = (np.logaddexp(0, -self.code * self.margins(data)) * self.trust).sum(1)
        p = np.exp(loss.min() - loss)
        p /= p.sum()
        order = np.argsort(-p, kind="stable")
        best = int(order[0])
        return self.names[best], float(p[best]), bool(p[best] - p[order[1]] < self.margin)


def _training_rows(df: DataFrame, text_col: str, lang_col: str, training: Column) -> DataFrame:
    return (df.where(training & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
            .select(F.col(lang_col).cast("string").alias("lang"),
                    F.col(text_col).cast("string").alias("text")))


def _rows(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            yield from zip(part.column("lang").to_pylist(), map(letters, part.column("text").to_pylist()))


def fit(df: DataFrame, training: Column, text_col: str = "text", lang_col: str = "lang",
        margin: float = 0.2) -> LanguageModel:
    """Learn from the rows where ``training`` holds; see the module's text.

    Rows with null language, null text or no letter teach nothing.  At most
    1,000 languages are accepted (ValueError beyond).  No rows: a model that
    answers `und`.
    """
    import numpy as np
    spark, rows = df.sparkSession, _training_rows(df, text_col, lang_col, training)

    def count(batches):
        import pyarrow as pa
        total: dict = {}
        for lang, data in _rows(batches):
            if data is not None:
                total[lang] = total.get(lang, 0) + counts(data)
        for lang, c in total.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()),
                 pa.array(c[at], pa.int64())], names=["lang", "bucket", "n"])

    summed = (rows.mapInArrow(count, "lang string, bucket long, n long")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    table: dict = {}
    for r in summed.toLocalIterator():      # languages x 2**BITS rows at most
        if r.lang not in table and len(table) == MAX_LANGUAGES:
            raise ValueError(f"more than {MAX_LANGUAGES} languages")
        table.setdefault(r.lang, np.zeros(1 << BITS))[r.bucket] = r.n
    names = sorted(table)
    code = code_matrix(len(names))
    if len(names) < 2:
        return LanguageModel(names, code, np.zeros((1 << BITS, 0)), code, margin)
    p = np.stack([(table[x] + 0.5) / (table[x].sum() + 0.5 * (1 << BITS)) for x in names])
    one, other = (code > 0).astype(float), (code < 0).astype(float)
    weights = (np.log(p.T @ one / one.sum(0)) - np.log(p.T @ other / other.sum(0))).astype("float32")
    model = LanguageModel(names, code, weights, np.full(code.shape, 1 / code.shape[1]), margin)
    sent = spark.sparkContext.broadcast(model)

    def judge(batches):
        import pyarrow as pa
        m, right = sent.value, {}
        place = {x: k for k, x in enumerate(m.names)}
        for lang, data in _rows(batches):
            if data is not None:
                ok = m.margins(data) * m.code[place[lang]] > 0
                right[lang] = right.get(lang, 0) + np.append(ok.astype(np.int64), 1)
        for lang, c in right.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(c)), pa.array(range(len(c)), pa.int64()),
                 pa.array(c, pa.int64())], names=["lang", "bit", "n"])

    hits = np.zeros((len(names), code.shape[1] + 1))
    for r in (rows.mapInArrow(judge, "lang string, bit long, n long")
              .groupBy("lang", "bit").agg(F.sum("n").alias("n")).toLocalIterator()):
        hits[names.index(r.lang), r.bit] = r.n
    rate = (hits[:, :-1] + 1) / (hits[:, -1:] + 2)
    model.trust = rate / rate.sum(1, keepdims=True)
    return model


def identify(df: DataFrame, model: LanguageModel, text_col: str = "text",
             out: str = "language") -> DataFrame:
    """``df`` with a struct column ``out``: lang_pred, score, ambiguous.

    Null texts and texts without a letter are `und`, score 0, ambiguous;
    equal losses go to the language that sorts first; every row of the input
    is returned once.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)

    def predict(texts):
        import pyarrow as pa
        m, got = sent.value, []
        for at in range(0, len(texts), 256):
            got += map(m.predict, texts.slice(at, 256).to_pylist())
        return pa.array([dict(zip(("lang_pred", "score", "ambiguous"), g)) for g in got],
                        pa.struct([("lang_pred", pa.string()), ("score", pa.float64()),
                                   ("ambiguous", pa.bool_())]))

    return df.withColumn(out, F.arrow_udf(
        predict, "struct<lang_pred:string,score:double,ambiguous:boolean>")(
            F.col(text_col).cast("string")))
