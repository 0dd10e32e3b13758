"""Quality classifier: supervised subword embeddings.

A document is the average of the vectors of its words and of its character
n-grams, all hashed into one table; a softmax layer turns the average into
class probabilities.  Vectors and layer are trained together by stochastic
gradient descent in numpy on a bounded sample of labelled rows.  Because the
layer is linear in the average, scoring a document only needs each bucket's
logit, which is folded once from vector and layer.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

BITS = 14
NGRAMS = (2, 3, 4)
SAMPLE = 4000


def features(raw: bytes | None):
    """Buckets (sorted, distinct) and counts of the words and n-grams of a
    whole UTF-8 text, A-Z lower-cased, white space as single blanks.  Pairs of
    the same word count as one more word, whichever word it is (bucket 0)."""
    import numpy as np

    from .ngrams import ngram_buckets, pieces, word_hashes
    total = np.zeros(1 << BITS, np.int64)
    data = b" ".join(raw.lower().split()) if raw else b""
    for part in pieces(data):
        words = word_hashes(part.strip(b" "))
        total += np.bincount((words >> np.uint64(64 - BITS)).astype(np.int64), minlength=1 << BITS)
        total[0] += int((words[1:] == words[:-1]).sum())
        for n in NGRAMS:
            total += np.bincount(ngram_buckets(b" " + part.strip(b" ") + b" ", n, BITS),
                                 minlength=1 << BITS)
    at = np.flatnonzero(total)
    return at, total[at]


@dataclass
class EmbeddingClassifier:
    """Vectors (buckets x dim), layer (dim x 2), bias (2)."""

    vectors: object
    layer: object
    bias: object

    def logits(self):
        """Each bucket's logit difference (class 1 less class 0)."""
        return (self.vectors @ (self.layer[:, 1] - self.layer[:, 0])).astype("float32")


def train(docs, labels, dim: int = 12, epochs: int = 12, rate: float = 1.0,
          seed: int = 7) -> EmbeddingClassifier:
    """SGD over (buckets, counts) documents with linear decay of the rate."""
    import numpy as np
    rng = np.random.default_rng(seed)
    model = EmbeddingClassifier(rng.uniform(-1 / dim, 1 / dim, (1 << BITS, dim)).astype("float32"),
                                np.zeros((dim, 2), "float32"), np.zeros(2, "float32"))
    step, steps = 0, max(1, epochs * len(docs))
    for _ in range(epochs):
        for k in rng.permutation(len(docs)):
            lr = rate * (1 - step / steps)
            step += 1
            at, n = docs[k]
            share = (n / max(1, n.sum())).astype("float32")
            hidden = share @ model.vectors[at]
            z = hidden @ model.layer + model.bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[k]] -= 1
            back = model.layer @ p
            model.layer -= lr * np.outer(hidden, p)
            model.bias -= 0.1 * lr * p
            model.vectors[at] -= lr * len(at) ** 0.5 * np.outer(share, back)
    return model


def fit(df: DataFrame, labels: DataFrame, training: Column, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE,
        **options) -> EmbeddingClassifier:
    """Train on at most ``sample`` labelled rows for which ``training`` (a
    condition on the id) holds: those whose id's hash is smallest.

    Rows with null id or label teach nothing.  Without a labelled row the
    model scores every text 0.5.
    """
    import numpy as np
    chosen = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & training)
              .select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
              .orderBy(F.xxhash64("id"), "id", "label").limit(sample))
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = texts.join(F.broadcast(chosen), "id")        # at most ``sample`` rows

    def extract(batches):
        import pyarrow as pa
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                got = [features(t.encode() if t else b"") for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("label"), part.column("id").cast(pa.string()),
                     pa.array([g[0].astype("<u2").tobytes() for g in got], pa.binary()),
                     pa.array([g[1].astype("<u4").tobytes() for g in got], pa.binary())],
                    names=["label", "id", "at", "n"])

    # repeated documents under one id could exceed the sample: the bound holds again
    got = (rows.mapInArrow(extract, "label int, id string, at binary, n binary")
           .orderBy(F.xxhash64("id"), "id", "label", F.xxhash64("at", "n")).limit(sample).collect())
    docs = [(np.frombuffer(r.at, "<u2").astype(int), np.frombuffer(r.n, "<u4").astype("float32"))
            for r in got]
    return train(docs, [r.label for r in got], **options)


def score(df: DataFrame, model: EmbeddingClassifier, text_col: str = "text",
          out: str = "score") -> DataFrame:
    """``df`` with the probability of class 1 of every whole text; null and
    empty texts get the layer's bias alone."""
    bias = float(model.bias[1] - model.bias[0])
    sent = df.sparkSession.sparkContext.broadcast(model.logits())

    def prob(texts):
        import numpy as np
        import pyarrow as pa

        from .common import utf8_slices
        logits, got = sent.value, []
        for part in utf8_slices(texts):
            for raw in part:
                at, n = features(raw)
                z = bias + (float(n @ logits[at]) / n.sum() if len(at) else 0.0)
                got.append(1 / (1 + np.exp(-z)))
        return pa.array(got, pa.float64())

    return df.withColumn(out, F.arrow_udf(prob, "double")(F.col(text_col).cast("string")))
