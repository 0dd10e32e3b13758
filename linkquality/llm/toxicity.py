"""Toxicity by misspelling-tolerant lexicon matches and their context.

The lexicon is a trie; Levenshtein automata (one edit, two for long terms)
run over it, so a word is accepted if it is a term or near one.  Their
intersection is a deterministic automaton over sets of (trie node, edits)
whose states are made when first needed and kept per Python worker.

A match is judged by its window of neighbouring words: quotation marks around
it and verbs of reporting make it quoted, address of the reader or another
match nearby make it reinforced.  Each term has a weight; a logistic model over
sums of weights (exact, misspelled, quoted, reinforced) gives the score.

Beside a seed list, terms are learned from the labelled training rows: words
that stand in toxic documents far more often than in others.  Near copies of
a document share their least word hash and count once, so a copied text does
not turn its words into terms.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import held

#: Abusive terms to start from.
SEED = ("bastard", "blockhead", "brainless", "buffoon", "clown", "coward", "creep", "cretin",
        "degenerate", "despicable", "dimwit", "disgusting", "dumbass", "garbage", "halfwit",
        "idiot", "idiotic", "imbecile", "jackass", "jerk", "loser", "lowlife", "moron", "moronic",
        "nitwit", "pathetic", "repulsive", "scum", "scumbag", "stupid", "trash", "vermin",
        "worthless")
SEED_WEIGHT = 4.0
#: Words that announce a quotation.
REPORTING = frozenset("said says say saying called calls wrote writes quoted quote quotes word "
                      "words term terms insult insults slur slurs phrase replied shouted".split())
#: Address of the reader.
ADDRESS = frozenset("you your yours yourself u ur youre you're".split())
QUOTES = "\"“”«»„'‘’`"
WINDOW = 6
#: Labelled rows to learn from, terms to learn, least documents that have a learned term.
SAMPLE, MAX_TERMS, MIN_DOCS = 12_000, 1000, 4
MISSPELLED, QUOTED, REINFORCED = 1, 2, 4          # bits of a match's kind
_EDGE = re.compile(r"^[^\w@$*]+|[^\w@$*]+$")


def bare(token: str) -> str:
    """A token without punctuation at its edges, lower-cased."""
    return _EDGE.sub("", token).lower()


class FuzzyLexicon:
    """Trie of the terms and its product with Levenshtein automata."""

    def __init__(self, terms):
        self.terms = sorted({t.lower() for t in terms if t})
        self.child: list[dict[str, int]] = [{}]
        self.end: list[int] = [-1]
        self.most = [0]                          # edits that some term below allows
        for k, term in enumerate(self.terms):
            node, allowed = 0, self.edits(term)
            self.most[0] = max(self.most[0], allowed)
            for ch in term:
                if ch not in self.child[node]:
                    self.child[node][ch] = len(self.child)
                    self.child.append({})
                    self.end.append(-1)
                    self.most.append(0)
                node = self.child[node][ch]
                self.most[node] = max(self.most[node], allowed)
            self.end[node] = k
        self.alphabet = {ch for c in self.child for ch in c}
        self._forget()

    def _forget(self) -> None:
        self.steps: list[dict[str, int]] = []    # the product's transitions, made on demand
        self.sets: list[tuple] = []
        self.number: dict[tuple, int] = {}
        self.start = self._state({0: 0})

    @staticmethod
    def edits(term: str) -> int:
        """Edits that a term of this length tolerates."""
        return 0 if len(term) < 5 else 1 if len(term) < 9 else 2

    MAX_STATES = 40_000                          # then they are made anew

    def _state(self, least: dict[int, int]) -> int:
        """Number of the state with these nodes and least edits, letters of
        a term that the word leaves out included; -1 if none is left."""
        todo = list(least.items())
        while todo:
            node, e = todo.pop()
            for nxt in self.child[node].values():
                if e + 1 <= self.most[nxt] and e + 1 < least.get(nxt, 9):
                    least[nxt] = e + 1
                    todo.append((nxt, e + 1))
        key = tuple(sorted(least.items()))
        if not key:
            return -1
        if key not in self.number:
            self.number[key] = len(self.sets)
            self.sets.append(key)
            self.steps.append({})
        return self.number[key]

    def _step(self, state: int, ch: str) -> int:
        least: dict[int, int] = {}
        for node, e in self.sets[state]:
            for c, nxt in self.child[node].items():
                cost = e + (c != ch)
                if cost <= self.most[nxt]:
                    least[nxt] = min(cost, least.get(nxt, 9))
            if e + 1 <= self.most[node]:
                least[node] = min(e + 1, least.get(node, 9))
        return self._state(least)

    def match(self, word: str) -> tuple[str, int] | None:
        """(term, edits) of the nearest term within its edits; of equally near
        ones the first in the alphabet."""
        if len(self.sets) > self.MAX_STATES:
            self._forget()
        state, steps, known = self.start, self.steps, self.alphabet
        for ch in word:
            if ch not in known:
                ch = ""
            nxt = steps[state].get(ch)
            if nxt is None:
                nxt = steps[state][ch] = self._step(state, ch)
            if nxt < 0:
                return None
            state = nxt
        found = [(e, self.end[n]) for n, e in self.sets[state]
                 if self.end[n] >= 0 and e <= self.edits(self.terms[self.end[n]])]
        if not found:
            return None
        edits, term = min(found)
        return self.terms[term], edits


class Scanner(dict):
    """Memo from a raw token to None or (term, edits, quoted by itself)."""

    def __init__(self, terms, memo_words: int = 250_000):
        super().__init__()
        self.lexicon, self.memo_words = FuzzyLexicon(terms), memo_words

    def __missing__(self, token: str):
        word = bare(token)
        hit = self.lexicon.match(word) if 3 < len(word) < 40 else None
        value = hit and (*hit, token[0] in QUOTES and token.rstrip(".,;:!?")[-1:] in QUOTES)
        self[token] = value
        return value

    def matches(self, text: str | None) -> tuple[Counter, int]:
        """How often each (term, kind) occurs in a whole text, and its tokens."""
        kinds: Counter = Counter()
        if not text:
            return kinds, 0
        if len(self) > self.memo_words:
            self.clear()
        tokens = text.split()
        found = [(k, h) for k, h in enumerate(map(self.__getitem__, tokens)) if h]
        for n, (k, (term, edits, own)) in enumerate(found):
            before, after = tokens[max(0, k - WINDOW):k], tokens[k + 1:k + 1 + WINDOW]
            words = set(map(bare, before))
            opened = any(t[0] in QUOTES for t in [*before, tokens[k]])
            closed = any(t.rstrip(".,;:!?")[-1:] in QUOTES for t in [tokens[k], *after]
                         if t.rstrip(".,;:!?"))
            quoted = own or (opened and (closed or bool(REPORTING & words)))
            pressed = bool(ADDRESS & (words | set(map(bare, after)))) or any(
                abs(found[m][0] - k) <= WINDOW for m in (n - 1, n + 1) if 0 <= m < len(found))
            kinds[term, MISSPELLED * (edits > 0) + QUOTED * quoted + REINFORCED * pressed] += 1
        return kinds, len(tokens)


@dataclass
class ToxicityModel:
    """Terms with their weights, terms whose misspellings count, and the
    logistic model (bias first)."""

    weights: dict[str, float]
    fuzzy: frozenset
    logistic: list[float]

    def features(self, kinds: Counter, n: int) -> list[float]:
        exact, near, quoted, pressed, count = Counter(), Counter(), Counter(), {}, 0
        for (term, kind), c in kinds.items():
            if kind & MISSPELLED and term not in self.fuzzy:
                continue
            into = quoted if kind & QUOTED else near if kind & MISSPELLED else exact
            into[term] += c
            if not kind & QUOTED:
                count += c
                if kind & REINFORCED:
                    pressed[term] = self.weights.get(term, 0.0)
        # fsum: the order in which terms occur can't show in the last bit
        sides = [math.fsum(self.weights.get(t, 0.0) * math.log1p(c) for t, c in side.items())
                 for side in (exact, near, quoted)]
        return [1.0, *sides, math.fsum(pressed.values()), math.log1p(100 * count / max(1, n))]

    def score(self, kinds: Counter, n: int) -> float:
        z = sum(w * x for w, x in zip(self.logistic, self.features(kinds, n)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _scanner(terms: tuple[str, ...]) -> Scanner:
    return held(("lexicon", terms), lambda: Scanner(terms))


def _sample(df: DataFrame, labels: DataFrame, training: Column, id_col: str, text_col: str,
            label_col: str, sample: int) -> DataFrame:
    """label and text of at most ``sample`` labelled rows: those whose id's
    hash is smallest."""
    chosen = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & training)
              .select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
              .orderBy(F.xxhash64("id"), "id", "label").limit(sample))
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return texts.join(F.broadcast(chosen), "id").select("label", "text")    # ``sample`` ids


def learn_terms(sample: DataFrame, max_terms: int = MAX_TERMS, min_docs: int = MIN_DOCS) -> dict[str, float]:
    """Words with their log-odds of standing in toxic documents of the sample:
    those whose odds, less 1.64 standard errors, are three to one at least.
    Documents with the same least word hash count as one."""

    def words(batches):
        import zlib

        import pyarrow as pa
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                sets = [sorted({w for w in map(bare, (t or "").split()) if 3 < len(w) < 40})
                        for t in part.column("text").to_pylist()]
                keys = [min((zlib.crc32(w.encode()) for w in s), default=0) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column("label"), pa.array(keys, pa.int64()), pa.array(sets, pa.list_(pa.string()))],
                    names=["label", "key", "words"])

    docs = sample.mapInArrow(words, "label int, key long, words array<string>")
    seen = docs.select("label", "key", F.explode("words").alias("word")).distinct()
    total = {r.label: r["count"] for r in docs.select("label", "key").distinct().groupBy("label").count().collect()}
    n1, n0 = total.get(1, 0), total.get(0, 0)
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    odds = F.log(a / (n1 + 1)) - F.log(b / (n0 + 1))
    rows = (seen.groupBy("word").agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b"))
            .where(F.col("a") >= max(min_docs, 0.003 * n1)).withColumn("odds", odds)
            .where(F.col("odds") - 1.64 * F.sqrt(1 / a + 1 / b) >= math.log(3))
            .orderBy(F.desc("odds"), "word").limit(max_terms).collect())
    return {r.word: r.odds for r in rows}


def fit(df: DataFrame, labels: DataFrame, training: Column, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "toxic", seed=SEED, sample: int = SAMPLE) -> ToxicityModel:
    """Terms, weights and logistic model from at most ``sample`` labelled rows
    for which ``training`` (a condition on the id) holds.

    Null ids and labels teach nothing.  Misspellings of a term count only if
    in the sample they are found in toxic documents at higher odds than in
    others, or in none at all.  Without rows of both labels the seed terms
    decide alone.
    """
    import numpy as np
    rows = _sample(df, labels, training, id_col, text_col, label_col, sample)
    weights = {t: SEED_WEIGHT for t in seed} | learn_terms(rows)
    terms = tuple(sorted(weights))

    def scan(batches):
        import pyarrow as pa
        scanner = _scanner(terms)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                got = [scanner.matches(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("label"), pa.array([[t for t, _ in k] for k, _ in got], pa.list_(pa.string())),
                     pa.array([[x for _, x in k] for k, _ in got], pa.list_(pa.int64())),
                     pa.array([list(k.values()) for k, _ in got], pa.list_(pa.int64())),
                     pa.array([n for _, n in got], pa.int64())], names=["label", "term", "kind", "n", "tokens"])

    # one short row per sampled document, equal ones summed
    got = [(r.label, Counter(dict(zip(zip(r.term, r.kind), r.n))), r.tokens, r["count"])
           for r in rows.mapInArrow(scan, "label int, term array<string>, kind array<long>, "
                                          "n array<long>, tokens long")
           .groupBy("label", "term", "kind", "n", "tokens").count()
           .orderBy("label", "tokens", "term", "kind", "n").collect()]
    near, own, size = {0: Counter(), 1: Counter()}, {0: Counter(), 1: Counter()}, Counter()
    for label, kinds, _, times in got:
        size[label] += times
        for term in {t for t, k in kinds if k & MISSPELLED}:
            near[label][term] += times
        for term in {t for t, k in kinds if not k & (MISSPELLED | QUOTED)}:
            own[label][term] += times
    odds = lambda c, t: math.log((c[1][t] + 0.5) / (size[1] + 1)) - math.log((c[0][t] + 0.5) / (size[0] + 1))
    for t in seed:                          # a seed term that labels speak against loses weight
        if own[0][t] + own[1][t] >= 3:
            weights[t] = max(0.0, odds(own, t))
    fuzzy = frozenset(t for t in weights if near[0][t] + near[1][t] == 0 or odds(near, t) > math.log(3))
    model = ToxicityModel(weights, fuzzy, [-3.0, 1.0, 0.7, 0.0, 0.1, 0.0])
    if min(size[0], size[1]) == 0:
        return model
    x = np.array([model.features(kinds, n) for _, kinds, n, _ in got])
    y, times = np.array([g[0] for g in got]), np.array([g[3] for g in got], float)
    w, ridge = np.array(model.logistic), np.diag([1e-6] + [3e-4] * (x.shape[1] - 1))
    prior = np.array(model.logistic)        # where the sample has no such match
    for _ in range(40):                     # Newton's method
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        share = times / times.sum()
        step = np.linalg.solve((x * (share * (p * (1 - p) + 1e-9))[:, None]).T @ x + ridge,
                               x.T @ (share * (p - y)) + ridge @ (w - prior))
        w = w - np.clip(step, -1, 1)
        if abs(step).max() < 1e-8:
            break
    model.logistic = w.tolist()
    return model


def score(df: DataFrame, model: ToxicityModel, text_col: str = "text", out: str = "score") -> DataFrame:
    """``df`` with the score (0 to 1, higher: likelier toxic) of every whole
    text.  Null and empty texts have no matches; every row is returned once."""
    sent = df.sparkSession.sparkContext.broadcast(model)    # MAX_TERMS and the seed at most

    def rate(texts):
        import pyarrow as pa
        m, got = sent.value, []
        scanner = _scanner(tuple(sorted(m.weights)))
        for at in range(0, len(texts), 128):
            got += [m.score(*scanner.matches(t)) for t in texts.slice(at, 128).to_pylist()]
        return pa.array(got, pa.float64())

    return df.withColumn(out, F.arrow_udf(rate, "double")(F.col(text_col).cast("string")))


def drop_toxic(df: DataFrame, model: ToxicityModel, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows whose score is below ``threshold``, input columns kept; no
    shuffle.  Null and empty texts stay."""
    rows = score(df.select(F.struct(*df.columns).alias("row"), F.col(text_col).alias("text")), model)
    return (rows.where(F.col("score") < F.lit(threshold))
            .select(*[F.col("row").getField(c).alias(c) for c in df.columns]))
