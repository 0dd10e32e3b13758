"""URL filter: rules by host and path, then a weighted vocabulary.

An Aho-Corasick automaton counts the vocabulary's terms in the whole url; a
term counts only between boundaries (no letter or digit on either side).  One
strict term rejects a url, and so do several distinct soft terms whose weights
reach a threshold: a term that speaks for such a site weighs 1, one that
ordinary shops use too 0.5.  Rules, where one fits, decide instead.  The
vocabulary is a parameter; ``vocabulary_of`` reads it from a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import LOWER, UPPER

#: Terms that reject a url alone.
STRICT = ("adult", "casino", "escort", "porn", "sex", "viagra", "xxx")
#: Terms that reject it together, with their weights.
SOFT = {"bet": 1.0, "bets": 1.0, "betting": 1.0, "bonus": 1.0, "cam": 1.0, "cheap": 1.0,
        "dating": 1.0, "deal": 0.5, "deals": 0.5, "free": 1.0, "gambling": 1.0, "jackpot": 1.0,
        "loan": 1.0, "lottery": 1.0, "pills": 1.0, "poker": 1.0, "prize": 1.0, "slots": 1.0,
        "win": 0.5, "winner": 1.0}
SOFT_THRESHOLD = 2.0

#: (host and path, verdict) of the rules
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
         ("net/es/", "block"), ("net/fr/", "block"))


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty for null or without ``://``."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty as for the host."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, or null: its host is the url's or a parent
    domain of it, and the url's path starts with its path."""
    tests = []
    for rule, _ in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        own, slash, rest = rule.partition("/")
        fits = (host == own) | host.endswith("." + own)
        tests.append(F.when(fits & path.startswith(slash + rest), F.lit(rule)))
    return F.coalesce(*tests, F.lit(None).cast("string"))


def term_hits(text: str | None, automaton) -> dict[str, int]:
    """How often each term stands in the text between boundaries."""
    low, hits = (text or "").lower(), {}
    for end, term in automaton.iter(low):
        start = end - len(term) + 1
        if (start == 0 or not low[start - 1].isalnum()) and \
                (end + 1 == len(low) or not low[end + 1].isalnum()):
            hits[term] = hits.get(term, 0) + 1
    return hits


def vocabulary_of(terms: DataFrame, limit: int = 100_000) -> tuple[tuple[str, ...], dict[str, float]]:
    """(strict, soft) from a table (term, weight); a null weight means strict.
    Null and empty terms are left out, of a repeated term strict or else the
    largest weight counts.  The automaton goes to every task, so more than
    ``limit`` terms are refused."""
    rows = (terms.where("term <> ''").groupBy(F.lower("term").alias("term"))
            .agg(F.max(F.col("weight").isNull()).alias("strict"), F.max("weight").cast("double").alias("weight"))
            .limit(limit + 1).collect())
    if len(rows) > limit:
        raise ValueError(f"the vocabulary has more than {limit} terms")
    return (tuple(sorted(r["term"] for r in rows if r["strict"])),
            {r["term"]: r["weight"] for r in rows if not r["strict"]})


def vocabulary_counts(text: Column, strict=STRICT, soft=SOFT) -> Column:
    """struct(strict_hits, soft_hits, soft_terms, soft_weight): occurrences of
    strict and soft terms, and distinct soft terms with their summed weight."""
    strict, soft = tuple(strict), dict(soft)

    def count(texts):
        import ahocorasick
        import pyarrow as pa
        automaton = ahocorasick.Automaton()
        for term in (*strict, *soft):
            automaton.add_word(term.lower(), term.lower())
        automaton.make_automaton()
        hard, weights, out = {t.lower() for t in strict}, {t.lower(): w for t, w in soft.items()}, []
        for text in texts.to_pylist():
            hits = term_hits(text, automaton) if len(automaton) else {}
            found = sorted(t for t in hits if t in weights and t not in hard)
            out.append({"strict_hits": sum(n for t, n in hits.items() if t in hard),
                        "soft_hits": sum(hits[t] for t in found), "soft_terms": len(found),
                        "soft_weight": float(sum(weights[t] for t in found))})
        return pa.array(out, pa.struct([("strict_hits", pa.int64()), ("soft_hits", pa.int64()),
                                        ("soft_terms", pa.int64()), ("soft_weight", pa.float64())]))

    return F.arrow_udf(count, "struct<strict_hits:bigint,soft_hits:bigint,soft_terms:bigint,"
                              "soft_weight:double>")(text)


def judge_urls(df: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES,
               strict=STRICT, soft=SOFT, threshold: float = SOFT_THRESHOLD,
               min_terms: int = 2) -> DataFrame:
    """One row per input row: id, host, path, rule, verdict and the counts.

    ``verdict`` is the longest fitting rule's; without one it is ``block``
    for a strict term, or for ``min_terms`` distinct soft terms that weigh
    ``threshold`` together, else ``allow``.  Null and empty urls have empty
    host and path, no rule and no terms (allow); malformed ones have empty
    host and path, and terms like any other.  Repeated rows
    are judged each; an empty table gives no rows; other columns are not read.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                     url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    verdicts = F.create_map(*[F.lit(x) for r in rules for x in r]) if rules else None
    rows = (rows.withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
            .withColumn("hits", vocabulary_counts(F.col("url"), strict, soft)))
    by_terms = F.when((F.col("hits.strict_hits") > 0)
                      | ((F.col("hits.soft_terms") >= min_terms)
                         & (F.col("hits.soft_weight") >= threshold)), "block").otherwise("allow")
    by_rule = F.try_element_at(verdicts, F.col("rule")) if rules else F.lit(None).cast("string")
    return rows.select(F.col("id").alias(id_col), "host", "path", "rule",
                       F.coalesce(by_rule, by_terms).alias("verdict"),
                       "hits.strict_hits", "hits.soft_hits", "hits.soft_terms")
