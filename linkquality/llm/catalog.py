"""Registered queries of the operators in this folder and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..conf import scratch_path
from . import dialogue_repair, langid, quality, toxicity
from .chat import perspectives
from .common import checkpointed, table
from .decontaminate import contamination_report
from .exact_dedup import exact_duplicates
from .packing import pack_documents, piece_digest
from .phrases import collocations
from .simhash import near_duplicates
from .token_counts import encoded_lengths, length_histogram
from .token_files import file_starts, read_token_files, write_token_files
from .url_filter import SOFT, STRICT, judge_urls

Query = Callable[[SparkSession, str], DataFrame]


def id_hash(mod: int) -> Column:
    """CRC-32 of doc_id as text, modulo ``mod``; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string")) % mod


def toxicity_training() -> Column:
    """Ids whose labels the toxicity model may learn from."""
    return id_hash(3) != 1


def op1_chat_perspectives(spark: SparkSession, sf: str) -> DataFrame:
    return perspectives(table(spark, sf, "conversations"))


def op2_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    rep = contamination_report(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return rep.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


def op3_packing(spark: SparkSession, sf: str) -> DataFrame:
    return piece_digest(pack_documents(table(spark, sf, "documents")))


def op4_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = langid.fit(docs, id_hash(5) != 0)
    return (langid.identify(docs.select("doc_id", "text"), model)
            .select("doc_id", F.coalesce(id_hash(5) == 0, F.lit(False)).alias("held_out"), "language.*"))


def op5_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    lengths = encoded_lengths(table(spark, sf, "documents").select("text"))
    return length_histogram(lengths.select("n_tokens"))


def op6_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_duplicates(table(spark, sf, "documents"), keep="largest")


def op7_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return (judge_urls(table(spark, sf, "pages"))
            .select("page_id", "host", "path", "rule", "verdict",
                    (F.col("strict_hits") > 0).alias("strict"), "soft_terms"))


def op8_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = toxicity.fit(docs, table(spark, sf, "labels"), toxicity_training())
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", F.coalesce(id_hash(3) == 1, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op9_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = quality.fit(docs, table(spark, sf, "labels"), id_hash(5) != 0)
    return (quality.score(docs.select("doc_id", "text"), model)
            .select("doc_id", F.coalesce(id_hash(5) == 0, F.lit(False)).alias("held_out"), "score",
                    (F.col("score") >= 0.3).cast("int").alias("predicted")))


def op10_simhash(spark: SparkSession, sf: str) -> DataFrame:
    rep = near_duplicates(table(spark, sf, "documents"))
    return rep.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      "component_id")


def op11_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations(table(spark, sf, "documents"))


def op12_dialogue_repair(spark: SparkSession, sf: str) -> DataFrame:
    chats = table(spark, sf, "conversations")
    rows = dialogue_repair.faults(dialogue_repair.damaged(chats))
    counts = dialogue_repair.fault_counts(rows).withColumnRenamed("conv", "c1")
    texts = dialogue_repair.transcripts(dialogue_repair.repair(rows)).withColumnRenamed("conv", "c2")
    every = chats.select("conv_id").distinct()
    return (every.join(counts, every["conv_id"].eqNullSafe(counts["c1"]), "left")
            .join(texts, every["conv_id"].eqNullSafe(texts["c2"]), "left")
            .select("conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in (
                "gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                F.coalesce("audit", F.lit("")).alias("audit"),
                F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")))


def op13_token_files(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    write_token_files(table(spark, sf, "documents"), path)
    docs = checkpointed(read_token_files(spark, path)
                        .select("file_no", F.col("id").alias("doc_id"), "file_start", "n_tokens",
                                F.crc32("ids").alias("ids_crc32")))
    return (docs.join(file_starts(docs), "file_no")
            .select("doc_id", (F.col("base") + F.col("file_start")).alias("start"), "n_tokens", "ids_crc32"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_chat_perspectives, op2_decontaminate, op3_packing, op4_language_id, op5_token_counts,
    op6_exact_dedup, op7_url_filter, op8_toxicity, op9_quality, op10_simhash, op11_collocations,
    op12_dialogue_repair, op13_token_files)}

_LOWER_AZ = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"



def _term_list(terms) -> str:
    """The terms a url has between boundaries, as a DuckDB list expression."""
    quoted = ", ".join(f"'{t}'" for t in terms)
    return ("list_filter([" + quoted + "], lambda x: regexp_matches(t, '(^|[^\\p{L}\\p{N}])' || x "
            "|| '($|[^\\p{L}\\p{N}])'))")


_SOFT_WEIGHTS = "MAP {" + ", ".join(f"'{t}': {w}" for t, w in SOFT.items()) + "}"

ORACLE_SQL: dict[str, str] = {
    "op1_chat_perspectives": """
        WITH o AS (SELECT DISTINCT conv_id, turn, coalesce(nullif(role, ''), 'unknown') AS who,
                          coalesce(text, '') AS text
                   FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
        m AS (SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY turn, who, text) - 1) // 256 AS part FROM o),
        s AS (SELECT DISTINCT conv_id, who AS perspective FROM m WHERE who <> 'system'),
        p AS (SELECT *, CASE WHEN who = 'system' THEN '<|system|>'
                             WHEN who = perspective THEN '<|assistant|>'
                             ELSE '<|user:' || who || '|>' END || chr(10) AS head,
                     text || '<|end|>' || chr(10) AS body
              FROM m JOIN s USING (conv_id)),
        q AS (SELECT *, sum(length(head) + length(body)) OVER (
                        PARTITION BY conv_id, perspective, part ORDER BY turn, who, text) AS stop FROM p)
        SELECT conv_id, perspective, part, count(*) AS n_messages,
               count(*) FILTER (WHERE who = perspective) AS n_trained,
               string_agg(head || body, '' ORDER BY turn, who, text) AS rendered,
               coalesce(string_agg((stop - length(body))::BIGINT || '-' || stop::BIGINT, ','
                        ORDER BY turn, who, text) FILTER (WHERE who = perspective), '') AS mask
        FROM q GROUP BY conv_id, perspective, part""",
    "op7_url_filter": f"""
        WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                          regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
                          lower(coalesce(url, '')) AS t
                   FROM pages),
        t AS (SELECT *,
                     CASE WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com')
                               AND starts_with(path, '/en/') THEN 'www.example.com/en/'
                          WHEN (host = 'example.com' OR host LIKE '%.example.com')
                               AND starts_with(path, '/en/') THEN 'example.com/en/'
                          WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
                          WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
                          WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/'
                     END AS rule FROM u),
        h AS (SELECT *, {_term_list(STRICT)} AS strict, {_term_list(SOFT)} AS soft FROM t),
        c AS (SELECT *, list_sum([0.0] || list_transform(soft, lambda x: ({_SOFT_WEIGHTS})[x])) AS weight
              FROM h)
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
                    WHEN rule IS NOT NULL THEN 'block'
                    WHEN len(strict) > 0 OR (len(soft) >= 2 AND weight >= 2.0) THEN 'block'
                    ELSE 'allow' END AS verdict,
               len(strict) > 0 AS strict, CAST(len(soft) AS BIGINT) AS soft_terms
        FROM c""",
    "op2_decontaminate": f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                          regexp_extract_all({_LOWER_AZ}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
                   FROM documents),
        i AS (SELECT CAST(item_id AS VARCHAR) AS item,
                     regexp_extract_all({_LOWER_AZ}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
              FROM benchmark),
        win AS (SELECT DISTINCT item, least(len(w), 10) AS n,
                       array_to_string(w[p:p + least(len(w), 10) - 1], ' ') AS g
                FROM (SELECT *, unnest(range(1, greatest(len(w) - 8, 2))) AS p FROM i WHERE len(w) > 0)),
        sizes AS (SELECT DISTINCT n FROM win),
        grams AS (SELECT r, n, p, array_to_string(w[p:p + n - 1], ' ') AS g
                  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, sizes)),
        hits AS (SELECT r, item, p, n FROM grams JOIN win USING (n, g)),
        words AS (SELECT r, count(DISTINCT q) AS n_hit
                  FROM (SELECT r, unnest(range(p, p + n)) AS q FROM hits) GROUP BY r),
        found AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
                  FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN words USING (r) LEFT JOIN found USING (r)""",
    "op6_exact_dedup": f"""
        WITH d AS (SELECT doc_id, {_LOWER_AZ} AS t FROM documents),
        c AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept,
               sha256(t) AS text_sha256
        FROM d JOIN c USING (t)""",
    "op11_collocations": f"""
        WITH p AS (SELECT coalesce(lang, 'und') AS lang,
                          unnest(regexp_split_to_array({_LOWER_AZ}, '[.,;:!?\\x0A-\\x0D]')) AS piece
                   FROM documents),
        w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p),
        g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
              FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
                    FROM w, (VALUES (1), (2), (3), (4), (5)) AS sizes(k))),
        f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
        t AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
        c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 100),
        inside AS (SELECT lang, phrase, max(a) AS longer
                   FROM (SELECT lang, a, array_to_string(w[i:i + j - 1], ' ') AS phrase
                         FROM (SELECT *, unnest(range(1, k - j + 2)) AS i
                               FROM (SELECT *, unnest(range(2, k)) AS j FROM c)))
                   GROUP BY ALL),
        cuts AS (SELECT lang, phrase, a, j, array_to_string(w[:j], ' ') AS head, array_to_string(w[j + 1:], ' ') AS rest
                 FROM (SELECT *, unnest(range(1, k)) AS j FROM c)),
        scored AS (SELECT cuts.*, x.f AS l, y.f AS r, n,
                          ((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
                   FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = head
                   JOIN f y ON y.lang = cuts.lang AND y.phrase = rest JOIN t ON t.lang = cuts.lang),
        best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
        ranked AS (SELECT best.*, row_number() OVER (PARTITION BY best.lang
                                                     ORDER BY score DESC, a DESC, best.phrase) AS rank
                   FROM best LEFT JOIN inside ON inside.lang = best.lang AND inside.phrase = best.phrase
                   WHERE longer IS NULL OR 100 * longer < 100 * a)
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000""",
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)
