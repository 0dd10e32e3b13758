"""Phrase collocations by Toivonen mining.

A sample of the documents, counted whole at a threshold lowered in proportion
(and a half above it: a phrase proposed in vain costs more than one that the
border catches), proposes the phrases.  One pass over all documents then counts exactly the proposed phrases
and their negative border: every phrase that occurs and whose first and last
words-but-one are both proposed.  A border phrase that turns out frequent is a
failure of the sample; an expansion pass then counts what such phrases extend
to, through all lengths, so that the border is closed behind it.  The outcome
doesn't depend on the sample, only the work does.

Which phrases are proposed is told to the tasks as a bitmap of phrase hashes
of at most ``2 ** BITS`` bits.  A false positive only has a phrase counted
that needed no counting: counts are kept by the words themselves.  With more
proposed phrases than the bitmap can tell apart more rows are shuffled; no
result changes.  Tasks count in chunks of bounded size, and the counts of a
phrase are added up map-side before they are shuffled.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from .common import blocks, checkpointed, utf8_slices

BITS = 27                       # 16 MB, the largest bitmap that is broadcast
CHUNK = 4 << 20                 # bytes of text counted at a time
BLOCK_BYTES = 1 << 20
SALTS = 64                      # parts of a language where its total is joined
MARK = b"\xff"                  # between pieces; no UTF-8 text holds this byte
CUT = re.compile(rb"[\x09-\x0d .,;:!?]")
TABLE = bytes(32 if c == 9 else 255 if c in b".,;:!?\x0a\x0b\x0c\x0d" else c + 32 if 65 <= c <= 90 else c
              for c in range(256))
COUNTS = "key string, f long"     # key: language, line feed, phrase (which holds none)


# ------------------------------------------------------------ words, hashes

def marked_text(raw: bytes) -> bytes:
    """A UTF-8 text with A-Z lower-cased, tabs as blanks and ``MARK`` as a
    word between pieces."""
    return raw.translate(TABLE).replace(MARK, b" \xff ")


def words_of(data: bytes):
    """The words of ``marked_text``: their Arrow dictionary and their numbers
    in it (numpy)."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    words = pc.split_pattern(pa.array([data], pa.binary()), pattern=b" ").flatten()
    words = words.filter(pc.greater(pc.binary_length(words), 0)).dictionary_encode()
    return words.dictionary, words.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _extend(h, word):
    """Hashes of phrases one word longer (numpy uint64, wrapping)."""
    import numpy as np
    h = (h ^ word) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    return h * np.uint64(0xBF58476D1CE4E5B9)


def _seed(lang: str):
    import numpy as np
    from xxhash import xxh64_intdigest
    return np.uint64(xxh64_intdigest(lang.encode()))


def _probes(h, bits: int):
    import numpy as np
    yield h >> np.uint64(64 - bits)
    yield (h * np.uint64(0x94D049BB133111EB)) >> np.uint64(64 - bits)


def _marked(bitmap, bits: int, h):
    """Which hashes the bitmap may hold."""
    import numpy as np
    found = np.ones(len(h), bool)
    for at in _probes(h, bits):
        found &= (bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1) != 0
    return found


# ----------------------------------------------------------------- counting

def count_chunk(names, word, lang: str, longest: int, starts: int, known, failed, bits: int):
    """(phrases, counts), as Arrow and numpy arrays, of the phrases that begin
    at the first ``starts`` words; ``names`` and ``word`` as of ``words_of``.
    The empty phrase has the number of all words.

    ``known`` is the bitmap of proposed phrases (None: every phrase counts as
    proposed).  With the bitmap ``failed`` only phrases longer than a failed
    one inside them are counted, and those count as proposed in turn."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    from xxhash import xxh64_intdigest
    size, mark = len(word), pc.index(names, MARK).as_py()
    hashes = np.fromiter(map(xxh64_intdigest, names.to_pylist()), np.uint64, len(names))[word]
    place = np.arange(size, dtype=np.int32)
    left = np.where(word == mark, place, np.int32(size))
    left = np.minimum.accumulate(left[::-1])[::-1] - place                 # words up to the next mark
    if failed is None:
        n = np.bincount(word[:starts], minlength=len(names))
        if mark >= 0:
            n[mark] = 0
        some = np.flatnonzero(n)
        if len(some):
            yield pa.array([b""], pa.binary()), n.sum(keepdims=True)
            yield names.take(pa.array(some)), n[some]
    h = _extend(np.full(size, _seed(lang)), hashes)
    good, bad = left >= 1, np.zeros(size, bool)         # proposed; failed or with a failed phrase inside
    label = word
    for k in range(1, longest + 1):
        m = size - k + 1
        if m <= 0:
            return
        if k > 1:
            ok = (left[:m] >= k) & good[:m] & good[1:m + 1]
            inner = bad[:m] | bad[1:m + 1]
            wanted = ok if failed is None else ok & inner
            at = np.flatnonzero(ok)
            if not len(at):
                return
            # the label of a phrase of k - 1 words and the next word: no two phrases share them
            _, first, inverse = np.unique(label[at] << np.int64(32) | word[at + k - 1],
                                          return_index=True, return_inverse=True)
            n = np.bincount(inverse[wanted[at] & (at < starts)], minlength=len(first))
            some = np.flatnonzero(n)
            if len(some):
                where = at[first[some]]
                parts = [names.take(pa.array(word[where + j])) for j in range(k)]
                yield pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.binary())), n[some]
            label = np.zeros(m, np.int64)
            label[at] = inverse
            h = _extend(h[:m], hashes[k - 1:])
            good, bad = ok, ok & inner
        at = np.flatnonzero(good)
        if known is not None:
            good[at] = bad[at] | _marked(known, bits, h[at])
        if failed is not None:
            bad[at] |= _marked(failed, bits, h[at])


def count_phrases(df: DataFrame, longest: int, known=None, failed=None, bits: int = BITS,
                  chunk: int = CHUNK) -> DataFrame:
    """lang, words, phrase, f over all rows of ``df`` (lang, text); the row of
    no words and an empty phrase holds the language's number of words.

    ``known`` and ``failed`` are broadcast bitmaps, see ``count_chunk``."""

    def count(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        maps = [None if b is None else np.frombuffer(b.value, np.uint8) for b in (known, failed)]
        held, sizes = defaultdict(list), defaultdict(int)

        def flush(lang, last):
            names, word = words_of(b" ".join(held.pop(lang)))
            sizes.pop(lang)
            starts = len(word) if last else max(0, len(word) - longest + 1)
            for phrases, n in count_chunk(names, word, lang, longest, starts, *maps, bits):
                for at in range(0, len(n), 100_000):
                    part = phrases.slice(at, 100_000)
                    keys = pc.binary_join_element_wise(pa.scalar(lang.encode()), part, pa.scalar(b"\n"))
                    yield pa.RecordBatch.from_arrays(
                        [keys.cast(pa.string()), pa.array(n[at:at + 100_000], pa.int64())], names=["key", "f"])
            if not last:
                held[lang] = [names[i].as_py() for i in word[starts:].tolist()]
                sizes[lang] = sum(map(len, held[lang]))

        for batch in batches:
            langs, row = batch.column("lang").to_pylist(), 0
            for part in utf8_slices(batch.column("text")):
                for raw in part:
                    lang, row = langs[row], row + 1
                    for block in blocks(raw or b"", BLOCK_BYTES, CUT):
                        held[lang].append(marked_text(block))
                        sizes[lang] += len(held[lang][-1])
                        if sizes[lang] >= chunk:
                            yield from flush(lang, False)
                    held[lang].append(MARK)
                    sizes[lang] += 64
                    if sum(sizes.values()) >= 2 * chunk:             # many languages at once
                        for some in list(held):
                            yield from flush(some, True)
        for lang in list(held):
            yield from flush(lang, True)

    phrase = F.substring_index("key", "\n", -1)
    lang = F.left("key", F.length("key") - F.length("phrase") - 1)
    words = F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " ", -1)))
    return (df.mapInArrow(count, COUNTS).groupBy("key").agg(F.sum("f").alias("f"))
            .withColumn("phrase", phrase).select(lang.alias("lang"), words.alias("words"), "phrase", "f"))


# ------------------------------------------------------------------ bitmaps

def phrase_bitmap(phrases: DataFrame, bits: int):
    """Broadcast bitmap, ``2 ** bits`` bits, of the hashes of (lang, phrase)."""

    def places(batches):
        import numpy as np
        import pyarrow as pa
        from xxhash import xxh64_intdigest
        for batch in batches:
            by_size = defaultdict(list)
            for lang, phrase in zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist()):
                words = phrase.encode().split(b" ")
                by_size[len(words)].append((_seed(lang), [xxh64_intdigest(w) for w in words]))
            for rows in by_size.values():
                h = np.asarray([r[0] for r in rows], np.uint64)
                for column in np.asarray([r[1] for r in rows], np.uint64).T:
                    h = _extend(h, column)
                at = np.concatenate(list(_probes(h, bits))).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(at + 1, pa.int64())], names=["place"])

    parts = (phrases.select("lang", "phrase").mapInArrow(places, "place long")
             .groupBy(F.bitmap_bucket_number("place").alias("part"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")).collect())
    whole = bytearray(1 << (bits - 3))          # at most 16 MB, whatever the input
    for r in parts:
        at = (r["part"] - 1) * 4096
        whole[at:at + 4096] = r["bits"][:len(whole) - at]
    return phrases.sparkSession.sparkContext.broadcast(bytes(whole))


def _bits_for(n: int) -> int:
    return min(BITS, max(18, (16 * n).bit_length()))


# ------------------------------------------------------------------- mining

@dataclass
class Mined:
    frequent: DataFrame          # lang, words, phrase, f: every phrase with f >= support
    totals: DataFrame            # lang, n: number of words
    passes: int                  # passes over all documents


def mine(df: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = 5,
         support: int = 100, sample_fraction: float = 1 / 64, seed: int = 7, chunk: int = CHUNK) -> Mined:
    """All phrases of up to ``longest`` words that occur ``support`` times in
    their language, with exact counts.

    Null texts have no words; a null language is ``und``; a repeated row
    counts as often as it occurs; texts of any length are read in blocks of
    1 MiB; an empty table has no phrases; other columns are not read."""
    rows = df.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                     F.col(text_col).cast("string").alias("text"))
    low = max(1, math.ceil(1.5 * support * sample_fraction))
    key = ["lang", "phrase"]
    known = checkpointed(count_phrases(rows.sample(sample_fraction, seed), longest, chunk=chunk)
                         .where((F.col("f") >= low) & (F.col("phrase") != "")).select(*key))
    bits = _bits_for(known.count())
    counts = checkpointed(count_phrases(rows, longest, phrase_bitmap(known, bits), None, bits, chunk)
                          .where((F.col("f") >= support) | (F.col("phrase") == "")))
    frequent, passes = counts.where("words > 0"), 1
    # every frequent phrase not counted yet has a failed one inside, and all its parts between are
    # frequent and so proposed or counted on the way
    failed = checkpointed(frequent.select(*key).join(known, key, "left_anti"))
    if not failed.isEmpty():
        bits = _bits_for(known.count() + failed.count())
        fresh = checkpointed(
            count_phrases(rows, longest, phrase_bitmap(known.unionByName(failed), bits),
                          phrase_bitmap(failed, bits), bits, chunk)
            .where(F.col("f") >= support).join(frequent.select(*key), key, "left_anti")
            .select("lang", "words", "phrase", "f"))
        frequent, passes = frequent.unionByName(fresh), 2
    totals = counts.where("words = 0").select("lang", F.col("f").alias("n"))
    return Mined(frequent, totals, passes)


def _wide(name: str):
    return F.col(name).cast("decimal(20,0)")


def score_cuts(mined: Mined, share: int = 100) -> DataFrame:
    """lang, phrase, a, l, r, n, score of the candidates that stay.

    A candidate is a frequent phrase of two words or more, scored at its
    lowest cut by floor(1000 a n / (l r)) in 38-digit decimals (ties: the
    earliest cut).  One that lies inside a longer candidate with at least
    ``share`` per cent of its count goes; counts can't grow with length, so
    the longer ones by one word decide."""
    f = mined.frequent
    found = f.where("words > 1").select("lang", "words", "phrase", F.col("f").alias("a"))
    word = F.split("phrase", " ", -1)

    def part(at, size):
        return F.array_join(F.slice(F.col("w"), at, size), " ")

    cuts = (found.select("*", word.alias("w"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
            .select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("first"),
                    part(F.col("k") + 1, F.col("words") - F.col("k")).alias("rest")))
    value = (F.lit(1000).cast("decimal(4,0)") * _wide("a") * _wide("n"))
    best = (cuts.join(f.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
            .join(f.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
            .withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int"))
            .join(mined.totals.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
                                      .alias("salt")), ["lang", "salt"])
            .withColumn("over", value.cast("decimal(38,0)"))
            .withColumn("under", (_wide("l") * _wide("r")).cast("decimal(38,0)"))
            .withColumn("score", F.expr("over div under"))
            .groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")))
    longer = (found.where("words > 2").select("lang", "a", word.alias("w"), "words")
              .select("lang", "a", F.explode(F.array(part(F.lit(1), F.col("words") - 1),
                                                     part(F.lit(2), F.col("words") - 1))).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    return (best.join(longer, ["lang", "phrase"], "left")
            .where(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a")))
            .select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"))


def collocations(df: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = 5,
                 support: int = 100, share: int = 100, top: int = 2000, **kw) -> DataFrame:
    """Each language's first ``top`` collocations: lang, rank, phrase, a, l,
    r, n, score, by score and count descending, then phrase in byte order.
    For rows, see ``mine``; the top-k is the report's own limit and is taken
    within partitions before any shuffle."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (score_cuts(mine(df, text_col, lang_col, longest, support, **kw), share)
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
