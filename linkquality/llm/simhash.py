"""SimHash near-duplicates by tiled exact comparison.

Fingerprints are 64 bits.  Two fingerprints within ``radius`` bits have
population counts that differ by ``radius`` at most, and so have their four
16-bit quarters, summed over the quarters.  Distinct fingerprints are put into
cells by the counts of their quarters, cells are cut into tiles of bounded
size, and only tile pairs whose counts allow a link are compared, each pair
exhaustively with numpy exclusive-or and bit counts.  No pair within the
radius is lost, no bucket is capped, and a crowded cell only has more tiles.

A tile pair gives at most one link per fingerprint (a spanning forest of its
links), so a group of near copies never becomes all its pairs.  Links between
distinct fingerprints are then reduced to components by repeated joins, every
round written to the checkpoint folder.
"""

from __future__ import annotations

import itertools
import re

from pyspark.sql import DataFrame, functions as F

from .common import checkpointed, utf8_slices

QUARTERS = 4
TILE = 2048
BLOCK_BYTES = 1 << 20
SPACE = re.compile(rb"[\x09-\x0d\x20]")


# ------------------------------------------------------------- fingerprints

def _set_bits(hashes):
    """How many of the hashes have each bit, bit 0 first."""
    import numpy as np
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def fingerprint(raw: bytes | None, shingle: int = 3) -> int:
    """Majority bits of the XXH64 (seed 42) of the word shingles of a UTF-8
    text, A-Z lower-cased, words cut at ASCII white space.  Fewer words than
    a shingle are one shingle; no words: zero."""
    import numpy as np
    from xxhash import xxh64_intdigest as xxh
    if not raw:
        return 0
    total, ones, carry = 0, np.zeros(64, np.int64), []
    at, end = 0, len(raw)
    while at < end:
        cut = SPACE.search(raw, at + BLOCK_BYTES)
        stop = cut.start() if cut else end
        words = carry + raw[at:stop].lower().split()
        at = stop
        if len(words) >= shingle:
            text = b" ".join(words)
            ends = list(itertools.accumulate([len(w) + 1 for w in words]))
            starts = [0, *ends]
            hashes = np.fromiter((xxh(text[a:b - 1], 42) for a, b in zip(starts, ends[shingle - 1:])),
                                 np.uint64, len(words) - shingle + 1)
            total += len(hashes)
            ones += _set_bits(hashes)
            words = words[len(words) - shingle + 1:]
        carry = words
    if not total:
        return xxh(b" ".join(carry), 42) if carry else 0
    return sum(1 << b for b in np.flatnonzero(2 * ones > total).tolist())


def fingerprints(df: DataFrame, text_col: str = "text", shingle: int = 3,
                 out: str = "fp") -> DataFrame:
    """``df`` with the fingerprint of every whole text as a signed long."""

    def prints(texts):
        import numpy as np
        import pyarrow as pa
        got = [fingerprint(raw, shingle) for part in utf8_slices(texts) for raw in part]
        return pa.array(np.asarray(got, np.uint64).view(np.int64), pa.int64())

    return df.withColumn(out, F.arrow_udf(prints, "long")(F.col(text_col).cast("string")))


# ------------------------------------------------------------ tile compare

def _quarter_counts(fp):
    """The population counts of the quarters of a fingerprint column."""
    return [F.bit_count(F.shiftrightunsigned(fp, 16 * q).bitwiseAND(F.lit(0xFFFF)))
            for q in range(QUARTERS)]


def _cell(counts):
    """One integer for a vector of counts (each below 32)."""
    return sum((c.cast("int") * F.lit(32 ** q) for q, c in enumerate(counts)), F.lit(0))


def _neighbours(radius: int) -> list[list[int]]:
    """Count differences within the radius, each of +d and -d once."""
    steps = [d for d in itertools.product(range(-radius, radius + 1), repeat=QUARTERS)
             if sum(map(abs, d)) <= radius]
    return [list(d) for d in steps if d >= (0,) * QUARTERS]


def forest(left, right, same: bool, radius: int):
    """A spanning forest, as (a, b) arrays, of the links between two numpy
    arrays of distinct fingerprints, by exhaustive comparison: every linked
    fingerprint with the first of its component."""
    import numpy as np
    rows = max(1, (1 << 18) // max(1, len(right)))
    found = []
    for at in range(0, len(left), rows):
        near = np.bitwise_count(left[at:at + rows, None] ^ right[None, :]) <= radius
        i, j = np.nonzero(near)
        if same:
            ahead = i + at < j
            i, j = i[ahead], j[ahead]
        if len(i):
            found.append((i + at, j))
    if not found:
        return left[:0], left[:0]
    i = np.concatenate([f[0] for f in found])
    j = np.concatenate([f[1] for f in found]) + (0 if same else len(left))
    label = np.arange(len(left) + (0 if same else len(right)))
    while True:                        # the smallest position of each component
        least = np.minimum(label[i], label[j])
        old = label.copy()
        np.minimum.at(label, i, least)
        np.minimum.at(label, j, least)
        label = label[label]
        if (label == old).all():
            break
    i = np.flatnonzero(label != np.arange(len(label)))
    j = label[i]
    both = left if same else np.concatenate([left, right])
    return both[i], both[j]


def near_links(prints: DataFrame, radius: int = 2, tile: int = TILE) -> DataFrame:
    """Links (a, b) that connect exactly the distinct fingerprints (column
    ``fp``, signed long) which chains of distances up to ``radius`` connect."""
    cells = prints.select("fp", _cell(_quarter_counts(F.col("fp"))).alias("cell"))
    # at most 17**4 cells exist, whatever the input: a bound for the broadcast
    sizes = cells.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(tile)).cast("int").alias("tiles"))
    tiles = checkpointed(
        cells.join(F.broadcast(sizes), "cell")
        .groupBy("cell", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int").alias("tile"))
        .agg(F.sort_array(F.collect_list("fp")).alias("fps")))
    steps = F.array(*[F.array(*map(F.lit, d)) for d in _neighbours(radius)])
    counts = [F.shiftright("cell", 5 * q).bitwiseAND(F.lit(31)) for q in range(QUARTERS)]
    wanted = (tiles.select("cell", "tile", "fps", F.explode(steps).alias("d"))
              .select(F.col("cell").alias("c1"), F.col("tile").alias("t1"),
                      F.col("fps").alias("left"),
                      *[(c + F.col("d")[q]).alias(f"q{q}") for q, c in enumerate(counts)])
              .where(" AND ".join(f"q{q} BETWEEN 0 AND 16" for q in range(QUARTERS)))
              .withColumn("cell", _cell([F.col(f"q{q}") for q in range(QUARTERS)])))
    pairs = (wanted.join(tiles.withColumnRenamed("fps", "right"), "cell")
             .where("c1 <> cell OR t1 <= tile")
             .select("left", "right", ((F.col("c1") == F.col("cell"))
                                       & (F.col("t1") == F.col("tile"))).alias("same")))

    def compare(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            a, b = [], []
            left, right = batch.column("left"), batch.column("right")
            same = batch.column("same").to_pylist()
            for n in range(batch.num_rows):
                x, y = forest(left[n].values.to_numpy().view(np.uint64),
                              right[n].values.to_numpy().view(np.uint64), same[n], radius)
                if len(x):
                    a.append(x)
                    b.append(y)
            if a:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(z).view(np.int64), pa.int64()) for z in (a, b)],
                    names=["a", "b"])

    return pairs.mapInArrow(compare, "a long, b long")


# -------------------------------------------------------------- components

def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node of every node's component.

    Alternating star contraction: first every node hangs its larger
    neighbours under its smallest neighbour, then its smaller ones, until
    nothing changes.  Each round is two aggregations and joins over links,
    written to the checkpoint folder; hubs are aggregated, never collected.
    """
    edges = checkpointed(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                         .where("u <> v").distinct())
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: the larger neighbours of u join u's smallest
        large = (both.where("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # small star: the smaller neighbours of u, and u, join u's smallest
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.withColumnRenamed("m", "v")).distinct())
        edges = checkpointed(small)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    radius: int = 2, shingle: int = 3, tile: int = TILE) -> DataFrame:
    """One row per input row: id, fp (signed long), component_id.

    ``component_id`` is the smallest id reachable over links, the row's own
    included; rows of one fingerprint are always linked.  Null, empty and
    blank texts have the fingerprint zero and are linked like any other; null
    ids are ignored when the smallest is taken; a repeated row is reported as
    often as it occurs; an empty table gives an empty report; other columns
    are not read.
    """
    return (_classified(df, id_col, text_col, radius, shingle, tile)
            .select(F.col("id").alias(id_col), "fp", "component_id"))


def _classified(df, id_col, text_col, radius, shingle, tile) -> DataFrame:
    """id, text_hash, fp, component_id of every row."""
    rows = checkpointed(fingerprints(df.select(F.col(id_col).alias("id"),
                                               F.col(text_col).alias("text")), "text", shingle)
                        .select("id", F.xxhash64("text").alias("text_hash"), "fp"))
    distinct = checkpointed(rows.groupBy("fp").agg(F.min("id").alias("least")))
    linked = components(near_links(distinct.select("fp"), radius, tile))
    member = (distinct.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
              .select("fp", F.coalesce("root", "fp").alias("root"), "least"))
    least = member.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = member.join(least, "root").select("fp", "component_id")
    return rows.join(checkpointed(classes), "fp")


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         radius: int = 2, shingle: int = 3, tile: int = TILE) -> DataFrame:
    """The rows that stay, input columns kept: of every component the row with
    the smallest id.  Rows without an id stay (no other row can be preferred
    to them by id); rows that share both id and text stay or go together."""
    gone = (_classified(df, id_col, text_col, radius, shingle, tile)
            .where("id <> component_id").select("id", "text_hash").distinct())
    return df.join(gone, (df[id_col] == gone["id"])
                   & (F.xxhash64(df[text_col]) == gone["text_hash"]), "left_anti")
