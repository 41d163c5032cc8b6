"""SimHash near-deduplication with pigeonhole blocks.

Every text gets a 64-bit fingerprint: a bit is set where it is set in over half
of the XXH64 hashes of its word shingles.  Texts whose fingerprints differ in at
most ``distance`` bits are linked; connected texts form a group.

Fingerprints are cut into ``distance + 2`` blocks.  Two that differ in at most
``distance`` bits agree on at least two blocks, so joining on every pair of
blocks (keys of 32 bits for a distance of 2) meets all of them; the join
condition verifies the Hamming distance.  Only distinct fingerprints are joined,
so a group of equal texts costs one row.

A key that more than ``HOT_KEY`` distinct fingerprints share is not joined: its
members are linked exactly through their one-bit neighbours instead (two
fingerprints differ in at most two bits if and only if some value is at most one
bit away from both): 65 rows for each, and 65 members of a neighbour at most.
For other distances the neighbours are those half the distance away.

Groups are the connected components of the links, found by alternating
large-star and small-star steps on the links between distinct fingerprints.

Defined cases: null and empty texts have fingerprint zero and are linked like
others; texts with fewer words than a shingle hash their whole word sequence; a
null id belongs to a group but never names it unless no member has an id;
repeated rows get the same group; an empty table gives an empty result; extra
columns are ignored by the decision.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from surveil.llm.common import stage
from surveil.llm.words import word_slices

SHINGLE = 3
DISTANCE = 2
SEED = 42
HOT_KEY = 64
#: Shingles that are hashed at a time.
PART = 1 << 15


def _bit_counts(words: list[bytes], shingle: int) -> tuple[np.ndarray, int]:
    """How many shingles of these words have each bit set, and how many there are."""
    counts, total = np.zeros(64, dtype=np.int64), max(len(words) - shingle + 1, 0)
    for i in range(0, total, PART):
        part = words[i:i + PART + shingle - 1]
        joined = b" ".join(part)
        sizes = np.fromiter(map(len, part), dtype=np.int64, count=len(part))
        ends = np.cumsum(sizes + 1) - 1
        starts = (ends - sizes)[:len(part) - shingle + 1].tolist()
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:].tolist())], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return counts, total


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned fingerprint of a text."""
    counts, total, before = np.zeros(64, dtype=np.int64), 0, []
    for words in word_slices(text):
        words = before + words
        got, n = _bit_counts(words, shingle)
        counts, total = counts + got, total + n
        before = words[-(shingle - 1):] if shingle > 1 else []
    if not total:
        if not before:
            return 0
        counts, total = _bit_counts([b" ".join(before)], 1)
    return int(np.packbits(counts * 2 > total, bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint as a signed long."""
    @pandas_udf("long")
    def signed(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).astype(np.int64))

    return signed(text)


def block_masks(distance: int) -> list[int]:
    """Bit masks (signed) of all pairs of the ``distance + 2`` blocks."""
    edges = [64 * i // (distance + 2) for i in range(distance + 3)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [m - (1 << 64) if m >> 63 else m for m in (x | y for x, y in combinations(blocks, 2))]


def links(distinct: DataFrame, distance: int = DISTANCE, hot_key: int = HOT_KEY) -> DataFrame:
    """Links (``a`` < ``b``) between distinct fingerprints ``fp``; every linked pair is connected by them."""
    masks = F.array(*[F.struct(F.lit(i).alias("block"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                      for i, m in enumerate(block_masks(distance))])
    keyed = distinct.select("fp", F.explode(masks).alias("k")).select("fp", "k.block", "k.key")
    sizes = stage(keyed.groupBy("block", "key").agg(F.count("*").alias("n")).filter("n > 1"), "simhash-keys")
    met = keyed.join(sizes.filter(F.col("n") <= hot_key).select("block", "key"), ["block", "key"])
    near = F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= distance
    pairs = met.alias("x").join(met.alias("y"), (F.col("x.block") == F.col("y.block")) & (F.col("x.key") == F.col("y.key"))
                                & (F.col("x.fp") < F.col("y.fp")) & near).select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))
    hot = keyed.join(sizes.filter(F.col("n") > hot_key).select("block", "key"), ["block", "key"]).select("fp").distinct()
    return pairs.unionByName(_hot_links(hot, distance)).distinct()


def _hot_links(hot: DataFrame, distance: int) -> DataFrame:
    """Links among the members of hot keys through the values at most ``ceil(distance / 2)`` bits away."""
    bits = [1 << i for i in range(64)]
    flips = [0] + [sum(c) for r in range(1, -(-distance // 2) + 1) for c in combinations(bits, r)]
    signed = F.array(*[F.lit(m - (1 << 64) if m >> 63 else m) for m in flips])
    around = hot.select("fp", F.explode(F.transform(signed, lambda m: F.col("fp").bitwiseXOR(m))).alias("value"))
    first = F.min("fp").over(Window.partitionBy("value"))
    stars = around.withColumn("a", first).filter(F.col("a") != F.col("fp"))
    if distance % 2:  # meeting half-way also joins pairs one bit further apart
        stars = stars.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("fp"))) <= distance)
    return stars.select("a", F.col("fp").alias("b"))


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (smallest node reachable) of every node of the undirected edges ``a``, ``b``."""
    now = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct(), "links")
    mark = _mark(now)
    while True:
        # large star: a node's larger neighbours go to its smallest neighbour
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: a node and its smaller neighbours go to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        now = stage(small.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                    .unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        before, mark = mark, _mark(now)
        if mark == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def near_duplicates(fingerprints: DataFrame, id_col: str = "doc_id", distance: int = DISTANCE) -> DataFrame:
    """``fingerprints`` (with ``fp``; read several times, so a table) with ``component_id`` and ``root`` (the group's smallest fingerprint)."""
    distinct = stage(fingerprints.groupBy("fp").agg(F.min(id_col).alias("first_id")), "simhash-distinct")
    linked = components(links(distinct.select("fp"), distance))
    rooted = distinct.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = stage(rooted, "simhash-rooted")
    names = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return fingerprints.join(rooted.join(names, "root").select("fp", "root", "component_id"), "fp")


def fingerprint_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
