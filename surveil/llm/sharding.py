"""Sharding by a hypergeometric communication matrix: a uniform shuffle with exact shard sizes.

1. Every partition permutes its rows locally (no shuffle) and numbers them; the
   numbered rows are staged as a table and counted by partition.
2. Each shard is cut into blocks of known, nearly equal size.  How many rows of
   partition ``p`` go to block ``b`` is drawn exactly from the multivariate
   hypergeometric law, so rows and columns of the matrix add up to the
   partitions' and the blocks' sizes.
3. Every row is dealt out by its number and its partition's row of the matrix.
4. One exchange brings a block's rows together, and each block permutes them
   again; a row's slot is the block's offset plus its place.

Every permutation of the rows is equally likely, shard sizes differ by one at
most, and no task holds more than a block.  The matrix is drawn in two levels:
the driver draws one row per group of partitions, tasks draw the partitions
inside a group, so neither holds all of it.

A task that runs again, on whatever split of the staged files, deals its rows as
before, for their numbers are in the table; another run may deal differently if
its input files come in another order.

Defined cases: null texts and ids are rows like others; repeated rows each get
their own slot; an empty table gives an empty result; extra columns are kept, but
for any named ``shard`` or ``slot``, which are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveil.llm.common import shuffle_partitions, stage

#: Rows of a block at most, whatever the number of shards.
BLOCK_ROWS = 2_000_000
#: Partitions whose rows of the matrix one task draws.
GROUP = 256
#: A matrix of so many bytes is broadcast; a larger one is joined by a shuffle on the partition.
BROADCAST_BYTES = 16 << 20


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` without replacement are good, by inversion around the mode.

    The window of 14 standard deviations leaves out a probability below 1e-40;
    populations of any size are fine (numpy's own sampler ends at 1e9).
    """
    total = good + bad
    low, high = max(0, draws - bad), min(draws, good)
    if low == high:
        return low
    mode = min(max((draws + 1) * (good + 1) // (total + 2), low), high)
    sd = math.sqrt(draws * (good / total) * (bad / total) * ((total - draws) / max(total - 1, 1)))
    low, high = max(low, mode - int(14 * sd) - 14), min(high, mode + int(14 * sd) + 14)
    k = np.arange(low, high, dtype=np.float64)
    ratio = np.log(good - k) + np.log(draws - k) - np.log(k + 1) - np.log(bad - draws + k + 1)
    weight = np.concatenate([[0.0], np.cumsum(ratio)])
    chance = np.cumsum(np.exp(weight - weight.max()))
    return low + int(np.searchsorted(chance, rng.random() * chance[-1], side="right").clip(0, len(chance) - 1))


def draw_matrix(row_sizes: list[int], column_sizes: list[int], seed: list[int]) -> list[list[int]]:
    """A matrix of counts with these row and column sums, drawn as a uniform dealing would."""
    rng = np.random.default_rng(seed)
    left, out = list(column_sizes), []
    for size in row_sizes:
        rest, need, row = sum(left), size, []
        for j, have in enumerate(left):
            got = hypergeometric(rng, have, rest - have, need) if need else 0
            row.append(got)
            rest -= have
            need -= got
            left[j] -= got
        out.append(row)
    return out


def block_sizes(n_rows: int, n_shards: int, n_blocks: int) -> list[tuple[int, int, int]]:
    """(shard, first slot, size) of each block; shard sizes differ by one at most."""
    out = []
    for s in range(n_shards):
        size = n_rows // n_shards + (s < n_rows % n_shards)
        edges = [size * i // n_blocks for i in range(n_blocks + 1)]
        out += [(s, a, b - a) for a, b in zip(edges, edges[1:])]
    return out


def places_upto(sums: Column, value: Column, n: int) -> Column:
    """How many of ``n`` ascending numbers are at most ``value``, by binary search."""
    def halve(at: Column, _: Column) -> Column:
        mid = F.floor((at["low"] + at["high"]) / 2).cast("int")
        more, less = F.get(sums, mid) <= value, F.get(sums, mid) > value
        return F.struct(F.when((at["low"] < at["high"]) & more, mid + 1).otherwise(at["low"]).alias("low"),
                        F.when((at["low"] < at["high"]) & less, mid).otherwise(at["high"]).alias("high"))

    start = F.struct(F.lit(0).alias("low"), F.lit(n).alias("high"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(max(n, 1).bit_length())), start, halve)["low"]


def shard_rows(rows: DataFrame, n_shards: int, seed: int = 42) -> DataFrame:
    """``rows`` with ``shard`` (0 to n_shards - 1) and ``slot`` (gapless from 0 within the shard)."""
    spark = rows.sparkSession
    # permuted locally and numbered before the table is written: later reads may split its files as they like
    local = rows.drop("shard", "slot").withColumn("__deal", F.rand(seed)).withColumn("__order", F.rand(seed + 1))
    local = local.sortWithinPartitions("__deal").withColumn("__place", F.monotonically_increasing_id()).drop("__deal")
    staged = stage(local, "shard-rows")
    # the number's upper bits are the partition, its lower 33 bits the row's place in it
    staged = staged.withColumn("__part", F.shiftright("__place", 33).cast("int")).withColumn(
        "__place", F.col("__place").bitwiseAND(F.lit((1 << 33) - 1)))
    sizes = sorted((r[0], r[1]) for r in staged.groupBy("__part").count().collect())
    total = sum(n for _, n in sizes)
    per_shard = max(-(-total // (n_shards * BLOCK_ROWS)), -(-shuffle_partitions(spark) // n_shards), 1)
    blocks = block_sizes(total, n_shards, per_shard)
    matrix = communication_matrix(spark, sizes, [b[2] for b in blocks], seed)
    if len(sizes) * len(blocks) * 8 <= BROADCAST_BYTES:
        matrix = F.broadcast(matrix)
    dealt = staged.join(matrix, "__part", "left").withColumn(
        "__upto", F.coalesce("__upto", F.raise_error(F.lit("a partition that was not counted")).cast("array<bigint>")))
    block = places_upto(F.col("__upto"), F.col("__place"), len(blocks))
    dealt = dealt.withColumn("__block", block).drop("__upto", "__part", "__place")
    rank = F.row_number().over(Window.partitionBy("__block").orderBy("__order"))
    size, extra = divmod(total, n_shards)
    shard = F.floor(F.col("__block") / per_shard).cast("int")
    shard_size = F.lit(size) + F.when(shard < extra, 1).otherwise(0)
    first = F.floor(shard_size * F.pmod(F.col("__block"), F.lit(per_shard)) / per_shard)
    return dealt.withColumn("slot", (first + rank - 1).cast("long")).withColumn("shard", shard).drop("__block", "__order")


def communication_matrix(spark, sizes: list[tuple[int, int]], columns: list[int], seed: int) -> DataFrame:
    """Per partition the running sums of its row of the matrix: ``__part``, ``__upto``."""
    groups = [sizes[i:i + GROUP] for i in range(0, len(sizes), GROUP)]
    drawn = draw_matrix([sum(n for _, n in g) for g in groups], columns, [seed, 0])
    given = [(i, [p for p, _ in g], [n for _, n in g], row) for i, (g, row) in enumerate(zip(groups, drawn))]

    def rows_of_group(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for i, parts, counts, row in pdf.itertuples(index=False, name=None):
                inner = draw_matrix([int(n) for n in counts], [int(n) for n in row], [seed, 1, int(i)])
                yield pd.DataFrame({"__part": list(parts), "__upto": [np.cumsum(r).tolist() for r in inner]})

    start = spark.createDataFrame(given, "g long, parts array<int>, counts array<long>, columns array<long>")
    return start.mapInPandas(rows_of_group, "__part int, __upto array<long>")
