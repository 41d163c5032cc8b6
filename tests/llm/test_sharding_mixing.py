import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fixtures import docs_frame
from surveil.llm import mixing, sharding


def test_matrix_has_the_given_margins_and_law():
    rows, columns = [5, 0, 17, 100, 3], [40, 40, 45]
    m = np.array(sharding.draw_matrix(rows, columns, [1]))
    assert m.sum(axis=1).tolist() == rows and m.sum(axis=0).tolist() == columns
    draws = [sharding.hypergeometric(np.random.default_rng([7, i]), 30, 70, 20) for i in range(4000)]
    chance = [math.comb(30, k) * math.comb(70, 20 - k) / math.comb(100, 20) for k in range(21)]
    seen = Counter(draws)
    assert sum((seen[k] - 4000 * p) ** 2 / (4000 * p) for k, p in enumerate(chance) if 4000 * p > 5) < 40
    big = sharding.hypergeometric(np.random.default_rng(1), 10**11, 10**12, 10**7)
    assert abs(big - 10**7 / 11) < 10**4


def test_binary_search_counts_the_sums_up_to_a_value(spark):
    sums = [0, 0, 3, 3, 8, 9]
    rows = spark.range(12).select(F.col("id"), sharding.places_upto(F.array(*[F.lit(v) for v in sums]), F.col("id"), len(sums)).alias("n")).collect()
    assert all(r["n"] == sum(v <= r["id"] for v in sums) for r in rows)


@pytest.mark.parametrize("n,shards", [(0, 4), (3, 8), (1000, 16), (1001, 7)])
def test_shards_are_exact_and_slots_gapless(spark, n, shards):
    rows = spark.range(n, numPartitions=5).select(F.col("id").alias("doc_id"), F.lit("x").alias("shard"))
    got = sharding.shard_rows(rows, shards).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(n))
    sizes = Counter(r["shard"] for r in got)
    assert all(sizes[s] in (n // shards, n // shards + 1) for s in range(shards)) and set(sizes) <= set(range(shards))
    for s in sizes:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sizes[s]))
    again = sharding.shard_rows(rows, shards).collect()
    assert Counter(r["shard"] for r in again) == sizes


def test_no_row_is_lost_when_the_staged_files_are_split_anew(spark):
    names = ["spark.sql.files.minPartitionNum", "spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes"]
    rows = spark.range(20_000, numPartitions=6).select(F.col("id").alias("doc_id"), F.repeat(F.md5(F.col("id").cast("string")), 4).alias("text"))
    seen = []
    for now, later in (("1", "64"), ("64", "1")):
        spark.conf.set(names[0], now)
        spark.conf.set(names[1], "1")
        got = sharding.shard_rows(rows, 16)
        spark.conf.set(names[0], later)
        spark.conf.set(names[2], "10000")
        try:
            found = got.select("doc_id", "shard", "slot").collect()
        finally:
            for name in names:
                spark.conf.unset(name)
        assert sorted(r["doc_id"] for r in found) == list(range(20_000))
        sizes = Counter(r["shard"] for r in found)
        assert sorted(sizes) == list(range(16)) and set(sizes.values()) == {1250}
        for s in range(16):
            assert sorted(r["slot"] for r in found if r["shard"] == s) == list(range(1250))
        seen.append({r["doc_id"]: (r["shard"], r["slot"]) for r in found})
    assert len(set(seen[0].values())) == 20_000


def test_the_shuffle_is_uniform(spark):
    rows = spark.range(4000, numPartitions=4).withColumnRenamed("id", "doc_id")
    got = sharding.shard_rows(rows, 4, seed=5).collect()
    # rows of one input quarter over shards, and over the halves of the slots
    for cell in (Counter((r["doc_id"] // 1000, r["shard"]) for r in got), Counter((r["doc_id"] // 1000, r["slot"] // 250) for r in got)):
        assert len(cell) == 16 and all(abs(c - 250) < 75 for c in cell.values())


def test_awkward_rows_keep_their_columns(spark):
    docs = docs_frame(spark, wide=True)
    got = sharding.shard_rows(docs, 3)
    assert set(got.columns) == set(docs.columns) and got.count() == docs.count()
    assert sorted(map(str, got.drop("shard", "slot").collect())) == sorted(map(str, docs.drop("shard", "slot").select(got.drop("shard", "slot").columns).collect()))


def brute_targets(sizes, epochs=3):
    """Share by weight, cap, share the excess again until nothing is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        rest = total - sum(epochs * sizes[s] for s in capped)
        target = {s: epochs * sizes[s] for s in capped} | {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if target[s] > epochs * sizes[s] * (1 + 1e-12)]
        if not over:
            return target
        capped |= set(over)


@pytest.mark.parametrize("seed", range(6))
def test_targets_and_taken_match_brute_force(spark, seed):
    rnd = random.Random(seed)
    names = [None, *(f"s{i}" for i in range(rnd.randint(1, 7)))]
    rows = [(i, rnd.choice(names) if rnd.random() < 0.6 else names[-1], rnd.choice([0, 1, 5, 40, 400])) for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, size long")
    key = -F.log(mixing.uniform("doc_id"))
    got = mixing.mix(frame, key, order_by=["doc_id"]).withColumn("k", key).collect()
    sizes = Counter()
    for _, s, n in rows:
        sizes[s] += n
    target = brute_targets(sizes)
    assert len(got) == len(rows)
    for s in sizes:
        own = sorted((r for r in got if r["source"] == s), key=lambda r: r["k"])
        assert all(abs(r["target"] - target[s]) < 1e-6 and r["source_size"] == sizes[s] for r in own)
        epochs = min(int(own[0]["target"] // sizes[s]), 3) if sizes[s] else 0
        budget, total = own[0]["target"] - epochs * sizes[s], 0
        for r in own:
            total += r["size"]
            assert r["taken"] == r["size"] * (epochs + (total - r["size"] / 2 <= budget and budget > 0))
        assert abs(sum(r["taken"] for r in own) - target[s]) <= 200 or sizes[s] == 0


def test_mixing_awkward_and_empty_tables(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1)], "doc_id long, quality int")
    docs = docs_frame(spark, wide=True)
    got = mixing.mix_documents(docs, labels)
    rows = got.collect()
    assert len(rows) == docs.count() and all(r["taken"] <= 3 * r["size"] for r in rows)
    assert sorted(map(str, mixing.mix_documents(docs, labels).collect())) == sorted(map(str, rows))
    assert mixing.mix_documents(docs_frame(spark, []), labels).count() == 0


def test_heavier_documents_are_taken_more_often(spark):
    rows = [(i, "a" if i % 2 else "b", 10) for i in range(4000)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, size long").withColumn("w", F.when(F.col("doc_id") % 4 < 2, 4.0).otherwise(1.0))
    got = mixing.mix(frame, -F.log(mixing.uniform("doc_id")) / F.col("w"), order_by=["doc_id"]).filter("source = 'a'").groupBy("w").agg(F.avg(F.col("taken") / 10).alias("t")).collect()
    share = {r["w"]: r["t"] for r in got}
    assert share[4.0] > share[1.0] + 0.2
