"""The pipeline against a brute-force version of every stage, each on its own input."""

import hashlib
import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from fixtures import awkward_docs, docs_frame
from surveil.llm import quality
from surveil.llm.queries import held_out
from test_classifiers import brute_score
from test_decontaminate import brute, brute_words
from test_sharding_mixing import brute_targets
from test_simhash import brute_components, brute_fingerprint

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def tables(spark):
    """The input and every stage's output."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {"documents": docs}
    for name, function in cp.STAGES:
        docs = function(spark, docs, SF)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        out[name] = docs
    return out


def test_stages_keep_the_columns_of_documents(tables):
    for name in ("quality", "simhash", "decontaminate", "mix"):
        assert tables[name].schema == tables["documents"].schema
        assert 0 < tables[name].count()
    assert tables["shard"].columns == [*tables["documents"].columns, "slot", "shard"]


def test_quality_stage(spark, tables):
    docs = tables["documents"]
    weights = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"), ~held_out(5, 0))
    want = [tuple(r) for r in docs.collect() if brute_score(r["text"], weights) >= quality.THRESHOLD]
    assert rows_of(tables["quality"]) == sorted(want, key=str)


def test_simhash_stage(tables):
    given = tables["quality"].collect()
    groups = {i: g for i, _, g in brute_components([(r["doc_id"], brute_fingerprint(r["text"])) for r in given])}
    assert rows_of(tables["simhash"]) == sorted((tuple(r) for r in given if groups[r["doc_id"]] == r["doc_id"]), key=str)


def test_decontamination_stage(spark, tables):
    items = [(str(r["item_id"]), brute_words(r["text"])) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    after = {r["doc_id"]: r for r in tables["decontaminate"].collect()}
    cut = 0
    for r in tables["simhash"].collect():
        words = brute_words(r["text"])
        hit, _ = brute(items, words, 10)
        if not hit:
            assert tuple(after.pop(r["doc_id"])) == tuple(r)
        elif len(hit) > len(words) / 2:
            assert r["doc_id"] not in after
        else:
            left = brute_words(after.pop(r["doc_id"])["text"])
            assert not brute(items, left, 10)[0] and len(left) <= len(words) - len(hit)
            cut += 1
    assert not after


def test_mixing_stage(spark, tables):
    given = tables["decontaminate"].collect()
    size = lambda r: len([w for w in re.split(r"[\x20\x09-\x0D]+", r["text"] or "") if w])
    sizes = Counter()
    for r in given:
        sizes[r["source"]] += size(r)
    target = brute_targets(sizes)
    labels = {}
    for r in spark.read.parquet(f"{SF}/labels.parquet").collect():
        labels[r["doc_id"]] = max(labels.get(r["doc_id"], 0), r["quality"])
    weight = {1: 2.0, 0: 0.5, None: 1.0}
    key = lambda r: -math.log((int(hashlib.md5(f"{r['doc_id']}:42".encode()).hexdigest()[:13], 16) + 0.5) / 2**52) / weight[labels.get(r["doc_id"])]
    want = Counter()
    for s in sizes:
        epochs = min(int(target[s] // sizes[s]), 3)
        total = 0
        for r in sorted((r for r in given if r["source"] == s), key=key):
            total += size(r)
            want[tuple(r)] += epochs + (total - size(r) / 2 <= target[s] - epochs * sizes[s] and target[s] > epochs * sizes[s])
    assert Counter(map(tuple, tables["mix"].collect())) == +want


def test_sharding_stage(tables):
    rows = tables["shard"].collect()
    assert sorted(str(tuple(r)[:5]) for r in rows) == sorted(str(tuple(r)) for r in tables["mix"].collect())
    sizes = Counter(r["shard"] for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and len(sizes) == 16
    for s in sizes:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sizes[s]))


@pytest.mark.parametrize("wide", [False, True])
def test_every_stage_takes_awkward_and_empty_tables(spark, wide):
    for name, function in cp.STAGES:
        docs = docs_frame(spark, wide=wide)
        got = function(spark, docs, SF)
        kept = got.count()
        assert 0 < kept <= 3 * docs.count(), name
        if name != "shard":
            assert got.schema == docs.schema
            assert {str(tuple(r)) for r in got.collect()} <= {str(tuple(r)) for r in docs.collect()}
        assert function(spark, docs_frame(spark, []), SF).count() == 0


def test_repeated_rows_leave_one_document_and_mix_apart(spark):
    docs = docs_frame(spark)
    kept = cp.simhash_stage(spark, docs, SF).select("doc_id").collect()
    ids = [r[0] for r in kept]
    assert ids.count(1) == 1 and 2 not in ids and 3 not in ids and ids.count(9) == 2  # one id, two texts, two groups
    assert all(ids.count(i) == 1 for i in ids if i != 9)
    empty = [r for r in awkward_docs() if not (r[1] or "").strip()]
    assert min(r[0] for r in empty if r[0] is not None) in ids  # null and empty texts are one group
    assert cp.mixing_stage(spark, docs, SF).filter(F.col("doc_id") == 2).count() <= 6
