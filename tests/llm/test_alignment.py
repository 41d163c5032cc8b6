import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from fixtures import DOC_SCHEMA, awkward_docs, docs_frame
from surveil.llm import alignment, perfect_hash
from surveil.llm.queries import A_VOCABULARY, B_VOCABULARY, QUERIES

A_PATH, B_PATH = public_tokenizers.path(A_VOCABULARY), public_tokenizers.path(B_VOCABULARY)


@pytest.fixture(scope="module")
def plain():
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    byte = alignment._byte_of_character()
    b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)

    def tokens(text):
        """Both token lists as (id, bytes), or two empty ones."""
        mine = a.encode(" " + (text or ""), add_special_tokens=False)
        left = [(i, bytes(byte[c] for c in t)) for i, t in zip(mine.ids, mine.tokens)]
        right = [(i, bytes([int(p[3:-1], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode())
                 for i in b.encode(text or "") for p in [b.id_to_piece(i)]]
        whole = (" " + (text or "")).encode()
        ok = text and all(b"".join(x for _, x in side) == whole for side in (left, right))
        return (left, right) if ok else ([], [])

    return tokens


def spans(tokens):
    out, at = [], 0
    for i, raw in tokens:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def brute(plain, rows):
    """The contract's rows, pair by pair of tokens."""
    docs = []
    for doc_id, text in rows:
        a, b = map(spans, plain(text))
        links = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]]
        ends = sorted({x[2] for x in a} & {y[2] for y in b})
        parts = []
        for low, high in zip([0] + ends, ends):
            parts.append("|".join(",".join(str(x[0]) for x in side if low < x[2] <= high) for side in (a, b)))
        docs.append((doc_id, a, b, links, ends, ";".join(parts)))
    counts = Counter(k for d in docs for k in d[3])
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    return [(i, len(a), len(b), len(ends), len(links), sum(counts[k] == best[k[1]] for k in links), sum(counts[k] for k in links),
             hashlib.sha256(g.encode()).hexdigest() if a else "") for i, a, b, links, ends, g in docs]


def rows_of(frame):
    return sorted(map(str, map(tuple, frame.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect())))


SMALL = [r for r in awkward_docs() if len(r[1] or "") < 2000] + [
    (50, "a ▁ symbol of its own", "en", "a", 0), (51, "<|endoftext|> and <s> are text", "en", "a", 0),
    (52, "Ünïcödé naïve 日本語 😀😀   \x00 tab\t\ttabs", "en", "a", 0)]


@pytest.mark.parametrize("wide", [False, True])
def test_query_rows_of_awkward_documents(spark, tmp_path, plain, wide):
    docs_frame(spark, SMALL, wide=wide).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op11_align_tokenizers"](spark, str(tmp_path))
    assert rows_of(got) == sorted(map(str, brute(plain, [r[:2] for r in SMALL])))


def test_more_pairs_than_a_block_give_the_same_rows(spark, monkeypatch, plain):
    from pyspark.sql import functions as F
    monkeypatch.setattr(alignment, "BUCKET_KEYS", 16)
    found, pairs = alignment.align(docs_frame(spark, SMALL).repartition(3), A_PATH, B_PATH, block_keys=64)
    assert pairs.count() > 3 * 64
    got = found.withColumn("groups_sha256", F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise(""))
    assert rows_of(got) == sorted(map(str, brute(plain, [r[:2] for r in SMALL])))


def test_pairs_are_the_corpus_wide_counts(spark, plain):
    _, pairs = alignment.align(docs_frame(spark, SMALL), A_PATH, B_PATH)
    counts = Counter()
    for r in SMALL:
        a, b = map(spans, plain(r[1]))
        counts.update((x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2])
    assert {(r["a"], r["b"]): r["n"] for r in pairs.collect()} == dict(counts)


def test_long_texts_and_the_empty_table(spark, tmp_path):
    docs_frame(spark).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r["doc_id"]: r for r in QUERIES["op11_align_tokenizers"](spark, str(tmp_path)).collect()}
    assert rows[14]["n_a"] > 1000 and rows[14]["n_links"] >= rows[14]["n_groups"] > 0
    spark.createDataFrame([], DOC_SCHEMA).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert QUERIES["op11_align_tokenizers"](spark, f"{tmp_path}/none").collect() == []


def test_both_ways_to_encode_agree_where_the_fast_one_is_used():
    with open(A_PATH, encoding="utf-8") as f:
        a = alignment.ByteLevel(f.read())
    assert a.fast is not None
    rnd = random.Random(8)
    known = [chr(i) for i in range(0x2400) if not alignment._UNSTABLE.search(chr(i))]
    texts = ["".join(rnd.choice(known) for _ in range(rnd.randint(0, 40))) for _ in range(3000)]
    texts += [c + "a" + c * 2 + " 1" for c in known] + ["it's we'll   x \n\n y", " <|endoftext|> "]
    slow = [e.ids for e in a.whole.encode_batch_fast(texts, add_special_tokens=False)]
    assert a.encode(texts) == slow
    other = ["ابجد 日本 " + t for t in texts[:50]]
    assert a.encode(other) == [e.ids for e in a.whole.encode_batch_fast(other, add_special_tokens=False)]


def test_perfect_hash_is_minimal_and_verifies_keys():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 1 << 47, 50_000))
    n = 7
    buckets = perfect_hash.bucket_of(keys, n)
    built = [perfect_hash.build(keys[buckets == k]) for k in range(n)]
    whole = perfect_hash.PerfectHash(n, 0, *map(list, zip(*built)))
    index = whole.index(keys)
    assert sorted(index.tolist()) == list(range(len(keys)))
    assert (whole.keys[index] == keys).all()
    strange = np.setdiff1d(rng.integers(0, 1 << 47, 5000), keys)
    assert (whole.index(strange) == -1).all()
    part = perfect_hash.PerfectHash(n, 2, *map(list, zip(*built[2:5])))
    mine = (buckets >= 2) & (buckets < 5)
    assert (part.index(keys[~mine]) == -1).all() and sorted(part.index(keys[mine]).tolist()) == list(range(mine.sum()))
    assert len(whole.words) * 64 < 6 * len(keys)
    assert len(perfect_hash.build(np.zeros(0, dtype=np.int64))[2]) == 0
