import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from fixtures import awkward_docs, docs_frame
from surveil.llm import exact_dedup as ed


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_chunk_fingerprint_is_the_polynomial_and_combines_anywhere():
    rnd = random.Random(1)
    data = bytes(rnd.randrange(256) for _ in range(5000))
    for base, prime, got in zip(ed.BASES, ed.PRIMES, ed.chunk_fingerprint(data)):
        value = 0
        for b in data:
            value = (value * base + b) % prime
        assert got == value
    whole = ed.chunk_fingerprint(data)
    for _ in range(20):
        a, b = sorted(rnd.randrange(5001) for _ in range(2))
        x, y, z = (ed.chunk_fingerprint(data[i:j]) for i, j in ((0, a), (a, b), (b, 5000)))
        assert ed.combine(ed.combine(x, y), z) == ed.combine(x, ed.combine(y, z)) == whole


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1 << 20])
def test_normalised_pieces_at_any_slice(monkeypatch, size):
    monkeypatch.setattr(ed, "SLICE", size)
    for text in [None, "", " ", "  a", "a  ", " a \t\n b\x0b\x0c\r c  ", "é ü   x", "\x1c a"]:
        body = normal(text).encode()
        assert b"".join(ed.normalised_pieces(text)) == body
        assert ed.fingerprint_of(text) == ((ed.chunk_fingerprint(body)[0] << 31) | ed.chunk_fingerprint(body)[1], len(body), hashlib.sha256(body).hexdigest())


def brute(rows):
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(normal(t), []).append(i)
    out, seen = [], set()
    for i, t, *_ in rows:
        ids = groups[normal(t)]
        keep = min((x for x in ids if x is not None), default=None)
        kept = i == keep and (normal(t), i) not in seen
        seen.add((normal(t), i))
        out.append((i, keep, len(ids), kept, hashlib.sha256(normal(t).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("wide", [False, True])
def test_awkward_rows_match_brute_force(spark, wide):
    got = ed.exact_duplicates(docs_frame(spark, wide=wide))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(awkward_docs())


def test_empty_table(spark):
    assert ed.exact_duplicates(docs_frame(spark, [])).count() == 0


def test_differing_texts_under_one_fingerprint_are_found_and_split(spark):
    long = "ab " * 60_000
    rows = [(1, long), (2, long), (3, long + "c"), (4, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    prints = ed.fingerprints(docs)
    assert ed.differing_fingerprints(docs, prints.select("fp", "fp_len").distinct()).count() == 0
    # as if 1, 2 and 3 had collided
    forged = prints.withColumn("fp", F.when(F.col("doc_id") < 4, 5).otherwise(6)).withColumn("fp_len", F.lit(1).cast("long")).withColumn("row", F.monotonically_increasing_id())
    differ = spark.createDataFrame([(5, 1)], "fp long, fp_len long")
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in ed.group_copies(forged, differ).collect()}
    assert got == {1: (1, 2, True), 2: (1, 2, False), 3: (3, 1, True), 4: (4, 1, True)}


@pytest.mark.parametrize("part_chars", [1, 5, 1000])
def test_parts_hashed_apart_give_the_fingerprint_of_the_whole(spark, part_chars):
    """Long documents are hashed part by part in several tasks and combined in order."""
    rnd = random.Random(part_chars)
    rows = [(i, "".join(rnd.choice("ab \t\né\x0b日") for _ in range(rnd.choice([0, 1, 4, 30, 90])))) for i in range(60)]
    if part_chars == 1000:
        rows = [(i, "".join(rnd.choice("ab \té") for _ in range(20_000 + i))) for i in range(4)]
    rows += [(100, None), (101, "   \t  \n "), (102, " "), (None, rows[0][1]), (2**60 + 1, rows[3][1].replace(" ", "\n \t")), rows[3], rows[3]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = ed.fingerprints(docs, part_chars=part_chars).collect()
    assert sorted(((r["doc_id"], r["fp"], r["fp_len"], r["text_sha256"]) for r in got), key=str) == sorted(((i, *ed.fingerprint_of(t)) for i, t in rows), key=str)
    assert len({r["row"] for r in got}) == len(rows)
    parts = spark.createDataFrame(
        [(7, n, rows[3][1][i:i + part_chars].encode(), bool(n) and rows[3][1][i - 1] in " \t\n\x0b\x0c\r")
         for n, i in enumerate(range(0, len(rows[3][1]), part_chars))], "row long, part long, piece binary, blank boolean")
    if rows[3][1]:
        spread = ed.combined_parts(parts.orderBy(F.desc("part"))).first()
        assert (spread["fp"], spread["fp_len"]) == ed.polynomial_of(rows[3][1])
    result = ed.exact_duplicates(docs, part_chars=part_chars).collect()
    assert sorted((tuple(r) for r in result), key=str) == brute(rows)
