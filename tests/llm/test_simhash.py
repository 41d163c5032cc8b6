import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from fixtures import awkward_docs, docs_frame, prose
from surveil.llm import simhash as sh
from surveil.llm import words as wd


def brute_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    if not shingles:
        return 0
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_components(fps):
    """fps: list of (id, fp); all pairs at most two bits apart are linked."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i][1] ^ fps[j][1]).count("1") <= 2:
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(fps):
        r = find(i)
        least[r] = min((x for x in (least.get(r), doc) if x is not None), default=None)
    return sorted(((doc, fp, least[find(i)]) for i, (doc, fp) in enumerate(fps)), key=str)


@pytest.mark.parametrize("size", [1, 5, 64, 1 << 20])
def test_fingerprints_match_brute_force_at_any_slice(monkeypatch, size):
    monkeypatch.setattr(wd, "SLICE", size)
    monkeypatch.setattr(sh, "PART", 3 if size < 100 else 1 << 15)
    for text in [None, "", "  ", "one", "One TWO", "a b c", "a b c d " * 7, "É ü \x1c x\x0by z", prose(60, 1), "same " * 9]:
        assert sh.fingerprint(text) == brute_fingerprint(text)


def test_the_hash_is_the_one_of_spark(spark):
    shingle = "größe über alles"
    got = spark.range(1).select(F.xxhash64(F.lit(shingle))).first()[0]
    assert got & (1 << 64) - 1 == xxhash.xxh64_intdigest(shingle.encode(), seed=42)


def near_groups(seed, n_groups=30):
    rnd = random.Random(seed)
    out = []
    for _ in range(n_groups):
        centre = rnd.getrandbits(64)
        for _ in range(rnd.randint(1, 6)):
            fp = centre
            for bit in rnd.sample(range(64), rnd.randint(0, 3)):
                fp ^= 1 << bit
            out += [fp] * rnd.randint(1, 2)
    return [(i, fp) for i, fp in enumerate(out)]


def signed(fp):
    return fp - (1 << 64) if fp >> 63 else fp


def run(spark, fps, monkeypatch=None):
    frame = spark.createDataFrame([(i, signed(fp)) for i, fp in fps], "doc_id long, fp long")
    got = sh.near_duplicates(frame).select("doc_id", "fp", "component_id", sh.fingerprint_hex(F.col("fp")).alias("hex"))
    return sorted(((r["doc_id"], int(r["hex"], 16), r["component_id"]) for r in got.collect()), key=str)


@pytest.mark.parametrize("hot_key", [64, 1])
def test_components_match_all_pairs(spark, monkeypatch, hot_key):
    links = sh.links
    monkeypatch.setattr(sh, "links", lambda d, distance: links(d, distance, hot_key))
    fps = near_groups(3) + [(1000 + i, fp) for i, fp in enumerate([0, 1, 3, 7, (1 << 64) - 1, (1 << 64) - 2])] + [(None, 0), (None, 1 << 40)]
    assert run(spark, fps) == brute_components(fps)


def test_a_dense_ball_is_one_group(spark):
    rnd = random.Random(9)
    centre = rnd.getrandbits(64)
    fps = {centre ^ sum(1 << b for b in rnd.sample(range(14), rnd.randint(0, 6))) for _ in range(600)}
    fps = list(enumerate(sorted(fps)))
    assert run(spark, fps) == brute_components(fps)


def test_chains_of_links_are_followed(spark):
    fp, fps = 0, []
    for i in range(60):  # each one bit from the last
        fps.append((500 - i, fp))
        fp ^= 1 << i
    assert {c for _, _, c in run(spark, fps)} == {441}


@pytest.mark.parametrize("wide", [False, True])
def test_awkward_documents(spark, wide):
    docs = docs_frame(spark, wide=wide)
    prints = docs.select("doc_id", sh.fingerprint_column(F.col("text")).alias("fp")).collect()
    got = run(spark, [(r["doc_id"], r["fp"] & (1 << 64) - 1) for r in prints])
    assert got == brute_components([(r[0], brute_fingerprint(r[1])) for r in awkward_docs()])


def test_empty_table(spark):
    assert run(spark, []) == []
