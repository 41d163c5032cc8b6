import hashlib
import random
import re
import zlib

import pytest

from fixtures import DOC_SCHEMA, awkward_docs, docs_frame
from surveil.llm import periodic
from surveil.llm.queries import QUERIES


def brute(words):
    """All runs (start, end, period): every lag, every maximal stretch, the smallest period of each."""
    n, seen = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(12, 2 * q):
                seen.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e, q) for (s, e), q in seen.items())


def texts(rnd):
    """Texts with runs of every kind: few words, nested powers, touching runs, Fibonacci and Thue-Morse words."""
    kind = rnd.randrange(7)
    if kind == 0:
        letters = rnd.randint(1, 3)
        return [rnd.randrange(letters) for _ in range(rnd.randint(0, 400))]
    if kind == 1:
        u = [rnd.randrange(2) for _ in range(rnd.randint(1, 5))]
        for _ in range(rnd.randint(1, 4)):
            u = (u * rnd.randint(1, 5) + [rnd.randrange(3) for _ in range(rnd.randint(0, 2))])[:700]
        return (u * rnd.randint(1, 4))[:900]
    if kind == 2:
        root = rnd.choice([[0, 1], [0, 0, 1], [0, 1, 0, 2]])
        u, v = ((root * rnd.randint(5, 100))[rnd.randint(0, 2):] for _ in range(2))
        return (u + v) * rnd.randint(1, 3)
    if kind == 3:
        x, y = [0], [0, 1]
        while len(y) < 600:
            x, y = y, y + x
        return y[rnd.randint(0, 100):]
    if kind == 4:
        b = [rnd.randrange(50) for _ in range(rnd.randint(20, 300))]
        edge = [rnd.randrange(50) for _ in range(30)]
        return edge + (b * 9)[:int(len(b) * rnd.uniform(1.9, 4))] + edge[::-1]
    if kind == 5:
        return (([0] * rnd.randint(1, 60) + [1] * rnd.randint(0, 3)) * 9)[:rnd.randint(1, 500)]
    s = [0]
    while len(s) < 512:
        s += [1 - x for x in s]
    return s


def found(docs):
    got = periodic._searched([str(i) for i in range(len(docs))], [[b"%d" % w for w in d] for d in docs])
    return [sorted((r["start"], r["start"] + r["length"], r["period"]) for r in row[2]) for row in got]


def test_runs_are_those_of_every_lag():
    rnd = random.Random(11)
    for _ in range(250):
        docs = [texts(rnd) for _ in range(rnd.randint(1, 5))]
        for d, got in zip(docs, found(docs)):
            assert got == brute(d), d


def test_runs_whose_blocks_are_all_periodic_themselves():
    # (ab)^k a repeated: every block inside a period has period 2
    for k in (20, 33, 64, 150):
        for times in (2, 3):
            u = ([0, 1] * k + [0]) * times
            assert found([u])[0] == brute(u)
            assert any(q == 2 * k + 1 for _, _, q in brute(u))


def test_many_seeds_of_one_period(monkeypatch):
    rnd = random.Random(2)
    b = [rnd.randrange(1000) for _ in range(100)]
    text = [w for i in range(30) for w in b + [2000 + i]]  # equal blocks, no run
    monkeypatch.setattr(periodic, "MANY_SEEDS", 3)
    assert found([text, b * 12])[0] == brute(text)
    assert found([b * 12, text])[0] == [(0, 1200, 100)]


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = [(s, e - s, q) for s, e, q in brute(words)]
    runs.sort(key=lambda r: (r[0], r[2]))
    gone = {i for s, n_run, q in runs for i in range(s + q, s + n_run)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in (
        "".join(f"{s},{m},{q}\n" for s, m, q in runs), " ".join(w for i, w in enumerate(words) if i not in gone))]
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, *sha)


@pytest.mark.parametrize("wide", [False, True])
def test_query_rows_of_awkward_documents(spark, tmp_path, wide):
    vocab = "lorem ipsum dolor sit amet x y".split()
    rnd = random.Random(9)
    rows = [r for r in awkward_docs() if len(r[1] or "") < 100_000]  # the long ones have no long runs to compare cheaply
    rows += [(100 + i, " ".join(rnd.choice(vocab) for _ in range(rnd.randint(1, 300))), "en", "a", 0) for i in range(120)]
    docs_frame(spark, rows, wide=wide).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op12_periodic_runs"](spark, str(tmp_path))
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert got.columns == names
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(str(expected(r[0], r[1])) for r in rows)
    assert any(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows)


def test_long_texts_and_the_empty_table(spark, tmp_path):
    docs_frame(spark).write.parquet(f"{tmp_path}/documents.parquet")
    by_id = {r["doc_id"]: r for r in QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()}
    assert (by_id[13]["start"], by_id[13]["length"], by_id[13]["period"]) == (0, 5000, 1)
    assert by_id[12]["n_runs"] >= 0 and by_id[None]["n_runs"] == 0
    spark.createDataFrame([], DOC_SCHEMA).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert QUERIES["op12_periodic_runs"](spark, f"{tmp_path}/none").collect() == []
