import random
import re

import pytest

from fixtures import awkward_docs, docs_frame, prose
from surveil.llm import decontaminate as dc


def brute_words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(items, words, window):
    hit, found = set(), set()
    for item, w in items:
        m = min(len(w), window)
        for a in range(len(w) - m + 1) if w else ():
            for i in range(len(words) - m + 1):
                if words[i:i + m] == w[a:a + m]:
                    hit.update(range(i, i + m))
                    found.add(item)
    return hit, found


@pytest.mark.parametrize("seed", range(60))
def test_automaton_matches_brute_force(seed):
    rnd = random.Random(seed)
    alphabet = [b"a", b"b", b"c"][: rnd.randint(1, 3)]
    window = rnd.randint(1, 5)
    items = [(str(i), [rnd.choice(alphabet) for _ in range(rnd.randint(0, 9))]) for i in range(rnd.randint(0, 6))]
    automaton = dc.SuffixAutomaton(items, window)
    for _ in range(5):
        words = [rnd.choice([*alphabet, b"z"]) for _ in range(rnd.randint(0, 40))]
        cut = rnd.randint(0, len(words))
        spans, found, longest, size = automaton.match([words[:cut], words[cut:]])
        assert size == len(words)
        hit, want = brute(items, words, window)
        assert {i for a, b in spans for i in range(a, b)} == hit and found == want
        assert spans == sorted(spans) and all(b < c for (_, b), (c, _) in zip(spans, spans[1:]))
        common = max((n for _, w in items for a in range(len(w)) for n in range(1, len(w) - a + 1)
                      if any(words[i:i + n] == w[a:a + n] for i in range(len(words)))), default=0)
        assert longest == common


@pytest.mark.parametrize("size", [1, 3, 1 << 20])
def test_words_are_those_of_the_contract(monkeypatch, size):
    monkeypatch.setattr(dc, "SLICE", size)
    for text in [None, "", "A-Z az 0_9 É1 ü\x7f{x} \x80 日本", "don't STOP\x00now"]:
        assert [w.decode() for w in dc.words_of(text)] == brute_words(text)


def bench(spark):
    return spark.createDataFrame([(1, prose(40, 50)), (2, "short item here"), (3, None), (4, "..."), (None, prose(12, 51)), (5, prose(40, 50))],
                                 "item_id long, text string")


def leaky_docs():
    item = prose(40, 50).split()
    return [
        (100, prose(200, 60) + " " + " ".join(item) + " " + prose(200, 61)), (101, " ".join(item[5:15])), (102, " ".join(item[5:14])),
        (103, prose(100, 62) + ", SHORT: item; here " + prose(100, 63)), (104, prose(300, 64)), (105, prose(40, 50) + " " + prose(12, 51)),
    ]


@pytest.mark.parametrize("block_words", [100_000, 20])
def test_scan_matches_brute_force(spark, block_words):
    rows = leaky_docs() + [(r[0], r[1]) for r in awkward_docs() if r[0] != 12]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = [(str(r["item_id"]).lower().replace("none", "null"), brute_words(r["text"])) for r in bench(spark).collect()]
    blocks = dc.build_blocks(bench(spark), block_words=block_words)
    assert (len(blocks) > dc.BLOCKS_AT_A_TIME) == (block_words == 20)
    got = sorted(((r["doc_id"], r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), tuple(r["items"])) for r in dc.scan(docs, blocks).collect()), key=str)
    want = []
    for i, t in rows:
        hit, found = brute(items, brute_words(t), 10)
        want.append((i, len(brute_words(t)), len(hit), tuple(sorted(found))))
    assert got == sorted(want, key=str)


def test_decontaminated_documents_are_clean_and_the_rest_untouched(spark):
    docs = spark.createDataFrame([(*r, "en", "a", 1) for r in leaky_docs()], "doc_id long, text string, lang string, source string, n_chars long")
    blocks = dc.build_blocks(bench(spark))
    clean = {r["doc_id"]: r["text"] for r in dc.decontaminate(docs, blocks).collect()}
    assert set(clean) == {100, 102, 103, 104}  # 101 and 105 are benchmark text only
    assert clean[104] == prose(300, 64) and clean[102] == dict(leaky_docs())[102]
    assert clean[103] == prose(100, 62) + ",  " + prose(100, 63)
    assert prose(200, 60) in clean[100] + "." and len(brute_words(clean[100])) == 400
    assert all(not r["spans"] for r in dc.scan(dc.decontaminate(docs, blocks), blocks).collect())


def test_cutting_repeats_until_nothing_is_left(spark):
    item = prose(40, 50).split()
    nested = " ".join(item[:6] + item[20:32] + item[6:14])
    docs = spark.createDataFrame([(1, prose(50, 70) + " " + nested + " " + prose(50, 71))], "doc_id long, text string")
    blocks = dc.build_blocks(bench(spark))
    text = dc.decontaminate(docs, blocks).first()["text"]
    assert len(brute_words(text)) == 100


@pytest.mark.parametrize("wide", [False, True])
def test_awkward_and_empty_tables(spark, wide):
    docs, blocks = docs_frame(spark, wide=wide), dc.build_blocks(bench(spark))
    got = dc.decontaminate(docs, blocks)
    assert got.schema == docs.schema and sorted(map(str, got.collect())) == sorted(map(str, docs.collect()))
    assert dc.decontaminate(docs_frame(spark, []), blocks).count() == 0
    none = dc.build_blocks(bench(spark).filter("1 = 0"))
    assert dc.decontaminate(docs, none).count() == docs.count()


@pytest.mark.parametrize("block_words", [100_000, 20])
def test_cutting_in_rounds_equals_cutting_in_the_task(spark, block_words):
    a, b = prose(40, 50).split(), prose(12, 51).split()
    nested = a[:6] + b + a[6:14]  # cutting one item joins a window of another, which another block may hold
    rows = [*leaky_docs(), (200, " ".join(prose(50, 70).split() + nested + prose(50, 71).split())), (201, None), (202, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    blocks = dc.build_blocks(bench(spark), block_words=block_words)
    assert (len(blocks) > 1) == (block_words == 20)
    got = dc.decontaminate(docs, blocks)
    assert got.schema == docs.schema
    texts = {r["doc_id"]: r["text"] for r in got.collect()}
    assert set(texts) == {100, 102, 103, 104, 200, 201, 202} and texts[201] is None and texts[202] == ""
    assert brute_words(texts[200]) == brute_words(prose(50, 70) + " " + prose(50, 71))
    assert texts[103] == prose(100, 62) + ",  " + prose(100, 63)


@pytest.mark.parametrize("block_words", [20, 25, 64])
def test_blocks_are_bounded_and_no_window_is_lost(spark, block_words):
    """An item of many blocks, one of one word more than a block, and one repeated a hundred times."""
    items = [(1, prose(700, 80)), (2, prose(block_words + 1, 81)), *[(3, prose(15, 82))] * 100]
    table = spark.createDataFrame(items, "item_id long, text string")
    blocks = dc.build_blocks(table, block_words=block_words)
    held = [len(a.length) for a in (dc.pickle.loads(r["body"]) for r in blocks.rows.collect())]
    assert len(held) == len(blocks) and max(held) <= 2 * block_words + 1
    long = prose(700, 80).split()
    docs = spark.createDataFrame([(i, " ".join(long[i:i + 10])) for i in range(691)], "doc_id long, text string")
    got = dc.scan(docs, blocks).collect()
    assert len(got) == 691 and all(r["items"] == ["1"] and r["spans"][0]["end"] == 10 for r in got)
