import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from fixtures import awkward_docs, docs_frame
from surveil.llm import langid, quality, url_filter
from surveil.llm.queries import QUERIES, URL_RULES

SF = "/root/testdata/sf0.01"


def brute_score(text, weights):
    slots = {}
    for part in quality.ngram_slots(text, quality._Codes()):
        for s in part.tolist():
            slots[s] = slots.get(s, 0) + 1
    n = sum(slots.values())
    z = weights[-1] + sum(weights[s] * c * quality.SCALE / n for s, c in slots.items())
    return 1 / (1 + np.exp(-z))


def test_quality_learns_the_labels_and_repeats_itself(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = QUERIES["op5_quality"](spark, SF).join(labels, "doc_id").toPandas()
    held = got[got["held_out"]]
    right = (held["predicted"] == held["quality"]).mean()
    good, bad = held[held["quality"] == 1]["score"], held[held["quality"] == 0]["score"]
    auc = np.mean([[g > b for b in bad] for g in good])
    assert right > 0.9 and auc > 0.95
    condition = F.col("doc_id") % 3 != 0
    first, again = quality.train(docs, labels, condition), quality.train(docs.repartition(7), labels.repartition(3), condition)
    assert np.array_equal(first, again)
    rows = quality.score(docs.limit(20), first).collect()
    assert all(abs(r["score"] - brute_score(r["text"], first)) < 1e-5 for r in rows)


def test_the_mix_of_labels_and_the_scores_do_not_depend_on_the_cap(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 7 == 0, "!! ?? buy NOW now now").otherwise(
        F.concat(F.lit("The word "), F.md5(F.col("id").cast("string")), F.lit(" was read."))).alias("text"))
    labels = docs.select("doc_id", F.when(F.col("doc_id") % 7 == 0, 0).otherwise(1).alias("quality"))
    mixes = []
    for cap in (500, 2000, 10_000):
        counts = {r["label"]: r["count"] for r in quality.labelled_sample(docs, labels, F.lit(True), cap).groupBy("label").count().collect()}
        assert sum(counts.values()) == min(cap, 4000)
        mixes.append(counts[0] / sum(counts.values()))
    assert max(mixes) - min(mixes) < 0.04
    scores = [quality.score(docs.limit(50), quality.train(docs, labels, F.lit(True), cap), into="s").select("doc_id", "s").collect()
              for cap in (1000, 4000)]
    for a, b in zip(*map(sorted, scores)):
        assert (a["s"] >= quality.THRESHOLD) == (b["s"] >= quality.THRESHOLD) == (a["doc_id"] % 7 != 0)


def test_ftrl_sparsity_and_convergence():
    rows = [(np.array([0, 1]), np.array([1.0, 1.0]), 1), (np.array([2, 1]), np.array([1.0, 1.0]), 0)] * 50
    w = quality.ftrl(rows, 3)
    assert w[0] > 0.5 and w[2] < -0.5 and not w[3:-1].any()


@pytest.mark.parametrize("wide", [False, True])
def test_quality_of_awkward_rows(spark, wide):
    docs = docs_frame(spark, wide=wide)
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (3, None), (8, 1), (8, 0), (None, 1), (12, 0)], "doc_id long, quality int")
    weights = quality.train(docs, labels, F.lit(True), shards=1)
    got = quality.score(docs, weights, into="__s")
    assert got.count() == docs.count() and got.filter("__s is null or __s < 0 or __s > 1").count() == 0
    empty = {round(r["__s"], 12) for r in got.filter("text is null or trim(text) = ''").collect()}
    assert len(empty) == 1
    none = quality.train(docs, labels.filter("1 = 0"), F.lit(True))
    assert {r["s"] for r in quality.score(docs, none, into="s").select("s").collect()} == {0.5}
    assert quality.score(docs_frame(spark, []), weights).count() == 0


def plain_cosines(text, model):
    """Cosines to all centroids with plain loops: words of letters, trigrams over their marked ends, hashed like the model's."""
    words = "".join(c if c.isalpha() else " " for c in "".join(ch.lower() for ch in text)).split()
    line, counts = " " + " ".join(words) + " ", {}
    for a, b, c in zip(line, line[1:], line[2:]):
        a, b, c = (langid._BLANK if x == " " else ord(x) for x in (a, b, c))
        slot = ((a << 42 | b << 21 | c) * int(langid._MIX) % (1 << 64)) >> (64 - langid.BITS)
        counts[slot] = counts.get(slot, 0) + 1
    vector = {s: np.log1p(n) * model.idf[s] for s, n in counts.items()}
    size = sum(v * v for v in vector.values()) ** 0.5
    return [sum(v * float(centre[s]) for s, v in vector.items()) / size if size else 0.0 for centre in model.centres]


def test_languages_are_those_of_the_nearest_centroid(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.train(docs, F.col("doc_id") % 4 != 2)
    assert len(model.languages) == len(model.centres) >= len(set(model.languages)) >= 2
    rows = [r for r in langid.identify(docs.select("doc_id", "text"), model).collect() if r["text"] and len(r["text"]) < 4000][:300]
    rows += [r for r in langid.identify(docs_frame(spark), model).collect() if r["text"] and len(r["text"]) < 4000]
    for r in rows:
        if not any(c.isalpha() for c in r["text"]):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        cosines = plain_cosines(r["text"], model)
        best = max(cosines)
        assert abs(r["score"] - min(max(best, 0.0), 1.0)) < 1e-5
        near = [i for i, c in enumerate(cosines) if c > best - 1e-6]
        assert r["lang_pred"] in {model.languages[i] for i in near}
        assert r["rejected"] in {bool(cosines[i] < model.limits[i]) for i in near}


def test_language_accuracy_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = QUERIES["op9_language_id"](spark, SF).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got["held_out"]]
    assert len(held) > 100 and (held["lang_pred"] == held["lang"]).mean() > 0.97
    assert got["score"].between(0, 1).all()


def test_language_of_awkward_rows(spark):
    docs = docs_frame(spark)
    model = langid.train(docs, F.lit(True))
    assert set(model.languages) == {"en", "de", "fr", "es"}
    got = sorted(((r["doc_id"], r["lang_pred"], r["score"]) for r in langid.identify(docs, model).collect()), key=str)
    for (i, pred, score), row in zip(got, sorted(awkward_docs(), key=str)):
        assert 0 <= score <= 1
    lettered = {r["doc_id"] for r in langid.identify(docs, model).filter("lang_pred <> 'und'").collect()}
    assert lettered == {r[0] for r in awkward_docs() if any(c.isalpha() for c in r[1] or "")}
    nothing = langid.train(docs.filter("1 = 0"), F.lit(True))
    assert {r["lang_pred"] for r in langid.identify(docs, nothing).collect()} == {"und"}
    assert langid.identify(docs_frame(spark, []), model).count() == 0


def test_centroids_are_unit_and_separate_clusters():
    rng = np.random.default_rng(3)
    centres = np.eye(4, 50)
    rows = np.vstack([c + 0.05 * rng.standard_normal((20, 50)) for c in centres])
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    found = langid.cluster(rows, 4)
    assert np.allclose(np.linalg.norm(found, axis=1), 1) and (found @ centres.T).max(axis=0).min() > 0.95
    assert len(langid.cluster(rows[:1], 4)) == 1 and len(langid.cluster(np.repeat(rows[:1], 5, axis=0), 4)) == 1


URLS = [
    None, "", "no scheme", "http://", "http://A.Example.ORG/es/x?q#f", "https://example.org/en/1", "https://example.org/en/2", "http://badexample.org/es/",
    "ftp://x.com/fr/1", "http://x.com/de/", "http://com/de/", "http://xcom/de/", "http://a.net?x=/es/", "http://a.org#/", "http://a.org/", "x://y://z/p",
    "http://a.org", "http://user:pw@Host.COM:80/fr/a b?c", "http://é.example.org/es/\n?x", "://q/de/",
]


def brute_url(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.name), default=None)
    return host, path, best.name if best else None, best.verdict if best else None


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS * 2)] + [(None, URLS[4], "y")], "page_id long, url string, host string")
    got = url_filter.judge(pages, URL_RULES).collect()
    assert len(got) == len(URLS) * 2 + 1
    for r in got:
        host, path, rule, verdict = brute_url(r["url"])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if rule else r["verdict"] in ("allow", "block")
        assert 0 <= r["block_score"] <= 1


def test_the_url_model_learns_from_a_labelled_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    judged = url_filter.judge(pages, URL_RULES)
    ruled = judged.filter("rule is not null").toPandas()
    assert ((ruled["block_score"] >= 0.5) == (ruled["verdict"] == "block")).mean() > 0.9
    labelled = spark.createDataFrame([(f"h{i}.example.net", p, v) for i in range(30) for p, v in (("/shop/1", "block"), ("/news/1", "allow"))], "host string, path string, verdict string")
    fresh = spark.createDataFrame([("http://other.net/shop/9",), ("http://other.net/news/9",)], "url string")
    assert [r["verdict"] for r in url_filter.judge(fresh, [], labelled=labelled).collect()] == ["block", "allow"]
    assert {r["verdict"] for r in url_filter.judge(fresh, []).collect()} == {"allow"}
    assert url_filter.judge(fresh.filter("1 = 0"), URL_RULES).count() == 0
    again = url_filter.judge(pages.repartition(5), URL_RULES).toPandas().sort_values("page_id")
    assert (again["verdict"].values == judged.toPandas().sort_values("page_id")["verdict"].values).all()
