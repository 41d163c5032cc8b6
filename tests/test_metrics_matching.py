"""Metrics (G6), matching (G5, G9), folds (G8), text."""

import datetime as dt

from pyspark.sql import functions as F

from helpers import one
from surveil.operators import matching as mt
from surveil.operators import metrics as met
from surveil.operators import model as md
from surveil.operators import text as tx

G6 = [(1, 0.9), (0, 0.9), (1, 0.6), (0, 0.6), (0, 0.2), (1, 0.1)]


def test_g6_rank_metrics_and_optimal_threshold(spark):
    df = spark.createDataFrame(G6, "label int, score double")
    r = one(met.rank_metrics(df))
    assert r["roc_auc"] == 0.4444 and r["pr_auc"] == 0.5
    best = one(met.optimise_threshold(df))
    assert best["threshold"] == 0.01 and best["cost"] == 3.0


def test_sweep_recall_non_increasing_and_counts(spark):
    df = spark.createDataFrame([(i % 3 == 0 and 1 or 0, (i * 37 % 100) / 100.0) for i in range(300)], "label int, score double")
    rows = met.threshold_sweep(df).orderBy("raw_threshold").collect()
    rec = [r["recall"] for r in rows]
    assert all(a >= b for a, b in zip(rec, rec[1:]))
    assert all(r["tp"] + r["fp"] + r["tn"] + r["fn"] == 300 for r in rows)
    c = one(met.confusion(df, rows[3]["raw_threshold"]))
    assert (c["tp"], c["fp"]) == (rows[3]["tp"], rows[3]["fp"])


def test_null_score_is_negative(spark):
    df = spark.createDataFrame([(1, None), (0, 0.9)], "label int, score double")
    c = one(met.confusion(df, 0.5))
    assert (c["tp"], c["fp"], c["tn"], c["fn"]) == (0, 1, 0, 1)


def test_g5_robust_scale_and_drops(spark):
    df = spark.createDataFrame([(i, [float(v), 7.0, None]) for i, v in enumerate([1, 2, 4, 8])], "id int, x array<double>")
    st = mt.fit_scaler(df, "x")
    assert st.index == [0, 1]             # all-NULL feature dropped (C0)
    assert st.center[0] == 3.0 and st.scale[0] == 3.25
    assert st.scale[1] == 1.0             # constant column: zero IQR -> 1


def test_g5_quantile_bins(spark):
    d = [1, 1, 1, 2, 3, 4, 5, 6, 7, 8]
    pool = spark.createDataFrame([(i, 0, float(v)) for i, v in enumerate(d)], "id int, centroid_idx int, distance double")
    got = [r["_bin"] for r in mt.distance_bins(pool, 5).orderBy("id").collect()]
    assert got == [0, 0, 0, 0, 1, 1, 2, 2, 3, 3]


def test_nearest_centroid_ties_and_blocks(spark):
    cents = spark.createDataFrame([(0, 10, [0.0, 0.0]), (1, 11, [1.0, 0.0]), (2, 12, [0.0, 0.0])],
                                  "centroid_idx int, vec_id int, z array<double>")
    cands = spark.createDataFrame([(100, [0.1, 0.0]), (101, [0.9, 0.0])], "vec_id int, z array<double>")
    for block in (1 << 20, 16):  # one block, and one centroid per block
        got = {r["vec_id"]: (r["centroid_idx"], round(r["distance"], 6))
               for r in mt.nearest_centroid(cands, cents, ["vec_id"], ["vec_id"], block_bytes=block).collect()}
        assert got == {100: (0, 0.1), 101: (1, 0.1)}  # tie between 0 and 2 goes to the lowest index


def test_g9_sampling_without_replacement_and_partition_independent(spark):
    pool = spark.createDataFrame([(i, i % 2, float(i)) for i in range(7)], "id int, centroid_idx int, distance double")
    for fn in (lambda p: mt.sample_random(p, 10, ["id"]), lambda p: mt.sample_nearest(p, 10, ["id"]),
               lambda p: mt.sample_stratified(p, 10, ["id"])):
        a = sorted(r["id"] for r in fn(pool.repartition(1)).collect())
        b = sorted(r["id"] for r in fn(pool.repartition(200)).collect())
        assert a == b == list(range(7))


def test_matching_report_keeps_empty_centroids(spark):
    cents = spark.createDataFrame([(0,), (1,)], "centroid_idx int")
    pool = spark.createDataFrame([(5, 0, 1.0)], "id int, centroid_idx int, distance double")
    rep = {r["centroid_idx"]: r for r in mt.matching_report(cents, pool, pool, ratio=5).collect()}
    assert rep[1]["n_selected"] == 0 and rep[1]["n_candidates"] == 0 and rep[1]["mean_dist"] is None
    assert rep[0]["coverage"] == 0.2


def test_g8_folds_are_disjoint(spark):
    d1, d2 = dt.date(2020, 1, 1), dt.date(2021, 1, 1)
    df = spark.createDataFrame([("A", d1, 1), ("B", d1, 1), ("C", d2, 1), ("Z", d1, 0), ("Z", d2, 0)],
                               "ticker string, d_date date, label int")
    folds = md.fold_dates(df.filter("label = 1"))
    assert folds == [d1, d2]  # two cases sharing a D-date form one fold
    f = md.leave_one_group_out(df, folds)
    leak = f.filter("role = 'train'").select("fold", "d_date").intersect(f.filter("role = 'test'").select("fold", "d_date"))
    assert leak.count() == 0
    assert f.filter("role = 'test' AND ticker = 'Z'").count() == 2  # a candidate ticker may be in several folds


def test_g7_symbol_patterns(spark):
    text = ("The company (ticker: ABCD) and its trading symbol \"XYZ\"; shares traded under 'QQ' "
            "and stock symbol ABC were traded on the market. (ticker: ABCD)")
    df = spark.createDataFrame([(1, text)], "doc_id int, text string")
    got = one(tx.extract_symbols(df, "text"))["symbols"]
    assert got == ["ABC", "ABCD", "QQ", "XYZ"]  # 'THE' captured case-insensitively, removed as a stopword


def test_g7_hits_and_cases(spark):
    hits = spark.createDataFrame([
        (1, '{"_id":"a1","_source":{"file_date":"2020-05-01","file_path":"/x/1.htm","display_names":[],"entity_names":["Acme"]}}'),
        (2, '{"_id":"a2","_source":{"file_date":"bad","file_path":"http://h/2","display_names":["Beta"]}}'),
        (3, '{"_id":"a3","_source":{"file_date":"2020-05-01"}}'),
    ], "hit_order int, hit string")
    p = tx.document_url(tx.parse_hits(hits)).orderBy("hit_order").collect()
    assert [r["company"] for r in p] == ["Acme", "Beta", ""]
    assert [r["case_url"] for r in p] == ["https://www.sec.gov/x/1.htm", "http://h/2", "https://www.sec.gova3"]
    withsym = tx.document_url(tx.parse_hits(hits)).withColumn("symbols", F.array(F.lit("ZZ")))
    cases = tx.build_cases(withsym).collect()
    assert len(cases) == 1 and cases[0]["company"] == "Acme"  # bad date dropped; first hit kept per (ticker, date)


def test_html_to_text(spark):
    html = '<html><head><style>p{}</style><script>var t="</p>";</script></head><body><!-- c --><p>A&amp;B</p></body></html>'
    df = spark.createDataFrame([(html,)], "html string")
    assert one(tx.html_to_text(df))["text"].split() == ["A&B"]


def test_top_up_adds_next_closest_unused(spark):
    pool = spark.createDataFrame([(i, 0, float(i)) for i in range(6)], "id int, centroid_idx int, distance double")
    chosen = pool.filter("id IN (4)")
    got = sorted(r["id"] for r in mt.top_up(chosen, pool, 3, ["id"]).collect())
    assert got == [0, 1, 4]
