"""Models: isolation-forest invariants, CV leakage, final model round trip."""

import datetime as dt
import os

import numpy as np
from pyspark.sql import functions as F

from surveil.operators import forest as fr
from surveil.operators import model as md
from surveil.session import scratch_path


def _points(spark, n=400, outliers=5, seed=3):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 4)]) for i in range(n)]
    rows += [(n + k, [8.0 + k, -9.0, 7.5, 10.0]) for k in range(outliers)]
    return spark.createDataFrame(rows, "id int, z array<double>")


def test_forest_scores_bounded_deterministic_and_outliers_on_top(spark):
    pts = _points(spark)
    nodes = fr.fit_forest(pts, ["id"], "z", n_trees=50, max_samples=128, seed=7)
    a = {r["id"]: r[fr.SCORE_COL] for r in fr.score_forest(pts, nodes, "z").collect()}
    b = {r["id"]: r[fr.SCORE_COL] for r in fr.score_forest(pts.repartition(17), fr.fit_forest(pts.repartition(3), ["id"], "z", 50, 128, 7), "z").collect()}
    assert a == b
    assert all(0.0 < s <= 1.0 for s in a.values())
    top = sorted(a, key=a.get, reverse=True)[:5]
    assert set(top) == {400, 401, 402, 403, 404}


def test_forest_tree_sizes_bounded_by_psi(spark):
    nodes = fr.fit_forest(_points(spark), ["id"], "z", n_trees=10, max_samples=64, seed=1)
    per_tree = nodes.groupBy("tree_id").agg(F.max("psi").alias("psi"), F.max(F.when(F.col("node") == 0, F.col("size"))).alias("root"))
    assert all(r["psi"] == 64 and r["root"] == 64 for r in per_tree.collect())


def _features(spark):
    rng = np.random.default_rng(11)
    d1, d2, d3 = dt.date(2020, 1, 1), dt.date(2020, 6, 1), dt.date(2021, 1, 1)
    rows = []
    for k, d in enumerate([d1, d2, d3, d1]):
        rows.append((f"P{k}", d, 1, *[float(x) for x in rng.normal(2, 1, 3)]))
    for k in range(30):
        for d in (d1, d2, d3):
            rows.append((f"N{k}", d, 0, *[float(x) for x in rng.normal(0, 1, 3)]))
    return spark.createDataFrame(rows, "ticker string, d_date date, label int, f1 double, f2 double, f3 double")


def test_cross_validation_has_no_date_leakage_and_one_row_per_test_row(spark):
    f = _features(spark)
    tp, tn = f.filter("label = 1"), f.filter("label = 0")
    oof = md.cross_validate(tp, tn, ["f1", "f2", "f3"], md.CVConfig(n_trees=10, ratio=3))
    rows = oof.collect()
    assert all(r["fold"] == r["d_date"] for r in rows)            # every OOF row was held out by its own date
    assert len(rows) == f.count()                                   # each row scored once, in its fold
    assert all(0.0 <= r["pred_proba"] <= 1.0 for r in rows)


def test_final_model_save_load_round_trip(spark):
    f = _features(spark)
    tp, tn = f.filter("label = 1"), f.filter("label = 0")
    fm = md.fit_final(tp, tn, ["f1", "f2", "f3"], md.CVConfig(n_trees=10, ratio=3), threshold=0.5)
    path = md.save_model(fm, scratch_path(spark, "model-test"))
    assert os.path.isdir(os.path.join(path, "tree")) or path.startswith(("hdfs:", "s3"))
    loaded = md.load_model(spark, path)
    a = {r["ticker"] + str(r["d_date"]): r["fraud_proba"] for r in md.score(fm, f).collect()}
    b = {r["ticker"] + str(r["d_date"]): (r["fraud_proba"], r["fraud_flag"]) for r in md.score(loaded, f, use_threshold=True).collect()}
    assert all(abs(a[k] - b[k][0]) < 1e-12 and b[k][1] == int(b[k][0] >= 0.5) for k in a)


def _with_empty_feature(spark):
    """``f0`` never has a value, ``f2`` sometimes; the class depends on ``f3``."""
    rng = np.random.default_rng(21)
    dates = [dt.date(2020, 1, 1), dt.date(2020, 6, 1), dt.date(2021, 1, 1)]
    rows = []
    for k in range(60):
        label = int(k % 6 == 0)
        f2 = None if k % 4 == 0 else float(rng.normal())
        f3 = None if k % 11 == 3 else float(rng.normal(5 * label, 0.5))
        rows.append((f"T{k}", dates[k // 6 % 3], label, None, float(rng.normal()), f2, f3))
    return spark.createDataFrame(rows, "ticker string, d_date date, label int, f0 double, f1 double, f2 double, f3 double")


def test_importances_and_rules_name_the_features_that_the_tree_saw(spark):
    f = _with_empty_feature(spark)
    fm = md.fit_final(f.filter("label = 1"), f.filter("label = 0"), ["f0", "f1", "f2", "f3"], md.CVConfig(n_trees=10, ratio=3))
    assert fm.tree_features == ["f1", "f2", "f3", fr.SCORE_COL]
    top = fm.importances(spark, top=1).first()
    assert top["feature"] in ("f3", fr.SCORE_COL) and top["importance"] > 0.4
    assert "f0" not in " ".join(r["rule"] for r in fm.rules(spark).collect())


def test_rules_reach_every_row_and_say_what_the_tree_says(spark):
    f = _with_empty_feature(spark)
    fm = md.fit_final(f.filter("label = 1"), f.filter("label = 0"), ["f0", "f1", "f2", "f3"], md.CVConfig(n_trees=10, ratio=3))
    rules = fm.rules(spark).collect()
    rows = md.score(fm, f).select("*", *[F.expr(r["rule"]).alias(f"r{i}") for i, r in enumerate(rules)]).collect()
    assert any(r["f3"] is None for r in rows)
    for r in rows:
        met = [i for i in range(len(rules)) if r[f"r{i}"]]
        assert len(met) == 1 and abs(rules[met[0]]["p_positive"] - r["fraud_proba"]) < 1e-12


def test_training_run_picks_a_threshold_or_keeps_the_default(spark):
    f = _with_empty_feature(spark)
    names, cfg = ["f0", "f1", "f2", "f3"], md.CVConfig(n_trees=10, ratio=3)
    run = md.train(f.filter("label = 1"), f.filter("label = 0"), names, cfg)
    assert run.cv_metrics.first()["threshold"] == run.model.threshold and run.oof.count() == f.count()
    # positives of one date only: nothing is left to train a fold on, so there is no evidence for a threshold
    one_date = f.filter("label = 1 AND d_date = DATE '2020-01-01'")
    run = md.train(one_date, f.filter("label = 0"), names, cfg)
    assert run.cv_metrics is None and run.model.threshold == md.DEFAULT_THRESHOLD and run.oof.count() == 0


def test_many_folds_agree_with_folds_trained_one_by_one(spark):
    f = _with_empty_feature(spark)
    names, cfg = ["f0", "f1", "f2", "f3"], md.CVConfig(n_trees=8, ratio=2)
    tp, tn = f.filter("label = 1"), f.filter("label = 0")
    oof = {(r["ticker"], r["d_date"]): r["pred_proba"] for r in md.cross_validate(tp, tn, names, cfg).collect()}
    held = dt.date(2020, 6, 1)
    fm = md.fit_final(tp.filter(F.col("d_date") != held), tn.filter(F.col("d_date") != held), names, cfg)
    # the forest's random numbers follow the fold's name, so compare what does not depend on them
    assert {k for k in oof if k[1] == held} == {(r["ticker"], r["d_date"]) for r in f.filter(F.col("d_date") == held).collect()}
    assert fm.fill.index == [1, 2, 3]


def test_forest_sampling_takes_the_smallest_hashes_of_every_tree(spark):
    pts = _points(spark, n=3000, outliers=0)
    got = fr.tree_samples(pts, ["id"], "z", n_trees=3, max_samples=64, seed=5).select("tree_id", "id").collect()
    every = pts.select("id", F.explode(F.array(*[F.lit(t) for t in range(3)])).alias("tree_id")).withColumn("h", F.xxhash64("id", "tree_id", F.lit(5))).collect()
    for t in range(3):
        want = sorted((r["h"], r["id"]) for r in every if r["tree_id"] == t)[:64]
        assert {r["id"] for r in got if r["tree_id"] == t} == {i for _, i in want}


def test_nearest_uses_exact_distances(spark):
    from surveil.operators import matching as mt

    rng = np.random.default_rng(8)
    points, cents = rng.normal(1e6, 1, (500, 20)), rng.normal(1e6, 1, (40, 20))
    cents[7] = cents[3]
    d2, at = mt.nearest(points, cents)
    full = ((points[:, None] - cents[None]) ** 2).sum(axis=2)
    assert (at == full.argmin(axis=1)).all() and np.array_equal(d2, full.min(axis=1)) and 7 not in at


def test_scaler_builds_a_vector_once_a_row(spark):
    """The vector is an expression over wide columns; inside the function over its places it would be built for every place."""
    from surveil.operators import matching as mt

    rows = [(1.0, None, 3.0, None), (None, 5.0, float("nan"), 2.0)]
    df = mt.as_vector(spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(2), ["a", "b", "c", "d"])
    stats = mt.ScalerStats([0, 2, 3], [10.0, 20.0, 30.0], [1.0, 2.0, 3.0], [2.0, 4.0, 8.0])
    for out, want in ((mt.apply_scaler(df, stats), {(0.0, 0.25, 3.375), (4.5, 4.5, -0.125)}),
                      (mt.impute(df, stats, out="z"), {(1.0, 3.0, 30.0), (10.0, 20.0, 2.0)})):
        assert {tuple(r["z"]) for r in out.select("z").collect()} == want
        plan = out.select("z")._jdf.queryExecution().optimizedPlan().toString()
        assert "nanvl(" in plan and "nanvl(" not in plan.split("lambdafunction(", 1)[1]


def test_lookbacks_run_beside_each_other_with_the_same_results(spark, monkeypatch):
    import threading

    f = _features(spark)
    feats = f.withColumn("lookback", F.lit(30)).unionByName(f.withColumn("lookback", F.lit(60)).withColumn("f1", F.col("f1") * F.col("f2")))
    cfg, met, validate = md.CVConfig(n_trees=5, ratio=3), threading.Barrier(2, timeout=120), md.cross_validate

    def beside(*args):
        met.wait()  # raises unless another lookback is on its way
        return validate(*args)

    alone = {lb: sorted(map(tuple, validate(p.filter("label = 1"), p.filter("label = 0"), ["f1", "f2", "f3"], cfg).collect()))
             for lb in (30, 60) for p in [feats.filter(F.col("lookback") == lb).drop("lookback")]}
    monkeypatch.setattr(md, "cross_validate", beside)
    oof = md.lookback_oof(feats, ["f1", "f2", "f3"], cfg)
    assert {lb: sorted(map(tuple, oof.filter(F.col("lookback") == lb).drop("lookback").collect())) for lb in (30, 60)} == alone


def test_keys_of_the_supplier_matrix_are_computed_once(spark):
    """Weights and folds read the keys twice; the windows behind them are built once."""
    from conftest import SF_SMALL
    from surveil.plans import catalog

    for name in ("m4_class_weights_sup", "m9_fold_membership_sup"):
        plan = catalog.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert "l_shipdate" not in plan and "Window" not in plan
