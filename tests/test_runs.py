"""SQL functions, whole runs in one call, the single-pass report and the bound on discovered categories."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from surveil.functions.sql import register_scorer, register_universe
from surveil.operators import features as feat
from surveil.operators import metrics as met
from surveil.operators import model as md
from surveil.operators import runs
from surveil.operators import universe as uv
from surveil.session import scratch_path


def test_sql_rules_are_the_operators_rules(spark):
    assert register_universe(spark) == ["normal_symbol", "is_common_stock", "market_cap_tier"]
    rows = [(s, t, e) for s in (" abc ", "ABCW", "A.B", "TOOLONG", "", None, "xyzR", "Q", "A$", "pp") for t, e in (("N", None), ("Y", "N"), (None, "Y"))]
    df = spark.createDataFrame(rows, "ticker string, test_issue string, etf string")
    want = uv.filter_symbols(uv.drop_flagged(df)).select("ticker").collect()
    got = spark.sql("SELECT normal_symbol(ticker) AS ticker FROM {df} WHERE is_common_stock(ticker, test_issue, etf)", df=df).collect()
    assert sorted(map(str, got)) == sorted(map(str, want)) != []
    caps = spark.createDataFrame([(x,) for x in (None, -1.0, 0.0, 3e8, 2e9, 1e10, 2e11, float("inf"), float("nan"))], "c double")
    got = caps.select(feat.market_cap_tier(F.col("c")).alias("a"), F.expr("market_cap_tier(c)").alias("b")).collect()
    assert all(r["a"] == r["b"] for r in got) and len({r["b"] for r in got}) == 6


def _features(spark):
    rng = np.random.default_rng(5)
    dates = [dt.date(2020, 1, 1) + dt.timedelta(days=40 * i) for i in range(3)]
    rows = [(f"P{k}", dates[k % 3], 1, None if k == 4 else float(rng.normal(2)), float(rng.normal(1))) for k in range(9)]
    rows += [(f"N{k}", d, 0, float(rng.normal(0)), None if k % 9 == 0 else float(rng.normal(0))) for k in range(40) for d in dates]
    return spark.createDataFrame(rows, "ticker string, d_date date, label int, f1 double, f2 double")


def test_scorer_from_sql_and_over_a_folder(spark):
    f = md.cut_lineage(_features(spark))
    fm = md.fit_final(f.filter("label = 1"), f.filter("label = 0"), ["f1", "f2"], md.CVConfig(n_trees=7, ratio=3), threshold=0.4)
    register_scorer(spark, fm, "p_of")
    want = {(r["ticker"], r["d_date"]): r["fraud_proba"] for r in md.score(fm, f).collect()}
    got = spark.sql("SELECT ticker, d_date, p_of(array(f1, f2)) AS p FROM {f}", f=f).collect()
    assert len(got) == len(want) and all(abs(r["p"] - want[r["ticker"], r["d_date"]]) < 1e-12 for r in got)
    assert spark.sql("SELECT p_of(CAST(NULL AS ARRAY<DOUBLE>)) AS p").first()["p"] is None

    folder, model, out = (scratch_path(spark, n) for n in ("feats", "model", "out"))
    f.write.parquet(folder)
    md.save_model(fm, model)
    scores = runs.evaluate_folder(spark, model, folder, out)
    assert {(r["ticker"], r["d_date"]): r["fraud_proba"] for r in scores.collect()} == pytest.approx(want)
    report = spark.read.parquet(f"{out}/report")
    assert {r["mode"] for r in report.select("mode").distinct().collect()} == {"summary", "optimised", "fixed"}
    assert report.filter("mode = 'fixed'").first()["threshold"] == 0.4
    f.drop("label").write.parquet(folder + "-plain")
    assert "fraud_flag" in runs.evaluate_folder(spark, model, folder + "-plain", out + "-plain").columns


def test_report_is_made_of_its_sweeps(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(int(rng.random() < 0.3), float(round(rng.random(), 2))) for _ in range(500)], "label int, score double")
    report = met.holdout_report(df, threshold=0.37)
    rows = lambda d: sorted(map(str, d.collect()))
    cols = [c for c in report.columns if c != "mode"]
    of = lambda mode: report.filter(F.col("mode") == mode).select(*cols)
    assert rows(of("summary")) == rows(met.threshold_sweep(df).select(*cols))
    assert rows(of("optimised")) == rows(met.optimise_threshold(df).select(*cols))
    assert rows(of("fixed")) == rows(met.threshold_sweep(df, [0.37]).select(*cols))


def test_discovered_categories_are_bounded(spark, monkeypatch):
    meta = spark.range(30).selectExpr("cast(id AS string) AS ticker", "1e9D AS market_cap", "concat('C', id) AS country", "'EUR' AS currency")
    assert len(feat.metadata_categories(meta)["country"]) == 30
    monkeypatch.setattr(feat, "MAX_CATEGORIES", 20)
    with pytest.raises(ValueError):
        feat.metadata_categories(meta)


def test_from_raw_bars_to_a_stored_model(spark):
    rng = np.random.default_rng(9)
    start, rows = dt.date(2021, 1, 1), []
    for t in [f"P{i}" for i in range(4)] + [f"N{i}" for i in range(12)]:
        px = 10.0
        for d in range(0, 140, 2):
            px = max(1.0, px * (1 + float(rng.normal(0.03 if t[0] == "P" else 0, 0.05))))
            rows.append((t, start + dt.timedelta(days=d), px, px * 1.02, px * 0.98, px, float(rng.integers(100, 1000))))
    bars = spark.createDataFrame(rows, "ticker string, date date, open double, high double, low double, close double, volume double")
    cases = spark.createDataFrame([(f"P{i}", start + dt.timedelta(days=110 + 10 * i)) for i in range(4)], "ticker string, d_date date")
    names = ["close_chg_5d", "close_roll10_mean", "volume_roll5_sum", "cmf_5d"]
    path = scratch_path(spark, "run-model")
    run = runs.train_from_bars(bars, cases, bars.filter("ticker LIKE 'N%'").select("ticker").distinct(), path,
                               md.CVConfig(n_trees=6, ratio=2), lookback_bars=30, feature_cols=names)
    assert run.oof.count() == 4 + 4 * 12 and run.oof.filter("true_label = 1").count() == 4
    assert md.load_model(spark, path).feature_cols == names
