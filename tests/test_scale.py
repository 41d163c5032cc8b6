"""Exact distributed quantiles and rank metrics, plans without jobs, and the rules for shared storage."""

import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from helpers import one
from surveil.functions import quantiles as qt
from surveil.operators import metrics as met
from surveil.plans import catalog


@pytest.mark.parametrize("few", [50_000, 100])
def test_exact_quantiles_match_numpy(spark, monkeypatch, few):
    monkeypatch.setattr(qt, "FEW", few)
    rng = np.random.default_rng(4)
    groups = {
        "normal": rng.normal(size=60_000), "ties": rng.integers(0, 5, 60_000).astype(float), "skewed": np.exp(rng.normal(0, 4, 60_000)),
        "third": np.where(rng.random(60_000) < 0.34, 1.5, rng.random(60_000)), "few": np.array([3.0, 1.0, 2.0, 10.0]), "one": np.array([7.0]), None: np.array([1.0, 2.0]),
    }
    if few == 100:  # brackets need groups well above the sketch's resolution
        groups = {k: v for k, v in groups.items() if len(v) > few or len(v) < 5}
    import pandas as pd

    rows = pd.concat([pd.DataFrame({"g": k, "v": v}) for k, v in groups.items()])
    df = spark.createDataFrame(rows).withColumn("g", F.when(F.col("g") != "NaN", F.col("g"))).repartition(7)
    df = df.unionByName(spark.createDataFrame([("normal", None), ("empty", None)], "g string, v double"))
    qs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {r["g"]: r["q"] for r in qt.exact_quantiles(df, "v", qs, ["g"]).collect()}
    assert set(got) == set(groups)
    for k, v in groups.items():
        assert np.allclose(got[k], np.quantile(v, qs), rtol=0, atol=1e-9), k
    whole = one(qt.exact_median(df, "v"))["median"]
    assert abs(whole - np.median(np.concatenate(list(groups.values())))) < 1e-9
    assert one(qt.exact_median(df.filter("1 = 0"), "v"))["median"] is None


def test_running_sums_match_a_global_window(spark, monkeypatch):
    monkeypatch.setattr(qt, "CELLS", 8)
    rng = np.random.default_rng(5)
    values = sorted({float(v) for v in np.concatenate([rng.normal(size=300), 1e-9 * rng.normal(size=300), [1e12]])})
    rows = [(None, 4)] + [(v, int(rng.integers(0, 9))) for v in values]
    got = {r["o"]: (r["n_below"], r["n_total"]) for r in qt.running_sums(spark.createDataFrame(rows, "o double, n long"), "o", ["n"]).collect()}
    below, total = 0, sum(n for _, n in rows)
    for o, n in rows:
        assert got[o] == (below, total)
        below += n


def test_rank_metrics_match_brute_force_with_null_scores(spark):
    rng = np.random.default_rng(6)
    rows = [(int(rng.random() < 0.4), None if rng.random() < 0.1 else float(rng.integers(0, 12)) / 10) for _ in range(400)]
    got = one(met.rank_metrics(spark.createDataFrame(rows, "label int, score double")))
    key = [(y, -1.0 if s is None else s) for y, s in rows]
    pos, neg = [s for y, s in key if y], [s for y, s in key if not y]
    auc = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    ap = sum(sum(1 for p in pos if p == s) / len(pos) * sum(1 for p in pos if p >= s) / sum(1 for _, x in key if x >= s) for s in set(pos))
    assert abs(got["roc_auc"] - auc) < 1e-4 and abs(got["pr_auc"] - ap) < 1e-4


def test_metrics_hold_at_a_thousand_million_rows_a_class(spark):
    """Counts of 10**9 rows a class, as the table of distinct scores would hold them."""
    big = 10**9
    counts = spark.createDataFrame([(big, 3 * big, 2 * big, big)], "tp long, fp long, tn long, fn long")
    r = one(met.with_rates(counts))
    assert (r["precision"], r["recall"], r["n_total"]) == (0.25, 0.5, 7 * big)
    pair = spark.createDataFrame([(str(3 * big * 2 * big * 2), str(2 * 4 * big * 2 * big))], "a string, b string")
    assert one(pair.select(met.ratio4(F.col("a").cast("decimal(33,0)"), F.col("b").cast("decimal(33,0)")).alias("r")))["r"] == 0.75
    scores = spark.createDataFrame([(0.2, 0, 2 * big), (0.5, 3 * big, big), (0.9, big, 0)], "_s double, pos long, neg long")
    table = qt.running_sums(scores, "_s", ["pos", "neg"])
    u2 = F.sum(F.col("pos").cast("decimal(18,0)") * (2 * F.col("neg_below") + F.col("neg")).cast("decimal(19,0)"))
    assert int(one(table.agg(u2.alias("u")))["u"]) == 3 * big * 5 * big + big * 6 * big


LAZY = ["p1_filter_scope_user", "p2_drop_insufficient_history_user", "p3_p5_preprocess_metadata_user", "p4_merge_metadata_user", "p6_dataset_summary_user",
        "u4_u5_dedupe_universe", "w1_windows_brand", "w3_candidate_windows_brand", "v3_v4_rank_metrics_events", "v6_threshold_sweep_events",
        "v7_optimal_threshold_events", "v8_holdout_report_events", "e4_median_trajectory_user", "e7_quantile_band_user", "e16_score_separation_lineitem"]


@pytest.mark.parametrize("name", LAZY)
def test_no_spark_job_runs_while_the_plan_is_built(spark, name):
    sc = spark.sparkContext
    # listing a Parquet table reads its footer in a job; do that first
    catalog.QUERIES[name](spark, SF_SMALL)
    for t in ("events", "lineitem", "part", "customer", "nation", "region", "supplier"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").createOrReplaceTempView(f"seen_{t}")
    read, group = type(spark.read).parquet, f"build-{uuid.uuid4().hex}"
    seen = lambda self, *paths, **kw: spark.table("seen_" + paths[0].rsplit("/", 1)[1].removesuffix(".parquet"))
    try:
        type(spark.read).parquet = seen
        sc.setJobGroup(group, "plan")
        df = catalog.QUERIES[name](spark, SF_SMALL)
        assert list(sc.statusTracker().getJobIdsForGroup(group)) == []
        assert df.columns
    finally:
        type(spark.read).parquet = read
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_no_group_of_raw_rows_is_collected_for_a_quantile(spark):
    """The exact percentile is only taken over counted values."""
    plan = catalog.QUERIES["e4_median_trajectory_user"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.splitlines():
        if " percentile(" in line:
            assert "_c#" in line


def test_shared_storage_is_required_outside_a_single_process(spark, monkeypatch):
    from surveil import session

    class Conf:
        def get(self, name, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_quantiles_and_weights_by_few_groups_shuffle_no_rows_by_group(spark):
    """A join on a label of two values would bring half of all rows into one task."""
    from surveil.operators import model as md

    rows = spark.range(1000).select(F.expr("IF(id % 7 = 0, NULL, id % 2)").alias("label"), (F.col("id") % 90).cast("double").alias("v"))
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    try:
        spark.conf.set(threshold, "-1")  # as if the tables were too large to broadcast by their size
        for out in (qt.exact_median(rows, "v", ["label"]), md.class_weights(rows.select("label"))):
            assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(threshold, before)


def test_windows_of_d_dates_are_broadcast_once_whatever_the_shuffle_partitions(spark):
    """Repeated for salts, the windows of 18,000 D-dates and 600 partitions were 50 million rows in the driver."""
    import datetime as dt

    from surveil.operators import windows as win

    day = dt.date(2024, 1, 1)
    bars = spark.createDataFrame([(t, day + dt.timedelta(days=i), 1.0) for t in "ABC" for i in range(90)], "ticker string, date date, close double")
    dates = spark.createDataFrame([(day + dt.timedelta(days=i),) for i in (60, 75, 90)], "d_date date")
    names = ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    before = {n: spark.conf.get(n) for n in names}
    rows = []
    try:
        for n, v in zip(names, ("5", "-1", "false")):
            spark.conf.set(n, v)
        for salts in ("5", "50"):
            spark.conf.set(names[0], salts)
            df = win.candidate_windows(bars, bars.select("ticker"), dates, lookback_bars=20)
            plan = df._jdf.queryExecution().executedPlan()
            assert "BroadcastHashJoin [_bucket" in plan.toString()
            broadcast = [n for n in _nodes(plan) if n.nodeName() == "BroadcastExchange"]
            assert len(df.collect()) == 3 * 3 * 20
            rows.append([n.metrics().apply("numOutputRows").value() for n in broadcast])
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)
    assert rows[0] == rows[1] and len(rows[0]) == 1 and rows[0][0] <= 3 * 7


def _nodes(plan):
    yield plan
    children = plan.children()
    for i in range(children.size()):
        yield from _nodes(children.apply(i))
