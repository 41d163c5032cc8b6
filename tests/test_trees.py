"""Trees of many groups in one job, pools of the best candidates, and grids in one run."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from surveil.operators import matching as mt
from surveil.operators import model as md
from surveil.operators import trees as tr

SCHEMA = "g int, label int, v array<double>"


def plain_tree(x, y, depth, min_leaf, criterion):
    """CART with plain loops: leaves as (rows, P(1)); thresholds between distinct values of all rows."""
    n = len(y)
    w = [n / (2.0 * max((y == c).sum(), 1)) for c in (0, 1)]

    def impurity(rows):
        a, b = w[0] * (y[rows] == 0).sum(), w[1] * (y[rows] == 1).sum()
        p = b / (a + b)
        return (a + b), (2 * p * (1 - p) if criterion == "gini" else -sum(q * np.log2(q) for q in (p, 1 - p) if q > 0))

    def grow(rows, d):
        total, here = impurity(rows)
        best = (1e-12, None)
        if d < depth and len(set(y[rows])) == 2:
            for f in range(x.shape[1]):
                for t in sorted(set(x[rows, f]))[:-1]:
                    left, right = rows[x[rows, f] <= t], rows[x[rows, f] > t]
                    if min(len(left), len(right)) < min_leaf:
                        continue
                    (wl, il), (wr, ir) = impurity(left), impurity(right)
                    gain = round(here - wl / total * il - wr / total * ir, 12)
                    if gain > best[0]:
                        best = (gain, (left, right))
        if best[1] is None:
            a, b = w[0] * (y[rows] == 0).sum(), w[1] * (y[rows] == 1).sum()
            return [(set(rows.tolist()), b / (a + b))]
        return grow(best[1][0], d + 1) + grow(best[1][1], d + 1)

    return grow(np.arange(n), 0)


@pytest.mark.parametrize("criterion", ["gini", "entropy"])
def test_grouped_trees_are_those_grown_one_by_one(spark, criterion):
    rng = np.random.default_rng(7)
    data = {}
    for g, n in ((0, 60), (1, 151), (2, 40), (3, 20)):
        x = np.round(rng.normal(size=(n, 4)), 1)
        y = (x[:, 1] + 0.5 * x[:, 2] + rng.normal(0, 0.7, n) > 0.4).astype(int)
        data[g] = (x, y if g < 3 else np.ones(n, dtype=int))  # the last has one class
    rows = [(g, int(b), a.tolist()) for g, (x, y) in data.items() for a, b in zip(x, y)]
    table = md.cut_lineage(spark.createDataFrame(rows, SCHEMA).repartition(5))
    trees = tr.fit_trees(table, ["g"], "v", max_depth=3, min_leaf=4, criterion=criterion)
    assert set(trees) == {(g,) for g in data}
    for g, (x, y) in data.items():
        nodes = trees[(g,)].rows()

        def leaf(v):
            at = nodes[0]
            while at[1] >= 0:
                at = nodes[at[3] if v[at[1]] <= at[2] else at[4]]
            return at

        want = {i: p for members, p in plain_tree(x, y, 3, 4, criterion) for i in members}
        assert all(abs(leaf(v)[6] - want[i]) < 1e-12 for i, v in enumerate(x)), g
        assert len({leaf(v)[0] for v in x}) == len({id(m) for m, _ in [(tuple(s), p) for s, p in plain_tree(x, y, 3, 4, criterion)]})


def test_quantile_bins_and_empty_input(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 2))
    table = md.cut_lineage(spark.createDataFrame([(0, int(a[0] > 0.5), a.tolist()) for a in x], SCHEMA))
    edges = tr.bin_edges(table, "v", 32)
    assert all(len(e) <= 31 and (np.diff(e) > 0).all() for e in edges)
    root = tr.fit_trees(table, ["g"], "v", max_depth=2, min_leaf=5, max_bins=32)[(0,)].nodes[0]
    assert root.feature == 0 and abs(root.threshold - 0.5) < 0.3
    assert tr.fit_trees(table.filter("g = 9"), ["g"]) == {}


def _points(spark):
    rng = np.random.default_rng(12)
    dates = [dt.date(2020, 1, 1) + dt.timedelta(days=30 * i) for i in range(4)]
    rows = [(f"P{k}", dates[k % 4], 1, *map(float, rng.normal(1, 1, 2))) for k in range(8)]
    rows += [(f"N{k}", d, 0, *map(float, np.round(rng.normal(0, 2, 2)))) for k in range(150) for d in dates]  # many ties
    return spark.createDataFrame(rows, "ticker string, d_date date, label int, f1 double, f2 double").repartition(6)


@pytest.mark.parametrize("block_bytes", [None, 48])
def test_the_best_of_every_task_hold_the_selection(spark, monkeypatch, block_bytes):
    if block_bytes:
        monkeypatch.setattr(mt, "BLOCK_BYTES", block_bytes)  # the positives in three blocks
    f = _points(spark)
    tp, tn = f.filter("label = 1"), f.filter("label = 0")
    matched = md.match_folds(tp, tn, ["f1", "f2"], needs={"distance_ranked": 3, "random": 3, "stratified": 3})
    whole = matched.pool("stratified")
    assert whole.count() == 4 * 150 * 3  # a row per candidate and fold that does not hold it out
    tasks = matched.candidates.rdd.getNumPartitions()
    for method, select in (("distance_ranked", mt.sample_nearest), ("random", mt.sample_random)):
        pool = matched.pool(method)
        assert pool.count() <= tasks * 4 * 8 * 3
        picked = lambda p: sorted(map(str, select(p, 3, md.KEY, by=[md.FOLD]).collect()))  # noqa: B023, E731
        assert picked(pool) == picked(whole.select(*pool.columns)) != []


def test_a_grid_is_one_run_and_equals_its_settings(spark):
    f = _points(spark)
    tp, tn = f.filter("label = 1"), f.filter("label = 0")
    base = md.CVConfig(n_trees=5)
    grid = md.cut_lineage(md.grid_oof(tp, tn, ["f1", "f2"], ["distance_ranked", "stratified"], [2, 4], base))
    metrics = {(r["method"], r["ratio"]): r for r in md.compared(grid, ["method", "ratio"]).collect()}
    assert set(metrics) == {(m, r) for m in ("distance_ranked", "stratified") for r in (2, 4)}
    for (m, ratio), r in metrics.items():
        rows = grid.filter((F.col("method") == m) & (F.col("ratio") == ratio))
        assert r["n_rows"] == f.count() == rows.count() and r["n_positive"] == 8
        from surveil.operators.metrics import rank_metrics
        alone = rank_metrics(rows, "true_label", "pred_proba").first()
        assert (r["roc_auc"], r["pr_auc"]) == (alone["roc_auc"], alone["pr_auc"])
        assert 0.0 <= r["roc_auc"] <= 1.0


def test_a_plan_does_not_grow_with_the_settings_of_a_grid(spark, monkeypatch):
    """Every plan is held by the driver, as text and as a tree, each time it changes while it runs."""
    sizes, keep = [], md.cut_lineage

    def measured(df):
        sizes.append(len(df._jdf.queryExecution().optimizedPlan().toString()))
        return keep(df)

    monkeypatch.setattr(md, "cut_lineage", measured)
    monkeypatch.setattr(md.mt, "cut_lineage", measured)
    f = _points(spark)
    tp, tn = f.filter("label = 1"), f.filter("label = 0")
    base = md.CVConfig(n_trees=5, n_bins=2, min_leaf=1)
    largest = {}
    for ratios in ([2], [2, 3, 4]):
        sizes.clear()
        cfgs = {f"stratified/{r}": md.replace(base, method="stratified", ratio=r) for r in ratios}
        md.fit_folds(md.match_folds(tp, tn, ["f1", "f2"], needs=md.needed(cfgs)), cfgs, grow=False)
        largest[len(cfgs)] = max(sizes)
    assert largest[3] < 1.5 * largest[1]


def test_statistics_of_bounded_groups_are_the_distributed_ones(spark, monkeypatch):
    rng = np.random.default_rng(21)
    rows = []
    for g, n in (("a", 1), ("b", 2), ("c", 57), ("d", 200)):
        x = np.round(rng.normal(size=(n, 7)) * 10.0 ** rng.integers(-3, 6, 7), 3)
        x[rng.random(x.shape) < 0.3] = np.nan
        x[:, 2], x[:, 5] = 4.25, np.nan  # no spread, no values
        rows += [(g, [None if v != v else float(v) for v in row]) for row in x]
    df = spark.createDataFrame(rows, "g string, x array<double>").repartition(5)
    want = {r["g"]: r["stats"] for r in md.keyed_stats(df, ["g"]).collect()}
    for features in (64, 3):
        monkeypatch.setattr(md, "FEATURES_PER_TASK", features)
        got = {r["g"]: r["stats"] for r in md.bounded_stats(df, ["g"]).collect()}
        assert got == want and all(s["i"] != 5 for r in got.values() for s in r)


def test_vectors_of_a_group_move_once_for_all_trees(spark, monkeypatch):
    """They moved once a tree: 100 times the vectors of every fold."""
    from surveil.operators import forest as fr

    rng = np.random.default_rng(22)
    rows = [(g, f"{g}{k}", rng.normal(size=3).tolist()) for g, n in (("a", 90), ("b", 700)) for k in range(n)]
    df = spark.createDataFrame(rows, "g string, id string, z array<double>").repartition(4)
    drawn = fr._drawn(df, ["id"], "z", 40, 64, 5, ["g"])
    moved = {r["g"]: r["count"] for r in drawn.groupBy("g").count().collect()}
    assert moved["a"] == 90 and moved["b"] <= min(fr.TREE_BLOCKS * 700, 40 * (2 * 64 + 64) * 2)
    # the rows that tree_samples draws, tree by tree, grown in the order of their keys
    nodes = {}
    for r in fr.fit_forest(df, ["id"], "z", 40, 64, 5, ["g"]).collect():
        nodes.setdefault((r["g"], r["tree_id"]), []).append((r["node"], r["feature"], r["threshold"], r["left"], r["right"], r["size"]))
    samples = {}
    for r in fr.tree_samples(df, ["id"], "z", 40, 64, 5, ["g"]).collect():
        samples.setdefault((r["g"], r["tree_id"]), []).append((r["id"], r["z"]))
    import zlib

    assert set(nodes) == set(samples) and len(nodes) == 80
    for (g, t), rows in samples.items():
        x = np.array([z for _, z in sorted(rows)])
        want = fr.grow_tree(x, np.random.default_rng([5, t, zlib.crc32(g.encode())]), int(np.ceil(np.log2(len(x)))))
        assert sorted(nodes[(g, t)]) == sorted(want)


def test_many_rows_get_the_scores_of_few(spark, monkeypatch):
    from surveil.operators import forest as fr

    rng = np.random.default_rng(23)
    df = spark.createDataFrame([(k, rng.normal(size=4).tolist()) for k in range(300)], "id int, z array<double>")
    trees = fr.fit_trees(df, ["id"], "z", 20, 64, 5)
    forest = fr.Forest.from_trees(trees.toPandas())
    same = fr.Forest.from_nodes(fr.node_rows(trees).toPandas())
    x = rng.normal(size=(500, 4)) * 3
    x[::7, 1] = np.nan
    few = forest.score(x)
    monkeypatch.setattr(fr, "MANY_ROWS", 1)
    assert (forest.score(x) == few).all() and (same.score(x) == few).all()


def test_a_row_meets_the_models_of_all_settings_once(spark, monkeypatch):
    """It was staged and shuffled once a setting, scaled and filled: twice its vector each time."""
    f = _points(spark)
    tp, tn = f.filter("label = 1"), f.filter("label = 0")
    met_, keep = [], md.fr.with_group_models

    def counted(rows, models, by, key, fn, schema):
        met_.append((list(by), rows.count(), [c for c, kind in rows.dtypes if kind == "array<double>"]))
        return keep(rows, models, by, key, fn, schema)

    monkeypatch.setattr(md.fr, "with_group_models", counted)
    base = md.CVConfig(n_trees=5)
    cfgs = {f"{m}/{r}": md.replace(base, method=m, ratio=r) for m in ("distance_ranked", "random") for r in (2, 3)}
    oof = md.cross_validate_all(tp, tn, ["f1", "f2"], cfgs)
    assert met_[-1] == ([md.FOLD], f.count(), ["x"])
    assert oof.count() == 4 * f.count() == oof.select("config", "ticker", "d_date").distinct().count()


def test_stratified_bins_are_computed_once(spark, monkeypatch):
    """Two plans use the bins; each computed the quantiles of the whole pool again."""
    staged, keep = [], mt.cut_lineage
    monkeypatch.setattr(mt, "cut_lineage", lambda df: staged.append(df.columns) or keep(df))
    rng = np.random.default_rng(31)
    pool = spark.createDataFrame([(f"N{k}", k % 3, float(d)) for k, d in enumerate(rng.random(120))], "ticker string, centroid_idx int, distance double")
    got = mt.sample_stratified(pool, 5, ["ticker"])
    assert [c for c in staged if "_edges" in c] == [["centroid_idx", "_edges"]]
    assert got.groupBy("centroid_idx").count().collect().__len__() == 3 and got.count() == 15
