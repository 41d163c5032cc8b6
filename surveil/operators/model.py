"""M4–M12 — class weights, decision tree, leave-one-D-date-out CV, final model, scoring.

Every fold leaves out one D-date; the final model is the fold that leaves out
nothing, trained by the same code.

* Matching keeps one row per candidate: the positives and the folds' scaler
  statistics are broadcast in bounded blocks; a task measures its candidates
  against every fold and keeps only the best ``ratio`` of each (fold, centroid),
  so at most tasks x folds x centroids x ratio rows are staged.  Stratified
  selection needs the quantiles of all distances, hence a row per candidate and fold.
* Vectors are fetched for the selected keys alone (at most cases x ratio a fold).
* Statistics, forests, scores and trees of all folds, and of all settings of a
  grid, come from single jobs grouped by (config, fold): their number does not
  depend on either.  The final tree is MLlib's.
* A test row belongs to one fold, that of its own D-date; it meets that fold's
  forest and tree in a cogroup, split by a salt.
"""

from __future__ import annotations

import datetime as dt
import json
import os
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveil.functions.constants import (
    DEFAULT_FN_COST,
    DEFAULT_FP_COST,
    FOREST_MAX_SAMPLES,
    FOREST_TREES,
    MATCH_BINS,
    RANDOM_STATE,
    TN_TP_RATIO,
    TREE_MAX_DEPTH,
    TREE_MIN_LEAF,
)
from surveil.operators import forest as fr
from surveil.operators import matching as mt
from surveil.operators import trees as tr
from surveil.session import cut_lineage, ship_package

KEY = ["ticker", "d_date"]
FOLD = "fold"
CONFIG = "config"
#: What a model is fitted for.
GROUP = [CONFIG, FOLD]
#: The fold that leaves out nothing: the final model.
ALL = dt.date(1000, 1, 1)
#: Folds whose scaler statistics travel in one broadcast.
FOLDS_PER_BLOCK = 512
#: Features of a group whose statistics one task computes.
FEATURES_PER_TASK = 64
#: Candidates that a task scales at a time; their vectors stay in a core's cache.
TILE_ROWS = 512
#: So many selected keys are broadcast to fetch their vectors; more are joined by a shuffle.
BROADCAST_KEYS = 200_000
#: Lookbacks that are cross-validated beside each other.
LOOKBACKS_AT_ONCE = 3
#: ``tree_id`` of what is not a tree of a forest in a table of models.
DECISION_TREE, SCORER, FILL = -1, -2, -3
#: Rows that a task scores at a time.
SCORED_ROWS = 5_000


# ---------------------------------------------------------------------------
# M4 — balanced class weights
# ---------------------------------------------------------------------------


def class_weights(df: DataFrame, label: str = "label", by: Sequence[str] = (), out: str = "weight") -> DataFrame:
    """M4: ``n / (2 · n_class)`` per row (per group when ``by`` is given).

    The class counts (a row per class and group) are joined back; no window over the rows.
    Without groups they are broadcast: a join on the label alone would bring a class into one task.
    """
    by = list(by)
    counts = df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("_nc"))
    totals = counts.groupBy(*by).agg(F.sum("_nc").alias("_n"))
    weights = mt.join_groups(counts, totals, by).select(*by, label, (F.col("_n") / (F.lit(2.0) * F.col("_nc"))).alias(out))
    return mt.join_groups(df, weights if by else F.broadcast(weights), [*by, label])


# ---------------------------------------------------------------------------
# keyed statistics (C0–C2 per group) applied with a join on the group
# ---------------------------------------------------------------------------


def keyed_stats(df: DataFrame, by: Sequence[str], vec: str = "x") -> DataFrame:
    """One row per group: ``stats`` = sorted array of ``(i, median, center, scale)`` over non-all-NULL features."""
    return _packed_stats(df.select(*by, F.posexplode(F.col(vec)).alias("i", "v")), by)


def _packed_stats(long: DataFrame, by: Sequence[str]) -> DataFrame:
    by = list(by)
    st = mt.usable_features(mt.long_stats(long, by, staged=True))
    iqr = F.col("q75") - F.col("q25")
    entry = F.struct("i", "median", "center", F.when(iqr == 0, F.lit(1.0)).otherwise(iqr).alias("scale"))
    return st.groupBy(*by).agg(F.array_sort(F.collect_list(entry)).alias("stats"))


def _percentile(ordered: np.ndarray, counts: np.ndarray, q: float) -> np.ndarray:
    """Spark's ``percentile`` of every column: the first ``counts`` values of each are ascending."""
    position = (counts - 1) * q
    low, high = np.floor(position).astype(np.int64), np.ceil(position).astype(np.int64)
    at = np.arange(ordered.shape[1])
    a, b = ordered[low, at], ordered[high, at]
    return np.where(a == b, a, (high - position) * a + (position - low) * b)


def bounded_stats(df: DataFrame, by: Sequence[str], vec: str = "x") -> DataFrame:
    """``keyed_stats`` of groups of bounded size (positives, and candidates matched to them): the same table.

    The features of a group are dealt to tasks in blocks, so a task holds ``FEATURES_PER_TASK`` numbers a row, and
    a row moves once instead of as a row a feature in every step.
    """
    by = list(by)
    ship_package(df.sparkSession)
    step = FEATURES_PER_TASK
    starts = F.sequence(F.lit(0), F.size(vec) - 1, F.lit(step))
    cut = F.transform(starts, lambda i: F.struct(i.alias("first"), F.slice(vec, i + 1, step).alias("v")))
    parts = df.filter(F.size(vec) > 0).select(*by, F.explode(cut).alias("_c")).select(*by, "_c.first", "_c.v")
    schema = T.StructType([*[df.schema[c] for c in by], *[T.StructField("i", T.IntegerType())],
                           *[T.StructField(c, T.DoubleType()) for c in ("median", "center", "scale")]])

    def fitted(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(pdf["v"].to_numpy()).astype(float)
        counts = (~np.isnan(x)).sum(axis=0)
        kept = np.flatnonzero(counts)
        x = x[:, kept]
        median = _percentile(np.sort(x, axis=0), counts[kept], 0.5)  # NULLs come as NaN and sort last
        x = np.sort(np.where(np.isnan(x), median, x), axis=0)
        low, center, high = (_percentile(x, np.full(len(kept), len(x)), q) for q in (0.25, 0.5, 0.75))
        rows = pd.DataFrame({"i": int(pdf["first"].iloc[0]) + kept, "median": median, "center": center,
                             "scale": np.where(high - low == 0, 1.0, high - low)})
        for c in by:
            rows[c] = pdf[c].iloc[0]
        return rows[[f.name for f in schema.fields]]

    st = parts.groupBy(*by, "first").applyInPandas(fitted, schema)
    return st.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("i", "median", "center", "scale"))).alias("stats"))


def keyed_scale(df: DataFrame, stats: DataFrame, by: Sequence[str], vec: str = "x", out: str = "z",
                scale: bool = True) -> DataFrame:
    """Impute (and robust-scale) ``vec`` with the statistics of the row's group (a row per group)."""
    j = df.join(stats, list(by))
    if scale:
        z = F.transform(F.col("stats"), lambda s: (F.coalesce(F.col(vec)[s["i"]], s["median"]) - s["center"]) / s["scale"])
    else:
        z = F.transform(F.col("stats"), lambda s: F.coalesce(F.col(vec)[s["i"]], s["median"]))
    return j.withColumn(out, z).drop("stats")


def keyed_fill(df: DataFrame, stats: DataFrame, by: Sequence[str], width: int, vec: str = "x", out: str = "v") -> DataFrame:
    """Impute ``vec`` with the medians of the row's group, places kept; features without values in training become 0."""
    median = lambda i: F.get(F.filter("stats", lambda s: s["i"] == i), F.lit(0))["median"]
    wide = stats.select(*by, F.transform(F.sequence(F.lit(0), F.lit(width - 1)), median).alias("_medians"))
    filled = F.zip_with(vec, "_medians", lambda v, m: F.coalesce(v, m, F.lit(0.0)))
    return df.join(wide, list(by)).withColumn(out, filled).drop("_medians")


# ---------------------------------------------------------------------------
# M9 — folds
# ---------------------------------------------------------------------------


def fold_dates(positives: DataFrame, group: str = "d_date") -> list:
    """Distinct D-dates of the positives (one fold each; bounded by the number of cases)."""
    return sorted(r[0] for r in positives.select(group).distinct().collect())


def leave_one_group_out(df: DataFrame, folds: Sequence, group: str = "d_date") -> DataFrame:
    """M9: every row once per fold with ``role`` = ``test`` when its group is the held-out one.

    Meant for keys; feature vectors are fetched for the rows that a fold needs.
    """
    arr = F.array(*[F.lit(f) for f in folds])
    return df.withColumn(FOLD, F.explode(arr)).withColumn(
        "role", F.when(F.col(group) == F.col(FOLD), F.lit("test")).otherwise(F.lit("train"))
    )


# ---------------------------------------------------------------------------
# M5–M8 — decision tree
# ---------------------------------------------------------------------------


def _tree(max_depth: int, min_leaf: int, criterion: str, seed: int, max_bins: int) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(
        featuresCol="features", labelCol="label", weightCol="weight", maxDepth=max_depth,
        minInstancesPerNode=min_leaf, impurity=criterion, seed=seed, maxBins=max_bins,
    )


def fit_tree(train: DataFrame, vec: str = "v", max_depth: int = TREE_MAX_DEPTH, min_leaf: int = TREE_MIN_LEAF,
             criterion: str = "gini", seed: int = RANDOM_STATE, n_rows: int | None = None) -> DecisionTreeClassificationModel:
    """M5: balanced-weight MLlib decision tree on an ``array<double>`` feature column (no NULLs).

    There are as many bins as training rows, so every distinct value is a possible split.
    """
    data = class_weights(train).select(array_to_vector(F.col(vec)).alias("features"),
                                       F.col("label").cast("double").alias("label"), "weight")
    n_rows = train.count() if n_rows is None else n_rows
    return _tree(max_depth, min_leaf, criterion, seed, max(32, n_rows + 1)).fit(data)


def predict_proba(model: DecisionTreeClassificationModel, df: DataFrame, vec: str = "v", out: str = "pred_proba") -> DataFrame:
    """M6: P(class 1) and the predicted class."""
    scored = model.transform(df.withColumn("features", array_to_vector(F.col(vec))))
    return scored.withColumn(out, vector_to_array("probability")[1]).withColumn(
        "pred_label", F.col("prediction").cast("int")).drop("features", "rawPrediction", "probability", "prediction")


def feature_importances(spark: SparkSession, model: DecisionTreeClassificationModel, names: Sequence[str],
                        top: int | None = None) -> DataFrame:
    """M7: importances sorted descending (``top`` keeps the first n — a top-k report).

    ``names`` are those of the vector the tree was fitted to, see ``FinalModel.tree_features``.
    """
    imp = model.featureImportances.toArray().tolist()
    if len(imp) != len(names):
        raise ValueError(f"the tree has {len(imp)} features, {len(names)} names were given")
    df = spark.createDataFrame([(n, float(v)) for n, v in zip(names, imp)], "feature string, importance double")
    df = df.orderBy(F.desc("importance"), "feature")
    return df.limit(top) if top else df


def _tree_nodes(model: DecisionTreeClassificationModel) -> list[tuple[int, int, float, int, int, float, float]]:
    """``(node, feature, threshold, left, right, weight, p_positive)`` in pre-order; feature -1 is a leaf."""
    rows: list = []

    def walk(node) -> int:
        here = len(rows)
        rows.append(None)
        stats = list(node.impurityStats().stats())
        total = sum(stats)
        share = float(stats[1] / total) if total and len(stats) > 1 else 0.0
        if node.getClass().getSimpleName() == "InternalNode":
            split = node.split()
            left, right = walk(node.leftChild()), walk(node.rightChild())
            rows[here] = (here, int(split.featureIndex()), float(split.threshold()), left, right, float(total), share)
        else:
            rows[here] = (here, -1, 0.0, -1, -1, float(total), share)
        return here

    walk(model._java_obj.rootNode())
    return rows


def tree_rules(spark: SparkSession, model: DecisionTreeClassificationModel, names: Sequence[str],
               fill: Sequence[float] | None = None) -> DataFrame:
    """M8: one row per leaf — the SQL predicate that reaches it, its weight and P(1).

    The tree was trained on filled values: with ``fill`` (the medians) a rule can
    be run on raw columns, where a NULL goes the way its median goes.
    """
    nodes = _tree_nodes(model)
    column = lambda f: f"`{names[f]}`" if fill is None else f"coalesce(`{names[f]}`, {float(fill[f])!r}D)"
    rows = []

    def walk(at: int, conds: list[str]) -> None:
        _, f, threshold, left, right, weight, p = nodes[at]
        if f < 0:
            rows.append((" AND ".join(conds) or "TRUE", weight, p, float(p > 0.5)))
        else:
            walk(left, [*conds, f"{column(f)} <= {threshold!r}D"])
            walk(right, [*conds, f"{column(f)} > {threshold!r}D"])

    walk(0, [])
    return spark.createDataFrame(rows, "rule string, weight double, p_positive double, prediction double")


# ---------------------------------------------------------------------------
# M10 / M11 / M12 — cross-validation, final fit, scoring
# ---------------------------------------------------------------------------


@dataclass
class CVConfig:
    method: str = "distance_ranked"
    ratio: int = TN_TP_RATIO
    n_bins: int = MATCH_BINS
    n_trees: int = FOREST_TREES
    max_samples: int = FOREST_MAX_SAMPLES
    max_depth: int = TREE_MAX_DEPTH
    min_leaf: int = TREE_MIN_LEAF
    criterion: str = "gini"
    seed: int = RANDOM_STATE
    baseline: str = "selected"


def _select(pool: DataFrame, cfg: CVConfig) -> DataFrame:
    if cfg.method == "random":
        return mt.sample_random(pool, cfg.ratio, KEY, cfg.seed, by=[FOLD])
    if cfg.method == "distance_ranked":
        return mt.sample_nearest(pool, cfg.ratio, KEY, by=[FOLD])
    if cfg.method == "stratified":
        return mt.sample_stratified(pool, cfg.ratio, KEY, cfg.n_bins, cfg.seed, by=[FOLD])
    raise ValueError(f"unknown method {cfg.method!r}")


@dataclass
class Matched:
    """Vectors of both classes and the distance pools of every fold (all staged tables)."""

    positives: DataFrame  # ticker, d_date, label, x
    candidates: DataFrame
    folds: list
    pools: DataFrame      # method, fold, ticker, d_date, centroid_idx, distance
    width: int            # features of a vector

    def pool(self, method: str) -> DataFrame:
        """What ``method`` selects from: the best candidates of every task, or all of them for stratified selection."""
        return self.pools.filter(F.col("method") == method).drop("method")


def stage_vectors(tp: DataFrame, tn: DataFrame, feature_cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``ticker, d_date, label, x`` of both classes, staged as every step reads them again."""
    vectors = lambda df, label: cut_lineage(mt.as_vector(df, list(feature_cols)).select(*KEY, F.lit(label).alias("label"), "x"))
    return vectors(tp, 1), vectors(tn, 0)


def match_folds(tp: DataFrame, tn: DataFrame, feature_cols: Sequence[str], folds: Sequence | None = None,
                needs: dict[str, int] | None = None, seed: int = RANDOM_STATE, staged: tuple[DataFrame, DataFrame] | None = None) -> Matched:
    """C0–C3 for every fold.  ``needs``: the methods and the greatest ratio that each will be asked for; ``staged``: the vectors, if they are."""
    cols = list(feature_cols)
    needs = needs or {"distance_ranked": TN_TP_RATIO}
    ship_package(tp.sparkSession)
    tpv, tnv = staged or stage_vectors(tp, tn, cols)
    folds = fold_dates(tpv) if folds is None else list(folds)
    # statistics of each fold's positives, from narrow rows
    held = F.broadcast(tp.sparkSession.createDataFrame([(f,) for f in folds], f"{FOLD} date"))
    trained = tpv.join(held, ~F.col(FOLD).eqNullSafe(F.col("d_date")))
    stats = cut_lineage(bounded_stats(trained, [FOLD]))
    ranked = mt.index_centroids(tpv, KEY)
    shape = ranked.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    n_blocks = -(-int(shape[0]) * int(shape[1] or 1) * 8 // mt.BLOCK_BYTES)
    blocks = []
    for b in range(n_blocks):
        rows = ranked.filter(F.pmod("centroid_idx", F.lit(n_blocks)) == b).orderBy("centroid_idx").collect()
        matrix = np.array([[np.nan if v is None else v for v in r["x"]] for r in rows], dtype=float)
        blocks.append(tp.sparkSession.sparkContext.broadcast((np.array([r["d_date"] for r in rows], dtype=object),
                                                              np.array([r["centroid_idx"] for r in rows]), matrix)))
    schema = "method string, fold date, ticker string, d_date date, d2 double, centroid_idx int"
    pools = tp.sparkSession.createDataFrame([], schema)
    given = tnv.withColumn("_hash", mt.hash_order(KEY, seed))
    for i in range(0, len(folds), FOLDS_PER_BLOCK):
        some = stats.filter(F.col(FOLD).isin(folds[i:i + FOLDS_PER_BLOCK])).collect()
        scalers = [(r[FOLD], *(np.array([s[c] for s in r["stats"]]) for c in ("i", "median", "center", "scale"))) for r in some]
        pools = pools.unionByName(given.mapInPandas(_fold_pools(tp.sparkSession.sparkContext.broadcast(scalers), blocks, needs), schema))
    pools = cut_lineage(pools.select("method", FOLD, *KEY, "centroid_idx", F.sqrt("d2").alias("distance")))
    return Matched(tpv, tnv, folds, pools, len(cols))


class _Best:
    """The first ``k`` rows of every centroid by some order, of all rows offered so far."""

    def __init__(self, k: int):
        self.k, self.rows, self.full = k, pd.DataFrame(), {}

    def offer(self, rows: pd.DataFrame) -> None:
        """``rows`` have ``centroid_idx`` and the order ``_o1``, ``ticker``, ``d_date``; those behind k others go at once."""
        if self.full:
            bound = rows["centroid_idx"].map(self.full)
            rows = rows[bound.isna() | ~(rows["_o1"] > bound)]
        if len(rows):
            rows = pd.concat([self.rows, rows]) if len(self.rows) else rows
            rows = rows.sort_values(["centroid_idx", "_o1", "ticker", "d_date"], kind="stable")
            self.rows = rows.groupby("centroid_idx", sort=False).head(self.k)
            last = self.rows.groupby("centroid_idx")["_o1"].agg(["size", "max"])
            self.full = last["max"][last["size"] == self.k].to_dict()


def _fold_pools(scalers, blocks, needs):
    """A task's candidates with the closest positive of every fold that does not hold them out, as far as a method needs them."""
    def pooled(batches):
        best: dict[tuple, _Best] = {}
        for pdf in batches:
            if not len(pdf):
                continue
            x = np.stack([np.asarray(v, dtype=float) for v in pdf["x"]])
            own = pdf["d_date"].to_numpy()
            for fold, i, median, center, scale in scalers.value:
                rows = np.flatnonzero(own != fold)
                scaled = lambda m: (np.where(np.isnan(m[:, i]), median, m[:, i]) - center) / scale  # noqa: B023, E731
                d2, idx = np.full(len(rows), np.inf), np.full(len(rows), -1, dtype=np.int64)
                for block in blocks if len(rows) else ():
                    dates, names, matrix = block.value
                    cents = np.flatnonzero(dates != fold)
                    if not len(cents):
                        continue
                    centroids = scaled(matrix[cents])
                    for tile in (slice(a, a + TILE_ROWS) for a in range(0, len(rows), TILE_ROWS)):
                        got, at = mt.nearest(scaled(x[rows[tile]]), centroids)
                        got_idx = names[cents][at]
                        closer = (got < d2[tile]) | ((got == d2[tile]) & (got_idx < idx[tile]))
                        d2[tile], idx[tile] = np.where(closer, got, d2[tile]), np.where(closer, got_idx, idx[tile])
                rows, d2, idx = rows[idx >= 0], d2[idx >= 0], idx[idx >= 0]
                if not len(rows):
                    continue
                found = pd.DataFrame({FOLD: fold, "ticker": pdf["ticker"].to_numpy()[rows], "d_date": own[rows], "d2": d2, "centroid_idx": idx})
                for method, k in needs.items():
                    if method == "stratified":
                        yield found.assign(method=method)[["method", FOLD, *KEY, "d2", "centroid_idx"]]
                        continue
                    order = np.sqrt(d2) if method == "distance_ranked" else pdf["_hash"].to_numpy()[rows]
                    best.setdefault((method, fold), _Best(k)).offer(found.assign(_o1=order))
        for (method, _), kept in best.items():
            if len(kept.rows):
                yield kept.rows.assign(method=method)[["method", FOLD, *KEY, "d2", "centroid_idx"]]

    return pooled


@dataclass
class FoldModels:
    """Fitted tables keyed by (config, fold): scaler of the anomaly score, medians of the tree, forests (a row a tree); training rows; trees."""

    scorer: DataFrame
    fill: DataFrame
    forests: DataFrame
    width: int = 0
    training: DataFrame | None = None
    trees: dict[tuple, tr.Tree] = field(default_factory=dict)


def fit_folds(matched: Matched, cfgs: dict[str, CVConfig], grow: bool = True) -> FoldModels:
    """C4–C12, M1–M5 for every setting and fold: select, fit the scorer, score the training rows, grow the trees.

    Settings may differ in method, ratio and bins; forests and trees are sized by the first.
    """
    cfg = next(iter(cfgs.values()))
    # a plan a setting: the driver would hold one of them all in memory, many times over while it runs
    keys = [cut_lineage(_select(matched.pool(c.method), c).select(F.lit(name).alias(CONFIG), FOLD, *KEY)) for name, c in cfgs.items()]
    keys = reduce(DataFrame.unionByName, keys)
    keys = F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys.hint("merge")  # files are much smaller than their rows in memory
    selected = cut_lineage(keys.join(matched.candidates, KEY).select(*GROUP, *KEY, "label", "x"))
    present = sorted(map(tuple, selected.select(*GROUP).distinct().collect()))
    if not present:
        return FoldModels(selected, selected, selected)
    usable = F.broadcast(selected.sparkSession.createDataFrame(present, f"{CONFIG} string, {FOLD} date"))
    outside = lambda df: df.join(usable, ~F.col(FOLD).eqNullSafe(F.col("d_date"))).select(*GROUP, *KEY, "label", "x")
    base = selected if cfg.baseline == "selected" else outside(matched.candidates)
    scorer = cut_lineage(bounded_stats(base, GROUP) if cfg.baseline == "selected" else keyed_stats(base, GROUP))
    forests = cut_lineage(fr.fit_trees(keyed_scale(base, scorer, GROUP), KEY, "z", cfg.n_trees, cfg.max_samples, cfg.seed, by=GROUP))
    train = cut_lineage(outside(matched.positives).unionByName(selected))
    fill = cut_lineage(bounded_stats(train, GROUP))
    scaled = keyed_scale(train, scorer, GROUP)
    # trees of many folds share their features' places; the final tree sees those that had values
    filled = keyed_fill(scaled, fill, GROUP, matched.width) if grow else keyed_scale(scaled, fill, GROUP, "x", "v", scale=False)
    ready = cut_lineage(filled.drop("x"))
    scored = fr.score_forests(ready, forests, GROUP, KEY)
    training = cut_lineage(scored.select(*GROUP, *KEY, "label", F.concat("v", F.array(fr.SCORE_COL)).alias("v")))
    trees = tr.fit_trees(training, GROUP, "v", cfg.max_depth, cfg.min_leaf, cfg.criterion) if grow else {}
    return FoldModels(scorer, fill, forests, matched.width, training, trees)


_OOF = "config string, fold date, ticker string, d_date date, true_label int, pred_proba double"


def _model_rows(models: FoldModels) -> DataFrame:
    """All models as rows: trees of the forests, the decision trees, and two rows of statistics, marked by ``tree_id``."""
    spark, arrays = models.scorer.sparkSession, ("feature", "threshold", "left", "right", "size")
    none = lambda kind: F.lit(None).cast(f"array<{kind}>")
    forests = models.forests.select(*GROUP, "tree_id", *arrays, "psi", *[none("double").alias(c) for c in ("p", "center", "scale")])
    grown = []
    for group, tree in models.trees.items():
        _, feature, threshold, left, right, _, p = map(list, zip(*tree.rows()))
        grown.append((*group, DECISION_TREE, feature, threshold, left, right, None, None, p, None, None))
    trees = spark.createDataFrame(grown, forests.schema)
    stats = [table.select(*GROUP, F.lit(kind).alias("tree_id"), F.col("stats.i").alias("feature"), F.col("stats.median").alias("threshold"),
                          *[none("int").alias(c) for c in arrays[2:]], F.lit(None).cast("int").alias("psi"), none("double").alias("p"),
                          F.col("stats.center").alias("center"), F.col("stats.scale").alias("scale"))
             for kind, table in ((SCORER, models.scorer), (FILL, models.fill))]
    return reduce(DataFrame.unionByName, [trees, *stats], forests)


def predict_folds(models: FoldModels, rows: DataFrame) -> DataFrame:
    """Out-of-fold predictions of ``rows`` (``fold, ticker, d_date, label, x``) by the models of their folds, of all settings.

    A row meets the models of its fold once, with its raw vector; what the settings make of it stays in the task.
    """
    given = rows.select(FOLD, *KEY, F.col("label").cast("int").alias("true_label"), "x")
    width = models.width

    def one(x: np.ndarray, parts: pd.DataFrame) -> np.ndarray:
        scorer, fill, tree = (parts[parts["tree_id"] == kind].iloc[0] for kind in (SCORER, FILL, DECISION_TREE))
        forest = fr.Forest.from_trees(parts[parts["tree_id"] >= 0])
        score = np.empty(len(x))
        at = np.asarray(scorer["feature"])
        for i in range(0, len(x), SCORED_ROWS):
            seen = x[i:i + SCORED_ROWS, at]
            score[i:i + SCORED_ROWS] = forest.score((np.where(np.isnan(seen), scorer["threshold"], seen) - scorer["center"]) / scorer["scale"])
        medians = np.zeros(width)  # features without values in training become 0
        medians[np.asarray(fill["feature"])] = fill["threshold"]
        feature, threshold, low, high, p = (np.asarray(tree[c]) for c in ("feature", "threshold", "left", "right", "p"))
        node = np.zeros(len(x), dtype=np.int64)
        while (feature[node] >= 0).any():
            inner = np.flatnonzero(feature[node] >= 0)
            f = feature[node[inner]]
            own = np.minimum(f, width - 1)
            v = x[inner, own]
            v = np.where(f == width, score[inner], np.where(np.isnan(v), medians[own], v))
            node[inner] = np.where(v <= threshold[node[inner]], low[node[inner]], high[node[inner]])
        return p[node]

    def predicted(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(left["x"].to_numpy()).astype(float)
        keys = left.drop(columns="x")
        return pd.concat([keys.assign(**{CONFIG: config, "pred_proba": one(x, parts)}) for config, parts in right.groupby(CONFIG)
                          if (parts["tree_id"] == DECISION_TREE).any()])

    schema = T.StructType([*[f for f in given.schema.fields if f.name != "x"], T.StructField(CONFIG, T.StringType()),
                           T.StructField("pred_proba", T.DoubleType())])
    return fr.with_group_models(given, _model_rows(models), [FOLD], KEY, predicted, schema)


def needed(cfgs: dict[str, CVConfig]) -> dict[str, int]:
    """The greatest ratio of every method."""
    return {m: max(c.ratio for c in cfgs.values() if c.method == m) for m in sorted({c.method for c in cfgs.values()})}


def cross_validate_all(tp: DataFrame, tn: DataFrame, feature_cols: Sequence[str], cfgs: dict[str, CVConfig],
                       staged: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """M10 of several settings at once: ``config, fold, ticker, d_date, true_label, pred_proba``."""
    matched = match_folds(tp, tn, feature_cols, None, needed(cfgs), next(iter(cfgs.values())).seed, staged)
    models = fit_folds(matched, cfgs)
    if not models.trees:
        return tp.sparkSession.createDataFrame([], _OOF)
    both = matched.positives.unionByName(matched.candidates)
    fitted = tp.sparkSession.createDataFrame([(f,) for f in sorted({fold for _, fold in models.trees})], f"{FOLD} date")
    test = both.join(F.broadcast(fitted), F.col("d_date") == F.col(FOLD))
    return predict_folds(models, test).select(*GROUP, *KEY, "true_label", "pred_proba")


def cross_validate(tp: DataFrame, tn: DataFrame, feature_cols: Sequence[str], cfg: CVConfig | None = None,
                   staged: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Out-of-fold predictions ``fold, ticker, d_date, true_label, pred_proba``.

    A fold without training positives or candidates has no model and no predictions.
    """
    return cross_validate_all(tp, tn, feature_cols, {"": cfg or CVConfig()}, staged).drop(CONFIG)


@dataclass
class FinalModel:
    """M11 artifacts: scaler of the anomaly score, forest nodes, medians of the tree, the tree, threshold, names."""

    feature_cols: list[str]
    scorer: mt.ScalerStats
    forest_nodes: DataFrame
    fill: mt.ScalerStats
    tree: DecisionTreeClassificationModel
    threshold: float | None = None

    @property
    def tree_features(self) -> list[str]:
        """Names of the tree's vector: the features that had values in training, then the anomaly score."""
        return [self.feature_cols[i] for i in self.fill.index] + [fr.SCORE_COL]

    def rules(self, spark: SparkSession) -> DataFrame:
        """M8: rules that run on raw feature columns (with ``SCORE_COL`` added by ``with_score``)."""
        return tree_rules(spark, self.tree, self.tree_features, [*self.fill.median, 0.0])

    def importances(self, spark: SparkSession, top: int | None = None) -> DataFrame:
        return feature_importances(spark, self.tree, self.tree_features, top)


def _stats_of(table: DataFrame) -> mt.ScalerStats:
    """The statistics of the fold ALL (a row of at most as many entries as features)."""
    rows = table.filter(F.col(FOLD) == F.lit(ALL)).first()["stats"]
    return mt.ScalerStats([r["i"] for r in rows], [r["median"] for r in rows], [r["center"] for r in rows], [r["scale"] for r in rows])


def fit_final(tp: DataFrame, tn: DataFrame, feature_cols: Sequence[str], cfg: CVConfig | None = None,
              threshold: float | None = None, staged: tuple[DataFrame, DataFrame] | None = None) -> FinalModel:
    """Selection, scorer and tree fitted on all data (the fold that leaves out nothing)."""
    cfgs = {"": cfg or CVConfig()}
    models = fit_folds(match_folds(tp, tn, feature_cols, [ALL], needed(cfgs), cfgs[""].seed, staged), cfgs, grow=False)
    if models.training is None:
        raise ValueError("no training positives, or no candidates to match")
    tree = fit_tree(models.training, "v", cfgs[""].max_depth, cfgs[""].min_leaf, cfgs[""].criterion, cfgs[""].seed)
    return FinalModel(list(feature_cols), _stats_of(models.scorer), cut_lineage(fr.node_rows(models.forests).drop(*GROUP)), _stats_of(models.fill), tree, threshold)


def with_score(model: FinalModel, features: DataFrame) -> DataFrame:
    """M3: the anomaly score of the final scorer as a column; row-local, works on streams too."""
    v = mt.apply_scaler(mt.as_vector(features, model.feature_cols, "_x"), model.scorer, "_x", "_z")
    return fr.score_forest(v, model.forest_nodes, "_z").drop("_x", "_z")


def score(model: FinalModel, features: DataFrame, use_threshold: bool = False) -> DataFrame:
    """P(fraud) per row, and the 0/1 flag at the stored threshold (``>=``).  Works on streams too."""
    s = mt.impute(mt.as_vector(with_score(model, features), model.feature_cols, "_x"), model.fill, "_x", "_v")
    s = s.withColumn("_v", F.concat("_v", F.array(fr.SCORE_COL)))
    out = predict_proba(model.tree, s, "_v", "fraud_proba").drop("_x", "_v", "pred_label")
    if use_threshold:
        if model.threshold is None:
            raise RuntimeError("the model has no stored threshold")
        out = out.withColumn("fraud_flag", (F.col("fraud_proba") >= F.lit(float(model.threshold))).cast("int"))
    return out


def save_model(model: FinalModel, path: str) -> str:
    """Tree via MLlib writer; forest as parquet; statistics, threshold and names as JSON."""
    model.tree.write().overwrite().save(os.path.join(path, "tree"))
    model.forest_nodes.write.mode("overwrite").parquet(os.path.join(path, "forest_nodes"))
    spark = model.forest_nodes.sparkSession
    meta = json.dumps({"feature_cols": model.feature_cols, "threshold": model.threshold,
                       "scorer": model.scorer.to_rows(), "fill": model.fill.to_rows()})
    spark.createDataFrame([(meta,)], "meta string").write.mode("overwrite").json(os.path.join(path, "meta"))
    return path


def load_model(spark: SparkSession, path: str) -> FinalModel:
    meta = json.loads(spark.read.json(os.path.join(path, "meta")).first()["meta"])
    stats = lambda rows: mt.ScalerStats(*map(list, zip(*rows)))
    return FinalModel(meta["feature_cols"], stats(meta["scorer"]), spark.read.parquet(os.path.join(path, "forest_nodes")),
                      stats(meta["fill"]), DecisionTreeClassificationModel.load(os.path.join(path, "tree")), meta["threshold"])


def threshold_from_oof(oof: DataFrame, fp_cost: float = DEFAULT_FP_COST, fn_cost: float = DEFAULT_FN_COST) -> float | None:
    """Cost-optimal threshold from OOF predictions (V7), as a Python float."""
    row = oof_optimum(oof, fp_cost, fn_cost).first()
    return None if row is None or row["threshold"] is None else float(row["threshold"])


def oof_optimum(oof: DataFrame, fp_cost: float = DEFAULT_FP_COST, fn_cost: float = DEFAULT_FN_COST) -> DataFrame:
    from surveil.operators.metrics import optimise_threshold

    return optimise_threshold(oof, label="true_label", score="pred_proba", fp_cost=fp_cost, fn_cost=fn_cost)


DEFAULT_THRESHOLD = 0.5


@dataclass
class Trained:
    """One training run: out-of-fold predictions, their metrics at the optimum (None without both classes), the model."""

    oof: DataFrame
    cv_metrics: DataFrame | None
    model: FinalModel


def train(tp: DataFrame, tn: DataFrame, feature_cols: Sequence[str], cfg: CVConfig | None = None,
          fp_cost: float = DEFAULT_FP_COST, fn_cost: float = DEFAULT_FN_COST) -> Trained:
    """The whole training run: CV (M10), threshold (V7) and final fit.

    Out-of-fold predictions of one class only say nothing about a threshold:
    then there are no metrics and the model keeps ``DEFAULT_THRESHOLD``.
    """
    staged = stage_vectors(tp, tn, feature_cols)  # once for both fits: they are the largest table
    with ThreadPoolExecutor(max_workers=1) as beside:  # the final fit's jobs fill the cores that the folds' leave idle
        final = beside.submit(fit_final, tp, tn, feature_cols, cfg, staged=staged)
        oof = cut_lineage(cross_validate(tp, tn, feature_cols, cfg, staged))
        classes = {r[0] for r in oof.select("true_label").distinct().collect()}
        metrics, threshold = None, DEFAULT_THRESHOLD
        if classes == {0, 1}:
            metrics = cut_lineage(oof_optimum(oof, fp_cost, fn_cost))
            threshold = float(metrics.first()["threshold"])
        return Trained(oof, metrics, replace(final.result(), threshold=threshold))


# ---------------------------------------------------------------------------
# X2 / X3 — configuration and lookback comparisons over cross-validation
# ---------------------------------------------------------------------------


def compared(oof: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per setting (``by``): rows, positives and the exact ROC-AUC and AP (V3, V4) of out-of-fold predictions."""
    from surveil.operators.metrics import grouped_rank_metrics

    return grouped_rank_metrics(oof, by, label="true_label", score="pred_proba")


def grid_oof(tp: DataFrame, tn: DataFrame, feature_cols: Sequence[str], methods: Sequence[str], ratios: Sequence[int],
             base: CVConfig | None = None) -> DataFrame:
    """Out-of-fold predictions of every ``method`` and ``ratio``, all settings in the same jobs."""
    cfgs = {f"{m}/{int(r)}": replace(base or CVConfig(), method=m, ratio=int(r)) for m in methods for r in ratios}
    part = F.split(CONFIG, "/")
    oof = cross_validate_all(tp, tn, feature_cols, cfgs)
    return oof.select(part[0].alias("method"), part[1].cast("int").alias("ratio"), *[c for c in oof.columns if c != CONFIG])


def grid_search(tp: DataFrame, tn: DataFrame, feature_cols: Sequence[str], methods: Sequence[str],
                ratios: Sequence[int], base: CVConfig | None = None) -> DataFrame:
    """OOF ROC-AUC / AUC-PR for every ``(method, ratio)``."""
    return compared(cut_lineage(grid_oof(tp, tn, feature_cols, methods, ratios, base)), ["method", "ratio"])


def lookback_oof(feats: DataFrame, feature_cols: Sequence[str], cfg: CVConfig | None = None) -> DataFrame:
    """Out-of-fold predictions per lookback from a feature matrix keyed by ``(lookback, ticker, d_date)``.

    A few lookbacks run beside each other: the jobs of one fill the cores that those of another leave idle.
    """
    lookbacks = sorted(r[0] for r in feats.select("lookback").distinct().collect())
    if not lookbacks:
        raise ValueError("there are no lookbacks to compare")

    def validated(lb) -> DataFrame:
        part = feats.filter(F.col("lookback") == lb).drop("lookback")
        oof = cut_lineage(cross_validate(part.filter("label = 1"), part.filter("label = 0"), feature_cols, cfg))
        return oof.select(F.lit(int(lb)).alias("lookback"), *oof.columns)

    with ThreadPoolExecutor(max_workers=LOOKBACKS_AT_ONCE) as pool:
        return reduce(DataFrame.unionByName, pool.map(validated, lookbacks))


def lookback_comparison(feats: DataFrame, feature_cols: Sequence[str], cfg: CVConfig | None = None) -> DataFrame:
    """OOF ROC-AUC / AUC-PR per lookback."""
    return compared(lookback_oof(feats, feature_cols, cfg), ["lookback"])
