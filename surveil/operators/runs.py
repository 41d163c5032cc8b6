"""Whole runs in one call: from raw bars to a stored model, and a stored model over a folder of new data."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveil.functions.constants import DEFAULT_FN_COST, DEFAULT_FP_COST, DEFAULT_LOOKBACK_BARS
from surveil.functions.registry import feature_names
from surveil.operators import features as feat
from surveil.operators import model as md
from surveil.operators import windows as win
from surveil.operators.metrics import holdout_report
from surveil.session import cut_lineage


def train_from_bars(bars: DataFrame, cases: DataFrame, candidates: DataFrame, path: str | None = None, cfg: md.CVConfig | None = None,
                    lookback_bars: int = DEFAULT_LOOKBACK_BARS, fp_cost: float = DEFAULT_FP_COST, fn_cost: float = DEFAULT_FN_COST,
                    feature_cols: Sequence[str] | None = None) -> md.Trained:
    """W1–W5, F0, M10, V7, M11 and, with a ``path``, S8: windows of the cases and of all candidates at every D-date, features, training."""
    tp = win.attach_label(win.observation_window(bars, cases, lookback_bars=lookback_bars).drop("label"), 1)
    tn = win.attach_label(win.candidate_windows(bars, candidates, cases, lookback_bars=lookback_bars).drop("label"), 0)
    feats = cut_lineage(feat.transform(tp.unionByName(tn, allowMissingColumns=True)))
    run = md.train(feats.filter("label = 1"), feats.filter("label = 0"), feature_cols or feature_names(), cfg, fp_cost, fn_cost)
    if path is not None:
        md.save_model(run.model, path)
    return run


def evaluate_folder(spark: SparkSession, model_path: str, features_path: str, out: str, fp_cost: float = DEFAULT_FP_COST,
                    fn_cost: float = DEFAULT_FN_COST) -> DataFrame:
    """Score a folder of feature rows with a stored model.

    Writes ``scores`` and, where the rows are labelled with both classes, ``report``
    under ``out``; returns the scores.
    """
    model = md.load_model(spark, model_path)
    rows = spark.read.parquet(features_path)
    scored = md.score(model, rows, use_threshold=model.threshold is not None)
    kept = [c for c in scored.columns if c not in set(model.feature_cols)]
    scored.select(*kept).write.mode("overwrite").parquet(os.path.join(out, "scores"))
    scores = spark.read.parquet(os.path.join(out, "scores"))
    if "label" in scores.columns and {r[0] for r in scores.select(F.col("label").cast("int")).distinct().collect()} >= {0, 1}:
        report = holdout_report(scores, model.threshold, "label", "fraud_proba", fp_cost, fn_cost)
        report.write.mode("overwrite").parquet(os.path.join(out, "report"))
    return scores
