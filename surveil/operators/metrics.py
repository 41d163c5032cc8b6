"""V1–V9 — confusion counts, rates, rank metrics and the cost-optimal threshold.

Input: a DataFrame with a 0/1 ``label`` column and a score column.  A NULL
score predicts negative.  Every metric is an aggregate; nothing is collected.

* Everything starts from one table of distinct scores with their class counts,
  so a hot score is one row.
* Threshold metrics (V1, V2, V5, V6, V7) bucket the distinct scores by the
  number of grid thresholds they reach; suffix sums over the ``k + 1`` buckets
  give the confusion counts at every threshold.
* Rank metrics (V3, V4) take distributed running sums over the distinct scores.
  A NULL score ranks below all others, as it predicts negative at every threshold.
* Ratios are rounded half-up to 4 decimals in decimal arithmetic, so the
  values are exact and engine-independent at any row count.
* No operator runs a Spark job while its plan is built.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveil.functions.constants import (
    DEFAULT_FN_COST,
    DEFAULT_FP_COST,
    METRIC_COLS,
    OPTIMISER_THRESHOLDS,
    SUMMARY_THRESHOLDS,
)
from surveil.functions.quantiles import running_sums


def linspace(start: float, stop: float, num: int) -> list[float]:
    """Evenly spaced grid identical to ``numpy.linspace`` (``i·step + start``, exact endpoint)."""
    return [float(x) for x in np.linspace(start, stop, num)]


def summary_thresholds() -> list[float]:
    return linspace(0.05, 0.95, SUMMARY_THRESHOLDS)


def optimiser_thresholds(n: int = OPTIMISER_THRESHOLDS) -> list[float]:
    return linspace(0.01, 0.99, n)


def ratio4(num: Column, den: Column) -> Column:
    """``round(num/den, 4)`` half-up in exact decimal arithmetic; 0 on an empty denominator."""
    n = num.cast("decimal(33,0)")
    d = den.cast("decimal(33,0)")
    top, bottom = F.lit(20000).cast("decimal(5,0)") * n + d, F.lit(2).cast("decimal(1,0)") * d
    q = (top - top % bottom) / bottom  # divides evenly
    return F.when(d > 0, F.round(q, 0).cast("double") / F.lit(10000.0)).otherwise(F.lit(0.0))


def _cost(fp: Column, fn: Column, fp_cost: float, fn_cost: float) -> Column:
    return fp.cast("double") * F.lit(float(fp_cost)) + fn.cast("double") * F.lit(float(fn_cost))


def _cost_per_case(fp: Column, fn: Column, n: Column, fp_cost: float, fn_cost: float) -> Column:
    if float(fp_cost).is_integer() and float(fn_cost).is_integer():
        return F.when(n > 0, ratio4(fp * F.lit(int(fp_cost)) + fn * F.lit(int(fn_cost)), n))
    return F.when(n > 0, F.round(_cost(fp, fn, fp_cost, fn_cost) / n, 4))


def _prep(df: DataFrame, label: str, score: str) -> DataFrame:
    return df.select(F.col(label).cast("int").alias("_y"), F.col(score).cast("double").alias("_s"))


# ---------------------------------------------------------------------------
# V1 / V2 / V5 at a single threshold
# ---------------------------------------------------------------------------


def confusion(df: DataFrame, threshold: float = 0.5, label: str = "label", score: str = "score") -> DataFrame:
    """V1: one row ``tp, fp, tn, fn`` with ``pred = score >= threshold`` (NULL → negative)."""
    p = _prep(df, label, score)
    pred = F.coalesce(F.col("_s") >= F.lit(float(threshold)), F.lit(False))
    y = F.col("_y") == 1
    return p.agg(
        F.count_if(pred & y).alias("tp"),
        F.count_if(pred & ~y).alias("fp"),
        F.count_if(~pred & ~y).alias("tn"),
        F.count_if(~pred & y).alias("fn"),
    )


def with_rates(counts: DataFrame, fp_cost: float = DEFAULT_FP_COST, fn_cost: float = DEFAULT_FN_COST) -> DataFrame:
    """V2 + V5 on a frame with ``tp, fp, tn, fn`` columns."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    n = tp + fp + tn + fn
    return counts.select(
        "*",
        ratio4(tp, tp + fp).alias("precision"),
        ratio4(tp, tp + fn).alias("recall"),
        ratio4(F.lit(2) * tp, F.lit(2) * tp + fp + fn).alias("f1"),
        ratio4(tn, tn + fp).alias("specificity"),
        _cost(fp, fn, fp_cost, fn_cost).alias("cost"),
        _cost_per_case(fp, fn, n, fp_cost, fn_cost).alias("cost_per_case"),
        (tp + fn).cast("long").alias("n_positive"),
        (tn + fp).cast("long").alias("n_negative"),
        n.cast("long").alias("n_total"),
    )


# ---------------------------------------------------------------------------
# V3 / V4 — rank metrics over distinct scores
# ---------------------------------------------------------------------------


def distinct_scores(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One row per distinct score (NULL included): ``_s, pos, neg``."""
    return _prep(df, label, score).groupBy("_s").agg(
        F.count_if(F.col("_y") == 1).alias("pos"), F.count_if(F.coalesce(F.col("_y"), F.lit(0)) != 1).alias("neg"))


def score_table(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Distinct scores with class counts, exclusive running sums (ascending, NULL first) and totals.

    Columns: ``s, pos, neg, pos_below, neg_below, P, N``.
    """
    return _score_table(distinct_scores(df, label, score))


def _score_table(scores: DataFrame) -> DataFrame:
    t = running_sums(scores, "_s", ["pos", "neg"])
    return t.select(F.col("_s").alias("s"), "pos", "neg", "pos_below", "neg_below",
                    F.col("pos_total").alias("P"), F.col("neg_total").alias("N"))


def rank_metrics(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """V3 + V4: one row ``roc_auc, pr_auc`` (NULL unless both classes are present).

    ROC-AUC is Mann–Whitney with ties at one half (exact, integer numerator);
    AP is the step-wise ``Σ ΔRecall · Precision`` over distinct scores, descending.
    """
    return _rank_metrics(distinct_scores(df, label, score))


def _rank_metrics(scores: DataFrame) -> DataFrame:
    t = _score_table(scores)
    tp_at = F.col("P") - F.col("pos_below")
    fp_at = F.col("N") - F.col("neg_below")
    agg = t.agg(
        F.max("P").alias("P"),
        F.max("N").alias("N"),
        F.sum(F.col("pos").cast("decimal(18,0)") * (F.lit(2) * F.col("neg_below") + F.col("neg")).cast("decimal(19,0)")).alias("_u2"),
        F.sum(F.when(F.col("pos") > 0, F.col("pos") * (tp_at / (tp_at + fp_at)))).alias("_ap"),
    )
    both = (F.col("P") > 0) & (F.col("N") > 0)
    return agg.select(
        F.when(both, ratio4(F.col("_u2"), F.lit(2) * F.col("P").cast("decimal(16,0)") * F.col("N").cast("decimal(16,0)"))).alias("roc_auc"),
        F.when(both, F.round(F.col("_ap") / F.col("P"), 4)).alias("pr_auc"),
    )


def grouped_rank_metrics(df: DataFrame, by: Sequence[str], label: str = "label", score: str = "score") -> DataFrame:
    """V3 + V4 per group: ``n_rows, n_positive, roc_auc, pr_auc``.

    For few groups whose scores are those of tree leaves: a group's distinct scores meet in one task.
    """
    by = list(by)
    per = df.select(*by, F.col(label).cast("int").alias("_y"), F.col(score).cast("double").alias("_s")).groupBy(*by, "_s").agg(
        F.count_if(F.col("_y") == 1).alias("pos"), F.count_if(F.coalesce(F.col("_y"), F.lit(0)) != 1).alias("neg"))
    whole = Window.partitionBy(*by)
    below = whole.orderBy(F.col("_s").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    t = per.withColumns({"P": F.sum("pos").over(whole), "N": F.sum("neg").over(whole),
                         "pos_below": F.coalesce(F.sum("pos").over(below), F.lit(0)), "neg_below": F.coalesce(F.sum("neg").over(below), F.lit(0))})
    tp_at, fp_at = F.col("P") - F.col("pos_below"), F.col("N") - F.col("neg_below")
    agg = t.groupBy(*by).agg(
        F.max("P").alias("P"), F.max("N").alias("N"),
        F.sum(F.col("pos").cast("decimal(18,0)") * (F.lit(2) * F.col("neg_below") + F.col("neg")).cast("decimal(19,0)")).alias("_u2"),
        F.sum(F.when(F.col("pos") > 0, F.col("pos") * (tp_at / (tp_at + fp_at)))).alias("_ap"))
    both = (F.col("P") > 0) & (F.col("N") > 0)
    return agg.select(
        *by, (F.col("P") + F.col("N")).alias("n_rows"), F.col("P").alias("n_positive"),
        F.when(both, ratio4(F.col("_u2"), F.lit(2) * F.col("P").cast("decimal(16,0)") * F.col("N").cast("decimal(16,0)"))).alias("roc_auc"),
        F.when(both, F.round(F.col("_ap") / F.col("P"), 4)).alias("pr_auc"))


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    return rank_metrics(df, label, score).select("roc_auc")


def average_precision(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    return rank_metrics(df, label, score).select("pr_auc")


# ---------------------------------------------------------------------------
# V6 / V7 / V8 / V9
# ---------------------------------------------------------------------------


def _bucket_sql(ths: Sequence[float], lo: int, hi: int) -> str:
    """Number of ``ths[lo:hi]`` thresholds ``<= _s`` plus ``lo``, as a balanced CASE tree (log2 k comparisons)."""
    if lo >= hi:
        return str(lo)
    mid = (lo + hi) // 2
    return f"CASE WHEN _s >= {repr(float(ths[mid]))}D THEN {_bucket_sql(ths, mid + 1, hi)} ELSE {_bucket_sql(ths, lo, mid)} END"


def _bucket(score: Column, thresholds: Sequence[float]) -> Column:
    """Number of thresholds ``<= score`` (thresholds ascending); NULL score → 0."""
    return F.coalesce(F.expr(_bucket_sql(list(thresholds), 0, len(thresholds))), F.lit(0))


def threshold_sweep(
    df: DataFrame,
    thresholds: Sequence[float] | None = None,
    label: str = "label",
    score: str = "score",
    fp_cost: float = DEFAULT_FP_COST,
    fn_cost: float = DEFAULT_FN_COST,
    with_rank_metrics: bool = True,
) -> DataFrame:
    """V6: all metrics at every threshold, from the table of distinct scores."""
    scores = distinct_scores(df, label, score)
    return _sweep(scores, _rank_metrics(scores) if with_rank_metrics else None, thresholds, fp_cost, fn_cost)


def _sweep(scores: DataFrame, ranks: DataFrame | None, thresholds: Sequence[float] | None, fp_cost: float, fn_cost: float) -> DataFrame:
    ths = sorted(float(t) for t in (thresholds if thresholds is not None else summary_thresholds()))
    spark = scores.sparkSession
    counts = scores.groupBy(_bucket(F.col("_s"), ths).alias("_j")).agg(
        F.sum("pos").alias("_pos"), F.sum("neg").alias("_neg"))
    # k+1 bucket rows: bucket j holds scores in [t_j, t_{j+1}); a suffix sum from j
    # gives the rows predicted positive at threshold j
    grid = spark.createDataFrame([(i, ths[i - 1] if i else None) for i in range(len(ths) + 1)], "_j int, _t double")
    filled = grid.join(F.broadcast(counts), "_j", "left").fillna(0, subset=["_pos", "_neg"])
    suffix = Window.orderBy("_j").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = Window.orderBy("_j").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cum = filled.select(
        "_j", "_t",
        F.sum("_pos").over(suffix).alias("tp"), F.sum("_neg").over(suffix).alias("fp"),
        F.sum("_pos").over(total).alias("_P"), F.sum("_neg").over(total).alias("_N"),
    ).filter(F.col("_j") > 0)
    base = cum.select(
        "_j", F.round(F.col("_t"), 4).alias("threshold"), F.col("_t").alias("raw_threshold"),
        F.col("tp").cast("long").alias("tp"), F.col("fp").cast("long").alias("fp"),
        (F.col("_N") - F.col("fp")).cast("long").alias("tn"), (F.col("_P") - F.col("tp")).cast("long").alias("fn"),
    )
    out = with_rates(base, fp_cost, fn_cost)
    if ranks is not None:
        out = out.crossJoin(F.broadcast(ranks))  # one row
    else:
        out = out.withColumn("roc_auc", F.lit(None).cast("double")).withColumn("pr_auc", F.lit(None).cast("double"))
    return out.select(*METRIC_COLS, "raw_threshold")


def optimise_threshold(
    df: DataFrame,
    n_thresholds: int = OPTIMISER_THRESHOLDS,
    label: str = "label",
    score: str = "score",
    fp_cost: float = DEFAULT_FP_COST,
    fn_cost: float = DEFAULT_FN_COST,
) -> DataFrame:
    """V7: the grid row with minimum cost; the lowest threshold wins ties."""
    return _optimum(threshold_sweep(df, optimiser_thresholds(n_thresholds), label, score, fp_cost, fn_cost))


def _optimum(sweep: DataFrame) -> DataFrame:
    best = sweep.agg(F.min_by(F.struct(*sweep.columns), F.struct("cost", "raw_threshold")).alias("b"))
    return best.select("b.*").drop("raw_threshold")


def holdout_report(
    df: DataFrame,
    threshold: float | None = None,
    label: str = "label",
    score: str = "score",
    fp_cost: float = DEFAULT_FP_COST,
    fn_cost: float = DEFAULT_FN_COST,
) -> DataFrame:
    """V8: the whole holdout report, one row per ``mode`` and threshold.

    ``fixed``: the metrics at the chosen (stored) threshold, if one is given;
    ``optimised``: the cost optimum on this data; ``summary``: the summary grid.
    """
    wanted = {"summary": summary_thresholds(), "optimised": optimiser_thresholds(OPTIMISER_THRESHOLDS),
              "fixed": [] if threshold is None else [threshold]}
    scores = distinct_scores(df, label, score)
    # one sweep over the thresholds of all modes
    every = sorted({float(t) for ths in wanted.values() for t in ths})
    sweep = _sweep(scores, _rank_metrics(scores), every, fp_cost, fn_cost)
    modes = df.sparkSession.createDataFrame([(mode, float(t)) for mode, ths in wanted.items() for t in ths], "mode string, raw_threshold double")
    rows = sweep.join(F.broadcast(modes), "raw_threshold")
    best = F.row_number().over(Window.partitionBy("mode").orderBy("cost", "raw_threshold"))  # a few hundred rows
    rows = rows.withColumn("_best", best).filter((F.col("mode") != "optimised") | (F.col("_best") == 1))
    return rows.select(*METRIC_COLS, "mode")


def cost_curve(sweep: DataFrame) -> DataFrame:
    """V9: threshold vs cost (data behind the cost plot)."""
    return sweep.select("threshold", "cost", "fp", "fn")


def pr_curve(sweep: DataFrame) -> DataFrame:
    """V9: threshold vs precision / recall / f1."""
    return sweep.select("threshold", "precision", "recall", "f1")
