"""E1–E19 — event-aligned analysis of windows, scores and feature matrices.

These are ordinary grouped / windowed aggregates.  Windows are keyed by
``(ticker, d_date)``; per-window window functions never exceed one window's
bars, and cross-window summaries are two-level aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surveil.functions.quantiles import exact_median, exact_quantiles, join_groups
from surveil.functions.registry import FEATURES

WINDOW_KEY = ["ticker", "d_date"]


def days_to_event(df: DataFrame) -> DataFrame:
    """``days_to_d = date - d_date`` in days."""
    return df.withColumn("days_to_d", F.datediff("date", "d_date"))


def normalise_to_start(df: DataFrame, col: str, key: Sequence[str] = WINDOW_KEY) -> DataFrame:
    """Value / first non-null value of the window (date order)."""
    w = Window.partitionBy(*key).orderBy("date").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.withColumn(f"{col}_norm", F.try_divide(F.col(col), F.first(col, ignorenulls=True).over(w)))


def normalise_to_mean(df: DataFrame, col: str, key: Sequence[str] = WINDOW_KEY) -> DataFrame:
    """Value / window mean."""
    return df.withColumn(f"{col}_norm", F.try_divide(F.col(col), F.avg(col).over(Window.partitionBy(*key))))


def event_frame(windows: DataFrame, key: Sequence[str] = WINDOW_KEY) -> DataFrame:
    """E1 + E2(close) + E3(volume): the aligned frame the event analyses read."""
    return normalise_to_mean(normalise_to_start(days_to_event(windows), "close", key), "volume", key)


def median_trajectory(df: DataFrame, col: str = "close_norm") -> DataFrame:
    """Median of ``col`` per ``days_to_d`` (NULL where a day has no value)."""
    return join_groups(df.select("days_to_d").distinct(), exact_median(df, col, ["days_to_d"], f"median_{col}"), ["days_to_d"])


def window_returns(df: DataFrame, key: Sequence[str] = WINDOW_KEY) -> DataFrame:
    """E5: per window, ``(last close_norm - 1) · 100``."""
    return df.groupBy(*key).agg(((F.max_by("close_norm", "days_to_d") - 1) * 100).alias("return_pct"))


def return_summary(returns: DataFrame) -> DataFrame:
    """E5: median, mean and share of windows with a positive return."""
    means = returns.agg(
        F.avg("return_pct").alias("mean_return"),
        F.avg((F.col("return_pct") > 0).cast("double")).alias("share_rising"),
        F.count(F.lit(1)).alias("n_windows"),
    )
    return join_groups(means, exact_median(returns, "return_pct", out="median_return"), [])


def rolling_mean_by_group(df: DataFrame, col: str = "volume_norm", n: int = 10, min_periods: int = 3,
                          key: Sequence[str] = WINDOW_KEY) -> DataFrame:
    """Trailing ``n``-row mean per window, NULL below ``min_periods`` non-null values."""
    w = Window.partitionBy(*key).orderBy("days_to_d").rowsBetween(-(n - 1), 0)
    return df.withColumn(f"{col}_roll{n}", F.when(F.count(col).over(w) >= min_periods, F.avg(col).over(w)))


def quantile_band(df: DataFrame, col: str, by: str = "days_to_d") -> DataFrame:
    """Median, q25, q75 of ``col`` per ``by`` (exact, with linear interpolation)."""
    q = exact_quantiles(df, col, [0.25, 0.5, 0.75], [by], "_q")
    return join_groups(df.select(by).distinct(), q, [by]).select(
        by, F.col("_q")[1].alias("median"), F.col("_q")[0].alias("q25"), F.col("_q")[2].alias("q75")
    )


def bucket_by_days(df: DataFrame, width: int = 10, lookback: int = 90) -> DataFrame:
    """Right-closed buckets ``(-lookback-1 + w·i, -lookback-1 + w·(i+1)]``; outside → dropped.

    Returns the median normalised close and volume per bucket.
    """
    lo0 = -lookback - 1
    d = F.col("days_to_d")
    n_buckets = (0 - lo0) // width
    idx = F.ceil((d - F.lit(lo0)) / F.lit(width)).cast("int") - 1
    inside = (d > F.lit(lo0)) & (d <= F.lit(lo0 + n_buckets * width))
    b = df.withColumn("_i", F.when(inside, idx)).filter(F.col("_i").isNotNull())
    both = b.select("_i").distinct()
    for c in ("close_norm", "volume_norm"):
        both = join_groups(both, exact_median(b, c, ["_i"], f"median_{c}"), ["_i"])
    return both.select(
        (F.lit(lo0) + F.col("_i") * width).alias("bucket_lo"),
        (F.lit(lo0) + (F.col("_i") + 1) * width).alias("bucket_hi"),
        "median_close_norm", "median_volume_norm",
    )


def lookback_consistency(df: DataFrame, lookbacks: Sequence[int] = (30, 45, 60, 90, 120),
                         key: Sequence[str] = WINDOW_KEY) -> DataFrame:
    """Per lookback, per-window mean normalised volume, then n, mean, std, cv — one job."""
    lb = df.withColumn("lookback_days", F.explode(F.array(*[F.lit(int(x)) for x in lookbacks])))
    per = lb.filter(F.col("days_to_d") >= -F.col("lookback_days")).groupBy("lookback_days", *key).agg(
        F.avg("volume_norm").alias("_m")
    )
    return per.groupBy("lookback_days").agg(
        F.count(F.lit(1)).alias("n_tickers"),
        F.avg("_m").alias("mean_vol"),
        F.stddev_samp("_m").alias("std_vol"),
    ).withColumn("cv", F.when(F.col("mean_vol") > 0, F.col("std_vol") / F.col("mean_vol")))


def class_imbalance(df: DataFrame, universe_size: int = 6000) -> DataFrame:
    """Imbalance ratio, naive accuracy and the legacy-rule precision at a 50 % flag rate."""
    n = df.agg(F.count_distinct("ticker").alias("n_tp"))
    u = F.lit(int(universe_size))
    return n.select(
        "n_tp",
        F.when(F.col("n_tp") > 0, F.floor(u / F.col("n_tp"))).cast("long").alias("imbalance_ratio"),
        (F.lit(1.0) - F.col("n_tp") / u).alias("naive_accuracy"),
        (F.col("n_tp") / (u * F.lit(0.5))).alias("legacy_precision"),
    )


def value_counts(df: DataFrame, col: str, k: int = 10, unknown: str = "Unknown") -> DataFrame:
    """Top-``k`` values of ``col`` (NULL → ``unknown``), ties by value."""
    v = F.coalesce(F.col(col).cast("string"), F.lit(unknown)).alias(col)
    return df.groupBy(v).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), F.asc(col)).limit(k)


def cases_by_year(cases: DataFrame, bars: DataFrame) -> DataFrame:
    """Cases whose ticker survives in ``bars``, counted by year of D."""
    alive = cases.join(bars.select("ticker").distinct(), "ticker", "left_semi")
    return alive.groupBy(F.year("d_date").alias("year")).agg(F.count(F.lit(1)).alias("n_cases"))


def histogram(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """Equal-width counts between min and max (last bin closed on the right).

    The range is two scalars from one aggregate; bins are then one grouped count.
    """
    r = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    if r["lo"] is None:
        return df.sparkSession.createDataFrame([], "bin int, bin_lo double, bin_hi double, count long")
    lo, hi = float(r["lo"]), float(r["hi"])
    span = hi - lo
    x = F.col(col).cast("double")
    if span > 0:
        idx = F.least(F.floor((x - F.lit(lo)) / F.lit(span) * F.lit(float(bins))).cast("int"), F.lit(bins - 1))
    else:
        idx = F.lit(0)
    counted = df.filter(x.isNotNull()).groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    return counted.select(
        "bin",
        (F.lit(lo) + F.lit(span) * F.col("bin") / F.lit(float(bins))).alias("bin_lo"),
        (F.lit(lo) + F.lit(span) * (F.col("bin") + 1) / F.lit(float(bins))).alias("bin_hi"),
        "count",
    )


def null_rate(features: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Share of NULLs per feature (long form) — one aggregate pass."""
    names = [n for n in (names or [f.name for f in FEATURES]) if n in features.columns]
    rates = features.agg(*[F.avg(F.col(f"`{n}`").isNull().cast("double")).alias(n) for n in names])
    stack = ", ".join(f"'{n}', `{n}`" for n in names)
    return rates.selectExpr(f"stack({len(names)}, {stack}) AS (feature, null_rate)")


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation for every column pair (pairwise complete), long form, one aggregate."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    agg = df.agg(*[F.corr(F.col(f"`{a}`"), F.col(f"`{b}`")).alias(f"c{k}") for k, (a, b) in enumerate(pairs)])
    stack = ", ".join(f"'{a}', '{b}', c{k}" for k, (a, b) in enumerate(pairs))
    return agg.selectExpr(f"stack({len(pairs)}, {stack}) AS (col_a, col_b, corr)")


def score_separation(scores: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """N and median score per true label."""
    rows = scores.select(F.col(label).alias("label"), F.col(score).alias("_score"))
    counts = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    return join_groups(counts, exact_median(rows, "_score", ["label"], "median_score"), ["label"])


def ranked_positives(scores: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Positives ordered by descending score."""
    return scores.filter(F.col(label) == 1).orderBy(F.desc(score))


def detection_rate(scores: DataFrame, threshold: float, label: str = "label", score: str = "score") -> DataFrame:
    """Share of positives scored at or above ``threshold``."""
    pos = scores.filter(F.col(label) == 1)
    return pos.agg(
        F.count(F.lit(1)).alias("n_positive"),
        F.count_if(F.col(score) >= F.lit(float(threshold))).alias("n_detected"),
    ).withColumn("detection_rate", F.when(F.col("n_positive") > 0, F.col("n_detected") / F.col("n_positive")))


def feature_group_counts(features: DataFrame) -> DataFrame:
    """Features per family, and how many carry at least one non-NULL value in ``features``."""
    names = [f.name for f in FEATURES if f.name in features.columns]
    seen = features.agg(*[F.count(F.col(f"`{n}`")).alias(n) for n in names])
    fam = {f.name: f.family for f in FEATURES}
    stack = ", ".join(f"'{fam[n]}', `{n}`" for n in names)
    long = seen.selectExpr(f"stack({len(names)}, {stack}) AS (family, n_values)")
    return long.groupBy("family").agg(
        F.count(F.lit(1)).alias("n_features"), F.count_if(F.col("n_values") > 0).alias("n_populated")
    )


def case_summary(cases: DataFrame) -> DataFrame:
    """Rows, distinct tickers, first and last D-date."""
    return cases.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("ticker").alias("n_tickers"),
        F.min("d_date").alias("first_d_date"), F.max("d_date").alias("last_d_date"),
    )


def window_summary(windows: DataFrame) -> DataFrame:
    """Distinct D-dates, windows, bar rows and mean rows per window."""
    per = windows.groupBy(*WINDOW_KEY).agg(F.count(F.lit(1)).alias("_n"))
    return per.agg(
        F.count_distinct("d_date").alias("n_d_dates"), F.count(F.lit(1)).alias("n_windows"),
        F.sum("_n").alias("n_rows"), F.avg("_n").alias("rows_per_window"),
    )
