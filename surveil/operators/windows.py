"""W1–W5 — event-relative observation windows (range joins) and trimming.

A case ``(ticker, d_date)`` owns the bars with
``d_date - lookback_days - margin_days <= date <= d_date - buffer_days``; the
window is then trimmed to its last ``lookback_bars`` rows.

The range join is expressed as an equi-join on ``(ticker, date bucket)``: each
case is exploded into the (few) buckets its window covers, each bar carries
exactly one bucket, and the exact range is a post-join filter.  A ticker that
holds a third of all bars is therefore spread over all of its buckets instead
of landing in one join task, and no nested-loop join is planned.  The planner
broadcasts the case side where its real size allows it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surveil.functions.columns import days
from surveil.functions.constants import (
    DEFAULT_BUFFER_DAYS,
    DEFAULT_LOOKBACK_BARS,
    MIN_WINDOW_ROWS,
    TP_MARGIN_DAYS,
    TN_MARGIN_DAYS,
)
from surveil.schemas import BAR_VALUE_COLS

WINDOW_KEY = ["ticker", "d_date"]


def _window_bounds(cases: DataFrame, lookback_days: int, margin_days: int, buffer_days: int) -> DataFrame:
    return cases.withColumn("_lo", F.date_sub("d_date", lookback_days + margin_days)).withColumn(
        "_hi", F.date_sub("d_date", buffer_days)
    )


def _range_join(bars: DataFrame, windows: DataFrame, keys: list[str], bucket_days: int) -> DataFrame:
    """Join bars to windows ``[_lo, _hi]`` on ``keys`` + bucket, then filter the exact range.

    Without a ticker key the few bucket keys would each carry a large slice of
    all bars: the windows are broadcast then, so the bars stay where they are.
    They are distinct D-dates, hence at most a few rows a calendar day however
    large the tables are, and they must not be repeated for salts: the driver
    would hold D-dates x shuffle partitions rows.
    """
    b = F.lit(bucket_days)
    win_b = windows.withColumn(
        "_bucket",
        F.explode(F.sequence(F.floor(days(F.col("_lo")) / b), F.floor(days(F.col("_hi")) / b))),
    )
    bars_b = bars.withColumn("_bucket", F.floor(days(F.col("date")) / b))
    joined = bars_b.join(win_b if keys else F.broadcast(win_b), on=[*keys, "_bucket"], how="inner")
    return joined.filter(F.col("date").between(F.col("_lo"), F.col("_hi"))).drop("_bucket", "_lo", "_hi")


def observation_window(
    bars: DataFrame,
    cases: DataFrame,
    lookback_bars: int = DEFAULT_LOOKBACK_BARS,
    buffer_days: int = DEFAULT_BUFFER_DAYS,
    margin_days: int = TP_MARGIN_DAYS,
    lookback_days: int | None = None,
    bucket_days: int = 31,
) -> DataFrame:
    """W1+W2: the last ``lookback_bars`` bars per case that end ``buffer_days`` before D.

    ``cases`` needs ``ticker, d_date``; any other case column (e.g. ``label``)
    is carried.  ``lookback_days`` (calendar) defaults to ``lookback_bars``.
    """
    lookback_days = lookback_bars if lookback_days is None else lookback_days
    case_cols = [c for c in cases.columns if c not in ("ticker", "d_date")]
    win = _window_bounds(cases.select("ticker", "d_date", *case_cols), lookback_days, margin_days, buffer_days)
    bars = bars.drop("d_date", *[c for c in case_cols if c in bars.columns])
    joined = _range_join(bars, win, ["ticker"], bucket_days)
    return trim_last(joined, lookback_bars)


def candidate_windows(
    bars: DataFrame,
    candidates: DataFrame,
    d_dates: DataFrame,
    lookback_bars: int = DEFAULT_LOOKBACK_BARS,
    buffer_days: int = DEFAULT_BUFFER_DAYS,
    margin_days: int = TN_MARGIN_DAYS,
    lookback_days: int | None = None,
    bucket_days: int = 31,
) -> DataFrame:
    """Every candidate ticker evaluated at every distinct D-date.

    Bars are semi-joined to the candidate tickers, then range-joined to the
    distinct D-date windows on the date bucket (no ticker key is needed, and
    no candidate × date product is materialised before the join).
    """
    lookback_days = lookback_bars if lookback_days is None else lookback_days
    cand = candidates.select("ticker").distinct()
    kept = bars.drop("d_date").join(cand, "ticker", "left_semi")
    dates = _window_bounds(d_dates.select("d_date").distinct(), lookback_days, margin_days, buffer_days)
    joined = _range_join(kept, dates, [], bucket_days)
    return trim_last(joined, lookback_bars)


def trim_last(df: DataFrame, n: int, key: list[str] | None = None) -> DataFrame:
    """The most recent ``n`` bars per window (Catalyst plans a WindowGroupLimit)."""
    key = key or WINDOW_KEY
    w = Window.partitionBy(*key).orderBy(F.col("date").desc())
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def min_rows(df: DataFrame, n: int = MIN_WINDOW_ROWS, key: list[str] | None = None) -> DataFrame:
    """Drop bars whose values are all NULL, then windows with fewer than ``n`` rows."""
    key = key or WINDOW_KEY
    value_cols = [c for c in BAR_VALUE_COLS if c in df.columns]
    any_value = F.lit(False)
    for c in value_cols:
        any_value = any_value | F.col(c).isNotNull()
    kept = df.filter(any_value)
    w = Window.partitionBy(*key)
    return kept.withColumn("_n", F.count(F.lit(1)).over(w)).filter(F.col("_n") >= n).drop("_n")


def attach_label(df: DataFrame, label: int) -> DataFrame:
    """Constant class label (1 = case, 0 = candidate)."""
    return df.withColumn("label", F.lit(int(label)).cast("int"))


def multi_lookback_windows(windows: DataFrame, lookbacks: list[int], key: list[str] | None = None) -> DataFrame:
    """Re-key windows trimmed at ``max(lookbacks)`` into one window per ``(lookback, ticker, d_date)``.

    The range join runs once; each bar joins every lookback whose last-N trim
    still contains it (``rn <= lookback``), so ``F0`` then runs once keyed by
    ``(lookback, ticker, d_date)``.
    """
    key = key or WINDOW_KEY
    w = Window.partitionBy(*key).orderBy(F.col("date").desc())
    lbs = F.array(*[F.lit(int(x)) for x in sorted(lookbacks)])
    return (windows.withColumn("_rn", F.row_number().over(w))
            .withColumn("lookback", F.explode(F.filter(lbs, lambda lb: lb >= F.col("_rn")))).drop("_rn"))
