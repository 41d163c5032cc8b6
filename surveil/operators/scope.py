"""P1–P7 — scope filters, history filter and metadata joins.

Ticker lists steer plain semi-joins: the planner broadcasts them where their
real size allows it and otherwise shuffles (with AQE skew handling).
A hot ticker never forms a group on its own: history counts are partial
aggregates (map-side combine) and the bars side is only filtered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveil.functions.quantiles import exact_median, join_groups
from surveil.functions.constants import MIN_TRADING_DAYS, SUPPORTED_COUNTRIES, SUPPORTED_CURRENCIES

def _semi(df: DataFrame, keys: DataFrame, on: Sequence[str], how: str = "left_semi") -> DataFrame:
    return df.join(keys.select(*on).distinct(), list(on), how)


def scope_metadata(meta: DataFrame, countries: Sequence[str] = SUPPORTED_COUNTRIES,
                   currencies: Sequence[str] = SUPPORTED_CURRENCIES) -> DataFrame:
    """Metadata rows in scope: ``(country IN .. OR NULL) AND (currency IN .. OR NULL)``."""
    keep = F.col("country").isin(list(countries)) | F.col("country").isNull()
    if "currency" in meta.columns:
        keep = keep & (F.col("currency").isin(list(currencies)) | F.col("currency").isNull())
    return meta.filter(keep)


def filter_scope(bars: DataFrame, meta: DataFrame, countries: Sequence[str] = SUPPORTED_COUNTRIES,
                 currencies: Sequence[str] = SUPPORTED_CURRENCIES) -> tuple[DataFrame, DataFrame]:
    """Keep in-scope metadata, then only bars whose ticker has a kept metadata row.

    Tickers without any metadata row are dropped (as the reference does).
    """
    if "country" not in meta.columns:
        return bars, meta
    kept = scope_metadata(meta, countries, currencies)
    return _semi(bars, kept, ["ticker"]), kept


def history_counts(bars: DataFrame, by: Sequence[str] = ("ticker",)) -> DataFrame:
    return bars.groupBy(*by).agg(F.count("date").alias("n_days"))


def drop_insufficient_history(bars: DataFrame, min_days: int = MIN_TRADING_DAYS,
                              by: Sequence[str] = ("ticker",)) -> DataFrame:
    """Drop groups (``by=['ticker']`` as the reference, or ``['ticker','d_date']``) with < ``min_days`` bars."""
    ok = history_counts(bars, by).filter(F.col("n_days") >= min_days)
    return _semi(bars, ok, list(by))


def align_metadata(meta: DataFrame, bars: DataFrame) -> DataFrame:
    """Metadata of the tickers that survive in ``bars``."""
    return _semi(meta, bars, ["ticker"])


def merge_metadata(bars: DataFrame, meta: DataFrame) -> DataFrame:
    """Left join of (one-row-per-ticker) metadata on ticker; metadata ``d_date``/``label`` dropped."""
    from surveil.operators.features import dedupe_metadata

    m = dedupe_metadata(meta).drop(*[c for c in ("d_date", "label") if c in meta.columns])
    return bars.join(m, "ticker", "left")


def preprocess(bars: DataFrame, meta: DataFrame, countries: Sequence[str] = SUPPORTED_COUNTRIES,
               currencies: Sequence[str] = SUPPORTED_CURRENCIES, min_days: int = MIN_TRADING_DAYS,
               by: Sequence[str] = ("ticker",)) -> tuple[DataFrame, DataFrame]:
    """P5: P1 → P2 → P3."""
    b, m = filter_scope(bars, meta, countries, currencies)
    b = drop_insufficient_history(b, min_days, by)
    return b, align_metadata(m, b)


def dataset_summary(bars: DataFrame, meta: DataFrame | None = None) -> DataFrame:
    """Tickers, case tickers, rows and median/min/max bars per ticker (+ sorted country list)."""
    per = bars.groupBy("ticker").agg(
        F.count("date").alias("_days"),
        (F.max(F.col("label")) == 1).alias("_tp") if "label" in bars.columns else F.lit(False).alias("_tp"),
    )
    out = per.agg(
        F.count(F.lit(1)).alias("n_tickers"),
        F.count_if(F.col("_tp")).alias("n_tp_tickers"),
        F.sum("_days").alias("n_rows"),
        F.min("_days").alias("min_days"),
        F.max("_days").alias("max_days"),
    )
    out = join_groups(out, exact_median(per, "_days", out="median_days"), [])
    if meta is not None and "country" in meta.columns:
        names = meta.agg(F.array_sort(F.collect_set("country")).alias("countries"))
        out = join_groups(out, names, [])
    return out


def summary_cube(bars: DataFrame, meta: DataFrame, dims: Sequence[str], how: str = "cube") -> DataFrame:
    """P6 for every combination of ``dims`` (``cube``) or their prefixes (``rollup``).

    ``grouping_id`` tells a subtotal from a NULL category.  Tickers are counted once
    in a first aggregate, so the expansion repeats one narrow row a ticker; the
    exact medians aggregate counts of equal values before they are shuffled.
    """
    from surveil.operators.features import dedupe_metadata

    per = bars.groupBy("ticker").agg(F.count("date").alias("_days"), F.max("label").alias("_tp"))
    per = per.join(dedupe_metadata(meta).select("ticker", *dims), "ticker", "left").select(*dims, "_days", "_tp")
    if how not in ("cube", "rollup"):
        raise ValueError("how must be 'cube' or 'rollup'")
    grouped = per.cube(*dims) if how == "cube" else per.rollup(*dims)
    return grouped.agg(
        F.grouping_id().alias("grouping_id"), F.count(F.lit(1)).alias("n_tickers"), F.count_if(F.col("_tp") == 1).alias("n_tp_tickers"),
        F.sum("_days").alias("n_rows"), F.percentile("_days", 0.5).alias("median_days"),
        F.min("_days").alias("min_days"), F.max("_days").alias("max_days"))


def removed_keys(before: DataFrame, after: DataFrame, meta: DataFrame | None = None,
                 key: Sequence[str] = ("ticker",)) -> DataFrame:
    """Keys present before a filter and absent after it, with their metadata."""
    gone = before.select(*key).distinct().join(after.select(*key).distinct(), list(key), "left_anti")
    if meta is not None:
        from surveil.operators.features import dedupe_metadata

        gone = gone.join(dedupe_metadata(meta), list(key), "left")
    return gone
