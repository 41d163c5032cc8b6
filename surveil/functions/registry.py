"""F13 — the feature registry: ordered names and their expressions.

Every feature is "as of the last bar" of a window (``rn = 1`` is the last
bar).  A rolling statistic read at the last bar equals an aggregate over the
bars with ``rn <= r``.  The feature plan therefore

1. explodes each bar once per window size ``w`` it belongs to (``rn <= w``)
   plus one *pick* row ``w = -rn`` for the bars an n-bar change reads;
2. computes a fixed set of *unconditional* aggregates per
   ``(ticker, d_date, w)`` (``STAT_AGGS``);
3. gathers the ≤ 17 stat structs of a window into a map ``m`` keyed by ``w``;
4. projects every feature as an expression over ``m`` (``Feature.sql``).

All three steps reuse the ``(ticker, d_date)`` partitioning of the windows,
so the matrix costs no shuffle beyond the one of the window trim.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from surveil.functions.constants import (
    CHANGE_WINDOWS,
    INTRADAY_COLS,
    ORDER_FLOW_WINDOWS,
    PRICE_COLS,
    ROLLING_WINDOWS,
    min_periods,
)

# window sizes whose bar sets are aggregated, and the bar positions an n-bar change reads
WINDOW_SIZES = sorted(set(ROLLING_WINDOWS) | set(ORDER_FLOW_WINDOWS) | set(CHANGE_WINDOWS))
PICK_POSITIONS = sorted({1} | {n + 1 for n in CHANGE_WINDOWS})

STAT_SERIES = [*(f"{c}_pct" for c in PRICE_COLS + ["gap"]), *INTRADAY_COLS, "vol_pct", "clv"]
UP_FLAGS = [*(f"{c}_up" for c in PRICE_COLS + ["gap"]), "vol_up", "clv_up"]
SUM_SERIES = ["vol", "obv_term", "ad_term", "clv_vol", "volume", "mf_pos", "mf_neg"]
PICK_SERIES = [*PRICE_COLS, "gap_f", "vol_f", "log_vol_f"]


def stat_aggregates() -> list[Column]:
    """Unconditional aggregates computed per ``(ticker, d_date, w)``."""
    aggs: list[Column] = []
    for c in STAT_SERIES:
        aggs += [F.count(c).alias(f"{c}_n"), F.avg(c).alias(f"{c}_m"), F.stddev_samp(c).alias(f"{c}_s")]
    for u in UP_FLAGS:
        aggs.append(F.count_if(F.col(u)).cast("double").alias(f"{u}_p"))
    for c in SUM_SERIES:
        aggs.append(F.sum(c).alias(f"{c}_sum"))
    for c in PICK_SERIES:
        aggs.append(F.max(c).alias(f"{c}_at"))
    aggs.append(F.count(F.lit(1)).alias("rows"))
    return aggs


@dataclass(frozen=True)
class Feature:
    name: str
    family: str
    sql: str


N_BARS = "n_bars"


def _chg(x: str, n: int) -> str:
    return f"CASE WHEN {N_BARS} > {n} THEN try_divide(m[-1].{x}_at, m[-{n + 1}].{x}_at) - 1D END"


def _mean(x: str, r: int) -> str:
    return f"CASE WHEN m[{r}].{x}_n >= {min_periods(r)} THEN m[{r}].{x}_m END"


def _std(x: str, r: int) -> str:
    return f"CASE WHEN m[{r}].{x}_n >= {min_periods(r)} THEN m[{r}].{x}_s END"


def _pos_count(flag: str, r: int) -> str:
    return f"m[{r}].{flag}_p"


def _tail_sum(x: str, n: int) -> str:
    return f"CASE WHEN {N_BARS} > {n} THEN m[{n}].{x}_sum END"


def _enough(r: int) -> str:
    return f"least({N_BARS}, {r}) >= {min_periods(r)}"


def _cmf(r: int) -> str:
    return f"CASE WHEN {_enough(r)} THEN try_divide(m[{r}].clv_vol_sum, m[{r}].volume_sum) END"


def _mfi(r: int) -> str:
    ratio = f"try_divide(m[{r}].mf_pos_sum, m[{r}].mf_neg_sum)"
    return f"CASE WHEN {_enough(r)} THEN 100D - try_divide(100D, 1D + {ratio}) END"


def _level(col: str) -> str:
    """Per-bar column whose n-bar change is reported (gap uses the padded series)."""
    return "gap_f" if col == "gap" else col


def _registry() -> list[Feature]:
    feats: list[Feature] = []
    add = lambda name, fam, sql: feats.append(Feature(name, fam, sql))
    for c in PRICE_COLS + ["gap"]:
        for n in CHANGE_WINDOWS:
            add(f"{c}_chg_{n}d", "gap_change" if c == "gap" else "price_change", _chg(_level(c), n))
    for c in PRICE_COLS + ["gap"]:
        for r in ROLLING_WINDOWS:
            family = "gap_rolling" if c == "gap" else "price_rolling"
            add(f"{c}_roll{r}_mean", family, _mean(f"{c}_pct", r))
            add(f"{c}_roll{r}_std", family, _std(f"{c}_pct", r))
            add(f"{c}_roll{r}_pos_count", family, _pos_count(f"{c}_up", r))
    for c in INTRADAY_COLS:
        for r in ROLLING_WINDOWS:
            add(f"{c}_roll{r}_mean", "intraday", _mean(c, r))
            add(f"{c}_roll{r}_std", "intraday", _std(c, r))
    for n in CHANGE_WINDOWS:
        add(f"volume_chg_{n}d", "volume_change", _chg("vol_f", n))
        add(f"volume_log_chg_{n}d", "volume_change", _chg("log_vol_f", n))
    for r in ROLLING_WINDOWS:
        add(f"volume_roll{r}_mean", "volume_rolling", _mean("vol_pct", r))
        add(f"volume_roll{r}_std", "volume_rolling", _std("vol_pct", r))
        add(f"volume_roll{r}_sum", "volume_rolling", f"m[{r}].vol_sum")
        add(f"volume_roll{r}_pos_count", "volume_rolling", _pos_count("vol_up", r))
    for r in ROLLING_WINDOWS:
        add(f"clv_roll{r}_mean", "order_flow", _mean("clv", r))
        add(f"clv_roll{r}_std", "order_flow", _std("clv", r))
        add(f"clv_roll{r}_pos_count", "order_flow", _pos_count("clv_up", r))
    for n in CHANGE_WINDOWS:
        add(f"obv_chg_{n}d", "order_flow", _tail_sum("obv_term", n))
        add(f"ad_chg_{n}d", "order_flow", _tail_sum("ad_term", n))
    for r in ORDER_FLOW_WINDOWS:
        add(f"cmf_{r}d", "order_flow", _cmf(r))
        add(f"mfi_{r}d", "order_flow", _mfi(r))
    return feats


FEATURES: list[Feature] = _registry()


def feature_names() -> list[str]:
    """All 253 engineered feature names in the reference order."""
    return [f.name for f in FEATURES]


def feature_families() -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for f in FEATURES:
        out.setdefault(f.family, []).append(f.name)
    return out


def feature_projections() -> list[str]:
    """``selectExpr`` strings producing every feature from the stat map ``m`` and ``n_bars``."""
    return [f"{f.sql} AS `{f.name}`" for f in FEATURES]
