"""Hand-written DuckDB SQL used as the correctness oracle for ``queries()``.

The feature oracle is deliberately a *different formulation* from the Spark
operators: per-bar rolling statistics over real ``ROWS BETWEEN`` frames, read
at the last bar, and cumulative OBV/AD differenced with ``lag`` — so the
"tail aggregate = last row of a rolling frame" identity is itself tested.
Doubles are rounded to 6 decimals on both sides.
"""

from __future__ import annotations

from surveil.functions.constants import (
    CHANGE_WINDOWS,
    INTRADAY_COLS,
    ORDER_FLOW_WINDOWS,
    PRICE_COLS,
    ROLLING_WINDOWS,
    min_periods,
)

LINEITEM_ORDER_SQL = (
    "l.l_shipdate, l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice, "
    "l.l_quantity, l.l_discount, l.l_tax, l.l_returnflag, l.l_linestatus"
)

BRAND_BARS_SQL = f"""
SELECT ticker, date, max(CASE WHEN k=1 THEN px END) AS open, max(px) AS high, min(px) AS low,
       max(CASE WHEN k=n THEN px END) AS close, sum(size) AS volume
FROM (SELECT p.p_brand AS ticker, CAST(date_trunc('week', l.l_shipdate) AS DATE) AS date,
             l.l_extendedprice/l.l_quantity AS px, l.l_quantity AS size,
             row_number() OVER (PARTITION BY p.p_brand, date_trunc('week', l.l_shipdate)
               ORDER BY {LINEITEM_ORDER_SQL}) AS k,
             count(*) OVER (PARTITION BY p.p_brand, date_trunc('week', l.l_shipdate)) AS n
      FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey) q
GROUP BY ticker, date
"""

USER_BARS_SQL = """
SELECT CAST(user_id AS VARCHAR) AS ticker, CAST(ts AS DATE) AS date, max(CASE WHEN k=1 THEN value END) AS open,
       max(value) AS high, min(value) AS low, max(CASE WHEN k=n THEN value END) AS close,
       CAST(count(*) AS DOUBLE) AS volume
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS k,
             count(*) OVER (PARTITION BY user_id, CAST(ts AS DATE)) AS n FROM events) q
GROUP BY user_id, CAST(ts AS DATE)
"""

SUP_BARS_SQL = f"""
SELECT CAST(ticker AS VARCHAR) AS ticker, date, max(CASE WHEN k=1 THEN px END) AS open, max(px) AS high,
       min(px) AS low, max(CASE WHEN k=n THEN px END) AS close, sum(size) AS volume
FROM (SELECT l.l_suppkey AS ticker, CAST(l.l_shipdate AS DATE) AS date,
             l.l_extendedprice/l.l_quantity AS px, l.l_quantity AS size,
             row_number() OVER (PARTITION BY l.l_suppkey, CAST(l.l_shipdate AS DATE) ORDER BY {LINEITEM_ORDER_SQL}) AS k,
             count(*) OVER (PARTITION BY l.l_suppkey, CAST(l.l_shipdate AS DATE)) AS n
      FROM lineitem l) q
GROUP BY ticker, date
"""

BRAND_CASES_SQL = """
SELECT DISTINCT p_brand AS ticker, DATE '1998-01-01' + CAST(substr(p_brand, 7) AS INT) * 30 AS d_date, 1 AS label
FROM part WHERE CAST(substr(p_brand, 7) AS INT) % 5 = 0
"""

BRAND_CANDIDATES_SQL = """
SELECT DISTINCT p_brand AS ticker FROM part WHERE CAST(substr(p_brand, 7) AS INT) % 5 <> 0
"""

USER_CASES_SQL = """
SELECT CAST(user_id AS VARCHAR) AS ticker, max(CAST(ts AS DATE)) + 6 AS d_date, 1 AS label
FROM events WHERE user_id % 4 = 0 GROUP BY user_id
"""

SUP_CASES_SQL = """
SELECT CAST(s_suppkey AS VARCHAR) AS ticker, DATE '1998-01-01' + CAST(s_suppkey AS INT) AS d_date, 1 AS label
FROM supplier WHERE s_suppkey % 20 = 0
"""


def r6(expr: str, digits: int = 6) -> str:
    return f"round(CAST({expr} AS DOUBLE), {digits})"


def window_sql(bars_sql: str, cases_sql: str, lookback_bars: int, lookback_days: int, margin_days: int = 30, buffer_days: int = 5) -> str:
    """Cases joined to bars over ``[D - lookback_days - margin, D - buffer]``, last ``lookback_bars`` rows."""
    return f"""
SELECT * FROM (
  SELECT b.ticker, b.date, b.open, b.high, b.low, b.close, b.volume, c.d_date, c.label,
         row_number() OVER (PARTITION BY b.ticker, c.d_date ORDER BY b.date DESC) AS rn
  FROM ({bars_sql}) b JOIN ({cases_sql}) c
    ON b.ticker = c.ticker AND b.date BETWEEN c.d_date - {lookback_days + margin_days} AND c.d_date - {buffer_days}
) w WHERE rn <= {lookback_bars}
"""


def candidate_window_sql(bars_sql: str, candidates_sql: str, dates_sql: str, lookback_bars: int, lookback_days: int,
                         margin_days: int = 40, buffer_days: int = 5) -> str:
    return f"""
SELECT * FROM (
  SELECT b.ticker, b.date, b.open, b.high, b.low, b.close, b.volume, d.d_date, 0 AS label,
         row_number() OVER (PARTITION BY b.ticker, d.d_date ORDER BY b.date DESC) AS rn
  FROM ({bars_sql}) b JOIN (SELECT DISTINCT d_date FROM ({dates_sql}) dd) d
    ON b.date BETWEEN d.d_date - {lookback_days + margin_days} AND d.d_date - {buffer_days}
  WHERE b.ticker IN (SELECT ticker FROM ({candidates_sql}) cc)
) w WHERE rn <= {lookback_bars}
"""


def _frame(r: int) -> str:
    return f"(w ROWS BETWEEN {r - 1} PRECEDING AND CURRENT ROW)"


def series_sql(windows_sql: str) -> str:
    """Per-bar intermediate series (gap, pct changes, CLV, OBV/AD lines, money flow) inside each window."""
    up = lambda cur, prev: f"CASE WHEN {prev} = 0 THEN {cur} > 0 ELSE {cur} / {prev} - 1 > 0 END"
    pctf = lambda cur, prev: f"({cur} / NULLIF({prev}, 0) - 1)"
    s1 = f"""
SELECT *, lag(open) OVER w AS p_open, lag(close) OVER w AS p_close, lag(high) OVER w AS p_high, lag(low) OVER w AS p_low,
       NULLIF(volume, 0) AS vol,
       last_value(NULLIF(volume, 0) IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS vol_f,
       last_value(NULLIF(volume, 0) IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p_vol_f,
       (high + low + close) / 3 AS tp, lag((high + low + close) / 3) OVER w AS p_tp,
       (2 * close - high - low) / NULLIF(high - low, 0) AS clv,
       count(*) OVER (PARTITION BY ticker, d_date) AS n_bars
FROM ({windows_sql}) x WINDOW w AS (PARTITION BY ticker, d_date ORDER BY date)
"""
    s2 = f"""
SELECT *, (open - p_close) / NULLIF(p_close, 0) AS gap,
       (high - low) / NULLIF(close, 0) AS intraday_range, (close - open) / NULLIF(open, 0) AS close_minus_open,
       (high - close) / NULLIF(close, 0) AS high_minus_close, (close - low) / NULLIF(close, 0) AS close_minus_low,
       {", ".join(f"{pctf(c, 'p_' + c)} AS {c}_pct, {up(c, 'p_' + c)} AS {c}_up" for c in PRICE_COLS)},
       {pctf('vol_f', 'p_vol_f')} AS vol_pct, {up('vol_f', 'p_vol_f')} AS vol_up,
       COALESCE(sign(close - p_close) * volume, 0) AS obv_term, COALESCE(clv, 0) * volume AS clv_vol,
       CASE WHEN tp - p_tp > 0 THEN tp * volume ELSE 0 END AS mf_pos,
       CASE WHEN tp - p_tp <= 0 THEN tp * volume ELSE 0 END AS mf_neg
FROM ({s1}) a
"""
    s3 = f"""
SELECT *, last_value(gap IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS gap_f,
       last_value(gap IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p_gap_f,
       sum(obv_term) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS obv,
       sum(clv_vol) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ad_line,
       ln(1 + last_value(NULLIF(volume, 0) IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS log_vol_f
FROM ({s2}) b WINDOW w AS (PARTITION BY ticker, d_date ORDER BY date)
"""
    return f"SELECT *, {pctf('gap_f', 'p_gap_f')} AS gap_pct, {up('gap_f', 'p_gap_f')} AS gap_up FROM ({s3}) c"


def features_sql(windows_sql: str, min_bars: int = 5, digits: int = 6, last_only: bool = True) -> str:
    """253 features per window from rolling frames read at the last bar (or, without ``last_only``, at every bar)."""
    s4 = series_sql(windows_sql)
    cols: list[str] = []
    level = {c: c for c in PRICE_COLS}
    level["gap"] = "gap_f"

    def chg(x: str, n: int) -> str:
        return f"{x} / NULLIF(lag({x}, {n}) OVER w, 0) - 1"

    def mean(x: str, r: int) -> str:
        return f"CASE WHEN count({x}) OVER {_frame(r)} >= {min_periods(r)} THEN avg({x}) OVER {_frame(r)} END"

    def std(x: str, r: int) -> str:
        return f"CASE WHEN count({x}) OVER {_frame(r)} >= {min_periods(r)} THEN stddev_samp({x}) OVER {_frame(r)} END"

    def pos(flag: str, r: int) -> str:
        return f"sum(CASE WHEN {flag} THEN 1.0 ELSE 0.0 END) OVER {_frame(r)}"

    for c in PRICE_COLS + ["gap"]:
        for n in CHANGE_WINDOWS:
            cols.append(f"{r6(chg(level[c], n), digits)} AS {c}_chg_{n}d")
    for c in PRICE_COLS + ["gap"]:
        for r in ROLLING_WINDOWS:
            cols.append(f"{r6(mean(c + '_pct', r), digits)} AS {c}_roll{r}_mean")
            cols.append(f"{r6(std(c + '_pct', r), digits)} AS {c}_roll{r}_std")
            cols.append(f"{r6(pos(c + '_up', r), digits)} AS {c}_roll{r}_pos_count")
    for c in INTRADAY_COLS:
        for r in ROLLING_WINDOWS:
            cols.append(f"{r6(mean(c, r), digits)} AS {c}_roll{r}_mean")
            cols.append(f"{r6(std(c, r), digits)} AS {c}_roll{r}_std")
    for n in CHANGE_WINDOWS:
        cols.append(f"{r6(chg('vol_f', n), digits)} AS volume_chg_{n}d")
        cols.append(f"{r6(chg('log_vol_f', n), digits)} AS volume_log_chg_{n}d")
    for r in ROLLING_WINDOWS:
        cols.append(f"{r6(mean('vol_pct', r), digits)} AS volume_roll{r}_mean")
        cols.append(f"{r6(std('vol_pct', r), digits)} AS volume_roll{r}_std")
        cols.append(f"{r6(f'sum(vol) OVER {_frame(r)}', digits)} AS volume_roll{r}_sum")
        cols.append(f"{r6(pos('vol_up', r), digits)} AS volume_roll{r}_pos_count")
    for r in ROLLING_WINDOWS:
        cols.append(f"{r6(mean('clv', r), digits)} AS clv_roll{r}_mean")
        cols.append(f"{r6(std('clv', r), digits)} AS clv_roll{r}_std")
        cols.append(f"{r6(pos('clv > 0', r), digits)} AS clv_roll{r}_pos_count")
    for n in CHANGE_WINDOWS:
        cols.append(f"{r6(f'obv - lag(obv, {n}) OVER w', digits)} AS obv_chg_{n}d")
        cols.append(f"{r6(f'ad_line - lag(ad_line, {n}) OVER w', digits)} AS ad_chg_{n}d")
    for r in ORDER_FLOW_WINDOWS:
        ok = f"count(*) OVER {_frame(r)} >= {min_periods(r)}"
        cmf = f"CASE WHEN {ok} THEN sum(clv_vol) OVER {_frame(r)} / NULLIF(sum(volume) OVER {_frame(r)}, 0) END"
        mfi = (f"CASE WHEN {ok} THEN 100 - 100 / (1 + sum(mf_pos) OVER {_frame(r)} / "
               f"NULLIF(sum(mf_neg) OVER {_frame(r)}, 0)) END")
        cols.append(f"{r6(cmf, digits)} AS cmf_{r}d")
        cols.append(f"{r6(mfi, digits)} AS mfi_{r}d")
    body = ",\n       ".join(cols)
    if not last_only:
        raw = ", ".join(f"{r6(c, digits)} AS {c}" for c in ["gap", *INTRADAY_COLS, "clv", "obv", "ad_line"])
        return f"SELECT ticker, d_date, date, {raw}, {body} FROM ({s4}) d WINDOW w AS (PARTITION BY ticker, d_date ORDER BY date)"
    return f"""
SELECT * EXCLUDE (rn_last, n_bars) FROM (
SELECT ticker, d_date, CAST(label AS INTEGER) AS label, n_bars,
       row_number() OVER (PARTITION BY ticker, d_date ORDER BY date DESC) AS rn_last,
       {body}
FROM ({s4}) d WINDOW w AS (PARTITION BY ticker, d_date ORDER BY date)
) z WHERE rn_last = 1 AND n_bars >= {min_bars}
"""


# ---------------------------------------------------------------------------
# metrics (V1–V9): brute force threshold × row comparisons
# ---------------------------------------------------------------------------

LINEITEM_SCORES_SQL = "SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label, l_discount * 10 AS score FROM lineitem"
EVENT_SCORES_SQL = "SELECT CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS label, value / 500 AS score FROM events"


def ratio4_sql(num: str, den: str) -> str:
    return f"(CASE WHEN ({den}) > 0 THEN floor((20000 * ({num}) + ({den})) / (2 * ({den}))) / CAST(10000 AS DOUBLE) ELSE 0.0 END)"


def thresholds_sql(start: float, stop: float, num: int) -> str:
    return (f"SELECT i + 1 AS j, CASE WHEN i = {num - 1} THEN CAST('{stop}' AS DOUBLE) ELSE "
            f"i * ((CAST('{stop}' AS DOUBLE) - CAST('{start}' AS DOUBLE)) / {num - 1}) + CAST('{start}' AS DOUBLE) END AS t "
            f"FROM range({num}) r(i)")


def rank_metrics_sql(scores_sql: str) -> str:
    return f"""
SELECT CASE WHEN P > 0 AND N > 0 THEN {ratio4_sql('u2', '2 * P * N')} END AS roc_auc,
       CASE WHEN P > 0 AND N > 0 THEN round(ap / P, 4) END AS pr_auc
FROM (
  SELECT sum(pos * (2 * neg_below + neg)) AS u2, sum(CASE WHEN pos > 0 THEN pos * (tp_at / (tp_at + fp_at)) END) AS ap,
         max(P) AS P, max(N) AS N
  FROM (
    SELECT *, COALESCE(sum(neg) OVER (ORDER BY score NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below,
           sum(pos) OVER (ORDER BY score DESC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp_at,
           sum(neg) OVER (ORDER BY score DESC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp_at,
           sum(pos) OVER () AS P, sum(neg) OVER () AS N
    FROM (SELECT score, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS neg
          FROM ({scores_sql}) s GROUP BY score) g
  ) c
) a
"""


def rates_sql(counts_sql: str, fp_cost: int = 1, fn_cost: int = 5) -> str:
    return f"""
SELECT *, {ratio4_sql('tp', 'tp + fp')} AS precision, {ratio4_sql('tp', 'tp + fn')} AS recall,
       {ratio4_sql('2 * tp', '2 * tp + fp + fn')} AS f1, {ratio4_sql('tn', 'tn + fp')} AS specificity,
       CAST(fp * {fp_cost} + fn * {fn_cost} AS DOUBLE) AS cost,
       {ratio4_sql(f'fp * {fp_cost} + fn * {fn_cost}', 'tp + fp + tn + fn')} AS cost_per_case,
       CAST(tp + fn AS BIGINT) AS n_positive, CAST(tn + fp AS BIGINT) AS n_negative, CAST(tp + fp + tn + fn AS BIGINT) AS n_total
FROM ({counts_sql}) k
"""


def confusion_sql(scores_sql: str, threshold: str) -> str:
    pred = f"COALESCE(score >= {threshold}, false)"
    return f"""
SELECT CAST(count(*) FILTER (WHERE {pred} AND label = 1) AS BIGINT) AS tp,
       CAST(count(*) FILTER (WHERE {pred} AND label <> 1) AS BIGINT) AS fp,
       CAST(count(*) FILTER (WHERE NOT {pred} AND label <> 1) AS BIGINT) AS tn,
       CAST(count(*) FILTER (WHERE NOT {pred} AND label = 1) AS BIGINT) AS fn
FROM ({scores_sql}) s
"""


def sweep_sql(scores_sql: str, start: float, stop: float, num: int) -> str:
    counts = f"""
SELECT j, t, CAST(count(*) FILTER (WHERE s.score >= th.t AND s.label = 1) AS BIGINT) AS tp,
       CAST(count(*) FILTER (WHERE s.score >= th.t AND s.label <> 1) AS BIGINT) AS fp,
       CAST(count(*) FILTER (WHERE NOT COALESCE(s.score >= th.t, false) AND s.label <> 1) AS BIGINT) AS tn,
       CAST(count(*) FILTER (WHERE NOT COALESCE(s.score >= th.t, false) AND s.label = 1) AS BIGINT) AS fn
FROM ({thresholds_sql(start, stop, num)}) th, ({scores_sql}) s GROUP BY j, t
"""
    return f"""
SELECT round(t, 4) AS threshold, precision, recall, f1, specificity, tp, fp, tn, fn, roc_auc, pr_auc, cost,
       cost_per_case, n_positive, n_negative, n_total, t AS raw_threshold
FROM ({rates_sql(counts)}) r, ({rank_metrics_sql(scores_sql)}) a
"""


# ---------------------------------------------------------------------------
# matching (C0–C12) on F_emb: long form + brute-force distances
# ---------------------------------------------------------------------------

EMB_LONG_SQL = """
SELECT vec_id, label, unnest(range(len(embedding))) AS i, unnest(CAST(embedding AS DOUBLE[])) AS v FROM embeddings
"""

EMB_STATS_SQL = f"""
SELECT i, count(v) AS n, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.25) AS q25, quantile_cont(v, 0.75) AS q75,
       CASE WHEN quantile_cont(v, 0.75) - quantile_cont(v, 0.25) = 0 THEN 1.0
            ELSE quantile_cont(v, 0.75) - quantile_cont(v, 0.25) END AS scale
FROM ({EMB_LONG_SQL}) l WHERE label = 0 GROUP BY i
"""

EMB_SCALED_SQL = f"""
SELECT l.vec_id, l.label, l.i, (l.v - s.median) / s.scale AS z FROM ({EMB_LONG_SQL}) l JOIN ({EMB_STATS_SQL}) s USING (i)
"""

EMB_CENTROIDS_SQL = "SELECT vec_id, CAST(row_number() OVER (ORDER BY vec_id) - 1 AS INTEGER) AS centroid_idx FROM embeddings WHERE label = 0"

EMB_ASSIGNED_SQL = f"""
SELECT vec_id, centroid_idx, distance FROM (
  SELECT t.vec_id, c.centroid_idx, sqrt(sum((t.z - cz.z) * (t.z - cz.z))) AS distance,
         row_number() OVER (PARTITION BY t.vec_id ORDER BY sqrt(sum((t.z - cz.z) * (t.z - cz.z))), c.centroid_idx) AS k
  FROM ({EMB_SCALED_SQL}) t
  JOIN ({EMB_SCALED_SQL}) cz ON t.i = cz.i AND cz.label = 0
  JOIN ({EMB_CENTROIDS_SQL}) c ON c.vec_id = cz.vec_id
  WHERE t.label <> 0
  GROUP BY t.vec_id, c.centroid_idx
) q WHERE k = 1
"""


def emb_hash(seed: int = 42) -> str:
    return f"md5(concat_ws(chr(1), CAST(vec_id AS VARCHAR), '{seed}'))"


def _long_features_sql(features_sql_: str, names: list[str]) -> str:
    """``ticker, d_date, label, feature, v``, NULL values included."""
    return (f"SELECT ticker, d_date, label, unnest([{', '.join(repr(n) for n in names)}]) AS feature, "
            f"unnest([{', '.join(names)}]) AS v FROM ({features_sql_}) x")


def feature_stats_sql(features_sql_: str, names: list[str]) -> str:
    """C0–C2 on the cases: medians, and quartiles after the NULLs are filled with them."""
    return f"""
WITH tp AS (SELECT feature, v FROM ({_long_features_sql(features_sql_, names)}) l WHERE label = 1),
m AS (SELECT feature, count(v) AS n, quantile_cont(v, 0.5) AS median FROM tp GROUP BY feature HAVING count(v) > 0),
q AS (SELECT feature, quantile_cont(coalesce(v, median), 0.25) AS q25, quantile_cont(coalesce(v, median), 0.5) AS center,
             quantile_cont(coalesce(v, median), 0.75) AS q75 FROM tp JOIN m USING (feature) GROUP BY feature)
SELECT feature, n, {r6('median')} AS median, {r6('q25')} AS q25, {r6('center')} AS center, {r6('q75')} AS q75 FROM m JOIN q USING (feature)"""


def matched_features_sql(features_sql_: str, names: list[str]) -> str:
    """C3 by brute force: every candidate's closest case in the scaled feature space."""
    return f"""
WITH l AS MATERIALIZED ({_long_features_sql(features_sql_, names)}),
m AS (SELECT feature, quantile_cont(v, 0.5) AS median FROM l WHERE label = 1 GROUP BY feature HAVING count(v) > 0),
q AS (SELECT feature, quantile_cont(coalesce(v, median), [0.25, 0.5, 0.75]) AS q FROM l JOIN m USING (feature) WHERE label = 1 GROUP BY feature),
z AS (SELECT ticker, d_date, label, feature,
             (coalesce(v, median) - q[2]) / CASE WHEN q[3] - q[1] = 0 THEN 1.0 ELSE q[3] - q[1] END AS z
      FROM l JOIN m USING (feature) JOIN q USING (feature)),
c AS (SELECT ticker, d_date, CAST(row_number() OVER (ORDER BY ticker, d_date) - 1 AS INTEGER) AS centroid_idx
      FROM (SELECT DISTINCT ticker, d_date FROM l WHERE label = 1) k),
d AS (SELECT t.ticker, t.d_date, c.centroid_idx, sqrt(sum((t.z - s.z) * (t.z - s.z))) AS distance
      FROM z t JOIN z s ON t.feature = s.feature AND s.label = 1 JOIN c ON c.ticker = s.ticker AND c.d_date = s.d_date
      WHERE t.label = 0 GROUP BY t.ticker, t.d_date, c.centroid_idx)
SELECT ticker, d_date, centroid_idx, distance FROM (
  SELECT *, row_number() OVER (PARTITION BY ticker, d_date ORDER BY distance, centroid_idx) AS k FROM d) r WHERE k = 1"""


def unit_hash(digest: str) -> str:
    """A number in (0, 1) from an md5 digest."""
    return f"((CAST('0x' || substr({digest}, 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0)"


# ---------------------------------------------------------------------------
# metadata, scope and event analysis
# ---------------------------------------------------------------------------

CUSTOMER_META_SQL = """
SELECT CAST(c_custkey AS VARCHAR) AS ticker,
       CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_acctbal * CAST(1000000 AS DOUBLE) END AS market_cap,
       CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE n_name END AS country,
       CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment END AS currency,
       r_name AS exchange
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""

SCOPE_SQL = ("(country IN ('NATION_1','NATION_6','NATION_11','NATION_16','NATION_21') OR country IS NULL) AND "
             "(currency IN ('HOUSEHOLD','MACHINERY','BUILDING') OR currency IS NULL)")

USER_CANDIDATES_SQL = "SELECT DISTINCT CAST(user_id AS VARCHAR) AS ticker FROM events WHERE user_id % 4 <> 0"
USER_CASE_WINDOWS_SQL = window_sql(USER_BARS_SQL, USER_CASES_SQL, 90, 90)
USER_WINDOWS_SQL = f"{USER_CASE_WINDOWS_SQL} UNION ALL {candidate_window_sql(USER_BARS_SQL, USER_CANDIDATES_SQL, USER_CASES_SQL, 90, 90)}"

SUP_CANDIDATES_SQL = "SELECT CAST(s_suppkey AS VARCHAR) AS ticker FROM supplier WHERE s_suppkey % 20 <> 0"
SUP_WINDOWS_SQL = (f"{window_sql(SUP_BARS_SQL, SUP_CASES_SQL, 90, 90)} UNION ALL "
                   f"{candidate_window_sql(SUP_BARS_SQL, SUP_CANDIDATES_SQL, SUP_CASES_SQL, 90, 90)}")
#: Keys of the supplier feature matrix: windows of at least 5 bars.
SUP_KEYS_SQL = f"SELECT ticker, d_date, CAST(label AS INTEGER) AS label FROM ({SUP_WINDOWS_SQL}) w GROUP BY ticker, d_date, label HAVING count(*) >= 5"

def event_frame_sql(windows_sql: str) -> str:
    return f"""
SELECT *, datediff('day', d_date, date) AS days_to_d,
       close / NULLIF(first_value(close IGNORE NULLS) OVER (PARTITION BY ticker, d_date ORDER BY date
                      ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 0) AS close_norm,
       volume / NULLIF(avg(volume) OVER (PARTITION BY ticker, d_date), 0) AS volume_norm
FROM ({windows_sql}) w
"""


EVENT_FRAME_SQL = event_frame_sql(USER_WINDOWS_SQL)


def mktcap_tier_sql(x: str = "market_cap") -> str:
    v = f"COALESCE({x}, 0)"
    return (f"CASE WHEN {v} >= 0 AND {v} < 300e6 THEN 'micro' WHEN {v} >= 300e6 AND {v} < 2e9 THEN 'small' "
            f"WHEN {v} >= 2e9 AND {v} < 10e9 THEN 'mid' WHEN {v} >= 10e9 AND {v} < 200e9 THEN 'large' "
            f"WHEN {v} >= 200e9 AND {v} < 'inf'::DOUBLE THEN 'mega' ELSE 'nan' END")


def encoded_meta_sql(n_nations: int = 25) -> str:
    tiers = ["micro", "small", "mid", "large", "mega", "nan"]
    nations = sorted([f"NATION_{i}" for i in range(n_nations)]) + ["unknown"]
    segs = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "unknown"]
    regions = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
    cols = [f"CAST(tier = '{t}' AS INTEGER) AS \"mktcap_{t}\"" for t in tiers]
    cols += [f"CAST(cty = '{n}' AS INTEGER) AS \"country_{n}\"" for n in nations]
    cols += [f"CAST(cur = '{s}' AS INTEGER) AS \"currency_{s}\"" for s in segs]
    cols += [f"CAST(exchange = '{r}' AS INTEGER) AS \"exchange_{r}\"" for r in regions]
    return f"""
SELECT ticker, {", ".join(cols)} FROM (
  SELECT ticker, {mktcap_tier_sql()} AS tier, COALESCE(country, 'unknown') AS cty, COALESCE(currency, 'unknown') AS cur, exchange
  FROM ({CUSTOMER_META_SQL}) m) e
"""


def streaks_sql(windows_sql: str) -> str:
    """Gaps-and-islands streaks and threshold counts per window."""
    return f"""
WITH b AS (
  SELECT *, row_number() OVER w AS idx, count(*) OVER (PARTITION BY ticker, d_date) AS n,
         COALESCE(close > lag(close) OVER w, false) AS up_c, COALESCE(volume > lag(volume) OVER w, false) AS up_v,
         COALESCE(close > avg(close) OVER (w ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), false) AS above,
         COALESCE(volume > 2 * avg(volume) OVER (PARTITION BY ticker, d_date), false) AS spike,
         COALESCE(close / NULLIF(lag(close) OVER w, 0) - 1 >= 0.03, false) AS large_up,
         COALESCE((high - open) / NULLIF(open, 0) >= 0.03 AND close < open, false) AS reversal
  FROM ({windows_sql}) x WINDOW w AS (PARTITION BY ticker, d_date ORDER BY date)),
g AS (SELECT *, idx - row_number() OVER (PARTITION BY ticker, d_date, up_c ORDER BY date) AS gc,
             idx - row_number() OVER (PARTITION BY ticker, d_date, up_v ORDER BY date) AS gv FROM b),
r AS (SELECT *, count(*) OVER (PARTITION BY ticker, d_date, up_c, gc) AS len_c,
             count(*) OVER (PARTITION BY ticker, d_date, up_v, gv) AS len_v FROM g)
SELECT ticker, d_date,
       CAST(COALESCE(max(CASE WHEN up_c THEN len_c END), 0) AS BIGINT) AS max_consec_up_close,
       CAST(COALESCE(max(CASE WHEN up_v THEN len_v END), 0) AS BIGINT) AS max_consec_up_volume,
       CAST(max(n) - COALESCE(max(CASE WHEN NOT up_c THEN idx END), 0) AS BIGINT) AS current_consec_up_close,
       count(*) FILTER (WHERE above) AS n_days_close_above_roll20_mean,
       count(*) FILTER (WHERE spike) AS n_days_volume_above_2x_mean,
       count(*) FILTER (WHERE large_up) AS n_large_up_days,
       count(*) FILTER (WHERE reversal) AS n_large_intraday_reversals
FROM r GROUP BY ticker, d_date
"""


def sessions_sql(rows_sql: str, gap: str) -> str:
    """Sessions of (ticker, ts, px, size)."""
    return f"""
SELECT ticker, count(*) AS n_ticks, min(ts) AS first_ts, max(ts) AS last_ts, sum(size) AS volume, min(px) AS low, max(px) AS high
FROM (SELECT *, sum(starts) OVER (PARTITION BY ticker ORDER BY ts, starts DESC ROWS UNBOUNDED PRECEDING) AS session
      FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY ticker ORDER BY ts) < INTERVAL {gap} THEN 0 ELSE 1 END AS starts
            FROM ({rows_sql}) r) q) s
GROUP BY ticker, session"""


EVENT_TICKS_SQL = "SELECT CAST(user_id AS VARCHAR) AS ticker, ts, value AS px, CAST(1 AS DOUBLE) AS size FROM events"
LINE_TICKS_SQL = ("SELECT CAST(l_suppkey AS VARCHAR) AS ticker, l_shipdate AS ts, l_extendedprice / l_quantity AS px, "
                  "l_quantity AS size FROM lineitem")
