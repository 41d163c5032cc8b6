"""The registered queries: ``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> SQL``.

Each query reads the driver tables (or data Spark derives from them) in
full.  Doubles are rounded (6 decimals; 4 for metrics) on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveil.functions.columns import round_doubles
from surveil.operators import features as feat
from surveil.operators import windows as win
from surveil.plans import fixtures as fx
from surveil.plans import oracle as osql

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def positive_zero_rounding(sql: str) -> str:
    """Rewrite every ``round(...)`` call as ``(round(...) + 0.0)``.

    DuckDB rounds tiny negatives to ``-0.0`` while Spark's decimal rounding
    gives ``0.0``; adding zero makes both IEEE ``+0.0`` so value hashes agree.
    """
    out, i, low = [], 0, sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_"):
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k = 1, j + 6
        while k < len(sql) and depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        inner = sql[j + 6:k - 1]
        out.append(sql[i:j] + "(round(" + positive_zero_rounding(inner) + ") + 0.0)")
        i = k


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = positive_zero_rounding(sql)
        return fn
    return deco


WEEK = 7

# ---------------------------------------------------------------------------
# S2 — bars
# ---------------------------------------------------------------------------


@register("s2_bars_brand", f"SELECT * FROM ({osql.BRAND_BARS_SQL}) b")
def q_bars_brand(spark, sf):
    # prices are IEEE quotients and min/max/sums of integers: bit-identical in both engines, no rounding
    return fx.brand_bars(spark, sf)


@register("s2_bars_user", f"SELECT ticker, date, {osql.r6('open')} AS open, {osql.r6('high')} AS high, "
          f"{osql.r6('low')} AS low, {osql.r6('close')} AS close, {osql.r6('volume')} AS volume FROM ({osql.USER_BARS_SQL}) b")
def q_bars_user(spark, sf):
    return round_doubles(fx.user_bars(spark, sf))


# ---------------------------------------------------------------------------
# W1/W2/W3 — windows
# ---------------------------------------------------------------------------


def brand_windows(spark, sf, lookback_bars: int):
    return win.observation_window(
        fx.brand_bars(spark, sf), fx.brand_cases(spark, sf),
        lookback_bars=lookback_bars, lookback_days=lookback_bars * WEEK, margin_days=30,
    )


def brand_candidate_windows(spark, sf, lookback_bars: int):
    w = win.candidate_windows(
        fx.brand_bars(spark, sf), fx.brand_candidates(spark, sf), fx.brand_cases(spark, sf),
        lookback_bars=lookback_bars, lookback_days=lookback_bars * WEEK, margin_days=40,
    )
    return win.attach_label(w, 0)


def _brand_window_sql(lookback_bars: int) -> str:
    return osql.window_sql(osql.BRAND_BARS_SQL, osql.BRAND_CASES_SQL, lookback_bars, lookback_bars * WEEK, 30)


def _brand_cand_window_sql(lookback_bars: int) -> str:
    return osql.candidate_window_sql(osql.BRAND_BARS_SQL, osql.BRAND_CANDIDATES_SQL, osql.BRAND_CASES_SQL,
                                     lookback_bars, lookback_bars * WEEK, 40)


_WIN_COLS = "ticker, d_date, date, label, round(open, 6) AS open, round(close, 6) AS close, round(volume, 6) AS volume"


@register("w1_windows_brand", f"SELECT {_WIN_COLS} FROM ({_brand_window_sql(90)}) w")
def q_windows_brand(spark, sf):
    return round_doubles(brand_windows(spark, sf, 90).select("ticker", "d_date", "date", "label", "open", "close", "volume"))


@register("w3_candidate_windows_brand", f"SELECT {_WIN_COLS} FROM ({_brand_cand_window_sql(90)}) w")
def q_cand_windows_brand(spark, sf):
    return round_doubles(brand_candidate_windows(spark, sf, 90).select("ticker", "d_date", "date", "label", "open", "close", "volume"))


@register("w4_min_rows_user", f"""
SELECT ticker, d_date, count(*) AS n_rows FROM (
  SELECT *, count(*) OVER (PARTITION BY ticker, d_date) AS n
  FROM ({osql.USER_WINDOWS_SQL}) w) q
WHERE n >= 25 GROUP BY ticker, d_date""")
def q_min_rows_user(spark, sf):
    return win.min_rows(fx.user_windows(spark, sf), 25).groupBy("ticker", "d_date").agg(F.count(F.lit(1)).alias("n_rows"))


# ---------------------------------------------------------------------------
# F0 — features
# ---------------------------------------------------------------------------


@register("f0_features_brand_tp90", osql.features_sql(_brand_window_sql(90)))
def q_features_brand_tp90(spark, sf):
    return round_doubles(feat.transform(brand_windows(spark, sf, 90)))


@register("f0_features_brand_all120", osql.features_sql(
    f"{_brand_window_sql(120)} UNION ALL {_brand_cand_window_sql(120)}"))
def q_features_brand_all120(spark, sf):
    w = brand_windows(spark, sf, 120).unionByName(brand_candidate_windows(spark, sf, 120))
    return round_doubles(feat.transform(w))


@register("f0_features_user", osql.features_sql(osql.USER_WINDOWS_SQL))
def q_features_user(spark, sf):
    return round_doubles(feat.transform(fx.user_windows(spark, sf)))


# ---------------------------------------------------------------------------
# V — evaluation metrics on F_score
# ---------------------------------------------------------------------------

from surveil.operators import metrics as met  # noqa: E402

_SCORES = {"lineitem": (fx.lineitem_scores, osql.LINEITEM_SCORES_SQL), "events": (fx.event_scores, osql.EVENT_SCORES_SQL)}


def _metric_queries():
    for src, (builder, ssql) in _SCORES.items():
        register(f"v1_confusion_{src}", osql.confusion_sql(ssql, "0.5"))(
            lambda spark, sf, b=builder: met.confusion(b(spark, sf), 0.5))
        register(f"v2_rates_{src}", osql.rates_sql(osql.confusion_sql(ssql, "0.3")))(
            lambda spark, sf, b=builder: met.with_rates(met.confusion(b(spark, sf), 0.3)))
        register(f"v3_v4_rank_metrics_{src}", osql.rank_metrics_sql(ssql))(
            lambda spark, sf, b=builder: met.rank_metrics(b(spark, sf)))
        register(f"v6_threshold_sweep_{src}", osql.sweep_sql(ssql, 0.05, 0.95, 19))(
            lambda spark, sf, b=builder: met.threshold_sweep(b(spark, sf)))
        register(f"v7_optimal_threshold_{src}",
                 f"SELECT * EXCLUDE (raw_threshold) FROM ({osql.sweep_sql(ssql, 0.01, 0.99, 99)}) z "
                 f"ORDER BY cost, raw_threshold LIMIT 1")(
            lambda spark, sf, b=builder: met.optimise_threshold(b(spark, sf)))
    sweep = lambda lo, hi, n: osql.sweep_sql(osql.EVENT_SCORES_SQL, lo, hi, n)
    register("v8_holdout_report_events", f"""
SELECT * EXCLUDE (raw_threshold), 'summary' AS mode FROM ({sweep(0.05, 0.95, 19)}) z
UNION ALL SELECT * EXCLUDE (raw_threshold), 'optimised' AS mode FROM (SELECT * FROM ({sweep(0.01, 0.99, 99)}) z ORDER BY cost, raw_threshold LIMIT 1) o
UNION ALL SELECT * EXCLUDE (raw_threshold), 'fixed' AS mode FROM (SELECT * FROM ({sweep(0.25, 0.75, 3)}) z WHERE raw_threshold = 0.5) f""")(
        lambda spark, sf: met.holdout_report(fx.event_scores(spark, sf), threshold=0.5))
    register("v9_pr_curve_lineitem",
             f"SELECT threshold, precision, recall, f1 FROM ({osql.sweep_sql(osql.LINEITEM_SCORES_SQL, 0.05, 0.95, 19)}) z")(
        lambda spark, sf: met.pr_curve(met.threshold_sweep(fx.lineitem_scores(spark, sf), with_rank_metrics=False)))


_metric_queries()


# ---------------------------------------------------------------------------
# C — negative matching on F_emb
# ---------------------------------------------------------------------------

from surveil.operators import matching as mt  # noqa: E402

_A = f"SELECT * FROM ({osql.EMB_ASSIGNED_SQL}) a"


def _emb_assigned(spark, sf):
    return fx.embedding_match(spark, sf)


@register("c0_c2_scaler_stats_emb", f"""
SELECT CAST(i AS INTEGER) AS i, CAST(n AS BIGINT) AS n, round(median, 6) AS median, round(q25, 6) AS q25,
       round(q75, 6) AS q75, round(scale, 6) AS scale FROM ({osql.EMB_STATS_SQL}) s WHERE n > 0""")
def q_scaler_stats(spark, sf):
    tp = fx.embedding_vectors(spark, sf).filter(F.col("label") == 0)
    st = mt.usable_features(mt.feature_stats(tp, "x"))
    out = st.select(
        F.col("i").cast("int").alias("i"), F.col("n").cast("long").alias("n"), "median", "q25", "q75",
        F.when(F.col("q75") - F.col("q25") == 0, F.lit(1.0)).otherwise(F.col("q75") - F.col("q25")).alias("scale"),
    )
    return round_doubles(out)


@register("c3_nearest_centroid_emb", f"SELECT vec_id, centroid_idx, round(distance, 6) AS distance FROM ({_A}) a")
def q_nearest(spark, sf):
    _, assigned = _emb_assigned(spark, sf)
    return round_doubles(assigned.select("vec_id", "centroid_idx", "distance"))


@register("c4_distance_cutoff_emb", f"""
SELECT vec_id, centroid_idx, round(distance, 6) AS distance FROM ({_A}) a
WHERE distance <= (SELECT quantile_cont(distance, 0.9) FROM ({_A}) b)""")
def q_cutoff(spark, sf):
    _, assigned = _emb_assigned(spark, sf)
    return round_doubles(mt.distance_cutoff(assigned, 90).select("vec_id", "centroid_idx", "distance"))


@register("c5_sample_random_emb", f"""
SELECT vec_id, centroid_idx FROM (
  SELECT *, row_number() OVER (PARTITION BY centroid_idx ORDER BY {osql.emb_hash()}, vec_id) AS r FROM ({_A}) a
) q WHERE r <= 5""")
def q_random(spark, sf):
    _, assigned = _emb_assigned(spark, sf)
    return mt.sample_random(assigned, 5, ["vec_id"]).select("vec_id", "centroid_idx")


@register("c6_sample_nearest_emb", f"""
SELECT vec_id, centroid_idx FROM (
  SELECT *, row_number() OVER (PARTITION BY centroid_idx ORDER BY distance, vec_id) AS r FROM ({_A}) a
) q WHERE r <= 5""")
def q_nearest_sample(spark, sf):
    _, assigned = _emb_assigned(spark, sf)
    return mt.sample_nearest(assigned, 5, ["vec_id"]).select("vec_id", "centroid_idx")


def _strat_sql(assigned: str, key: str, order: str) -> str:
    """C7/C9 over an assigned pool whose rows are named by ``key``; ``order`` draws inside a bin."""
    return f"""
WITH a AS ({assigned}),
e AS (SELECT centroid_idx, list_sort(list_distinct(quantile_cont(distance, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]))) AS edges,
             count(*) AS pool FROM a GROUP BY centroid_idx),
b AS (SELECT a.*, e.pool, greatest(0, len(list_filter(e.edges, lambda x: x < a.distance)) - 1) AS bin FROM a JOIN e USING (centroid_idx)),
nb AS (SELECT centroid_idx, count(DISTINCT bin) AS nbins FROM b GROUP BY centroid_idx),
r AS (SELECT b.*, greatest(1, CAST(floor(5 / nb.nbins) AS BIGINT)) AS per_bin,
             row_number() OVER (PARTITION BY b.centroid_idx, bin ORDER BY {order}, {key}) AS rk
      FROM b JOIN nb USING (centroid_idx) WHERE pool >= 10),
chosen AS (SELECT {key}, centroid_idx FROM r WHERE rk <= per_bin),
got AS (SELECT centroid_idx, count(*) AS got FROM chosen GROUP BY centroid_idx),
topup AS (SELECT {key}, centroid_idx FROM (
            SELECT r.*, row_number() OVER (PARTITION BY r.centroid_idx ORDER BY distance, {key}) AS r2, COALESCE(g.got, 0) AS got
            FROM r LEFT JOIN got g USING (centroid_idx)
            WHERE ({key}, centroid_idx) NOT IN (SELECT ({key}, centroid_idx) FROM chosen)) q
          WHERE r2 <= 5 - got),
small AS (SELECT {key}, centroid_idx FROM (
            SELECT *, row_number() OVER (PARTITION BY centroid_idx ORDER BY distance, {key}) AS r3 FROM b WHERE pool < 10) q
          WHERE r3 <= 5)
SELECT * FROM chosen UNION ALL SELECT * FROM topup UNION ALL SELECT * FROM small
"""


_STRAT_SQL = _strat_sql(_A, "vec_id", osql.emb_hash())
_CLOSER = f"(-ln({osql.unit_hash(osql.emb_hash())}) * (distance + 1e-9))"


@register("c7_c9_sample_stratified_emb", _STRAT_SQL)
def q_stratified(spark, sf):
    _, assigned = _emb_assigned(spark, sf)
    return mt.sample_stratified(assigned, 5, ["vec_id"]).select("vec_id", "centroid_idx")


@register("c10_matching_report_emb", f"""
SELECT c.centroid_idx, CAST(COALESCE(p.n_candidates, 0) AS BIGINT) AS n_candidates,
       CAST(COALESCE(s.n_selected, 0) AS BIGINT) AS n_selected, COALESCE(s.n_selected, 0) / 5.0 AS coverage,
       round(p.mean_dist, 6) AS mean_dist, round(p.median_dist, 6) AS median_dist,
       round(p.min_dist, 6) AS min_dist, round(p.max_dist, 6) AS max_dist
FROM ({osql.EMB_CENTROIDS_SQL}) c
LEFT JOIN (SELECT centroid_idx, count(*) AS n_candidates, avg(distance) AS mean_dist, median(distance) AS median_dist,
                  min(distance) AS min_dist, max(distance) AS max_dist FROM ({_A}) a GROUP BY centroid_idx) p USING (centroid_idx)
LEFT JOIN (SELECT centroid_idx, count(*) AS n_selected FROM (
             SELECT *, row_number() OVER (PARTITION BY centroid_idx ORDER BY distance, vec_id) AS r FROM ({_A}) a) q
           WHERE r <= 5 GROUP BY centroid_idx) s USING (centroid_idx)""")
def q_report(spark, sf):
    cents, assigned = _emb_assigned(spark, sf)
    sel = mt.sample_nearest(assigned, 5, ["vec_id"])
    return round_doubles(mt.matching_report(cents, assigned, sel, ratio=5))


@register("c11_pool_sizes_emb", f"SELECT centroid_idx, count(*) AS pool_size FROM ({_A}) a GROUP BY centroid_idx")
def q_pool_sizes(spark, sf):
    _, assigned = _emb_assigned(spark, sf)
    return mt.pool_sizes(assigned)


@register("c12_training_set_emb", f"""
SELECT vec_id, 1 AS label FROM embeddings WHERE label = 0
UNION ALL
SELECT vec_id, 0 AS label FROM (
  SELECT *, row_number() OVER (PARTITION BY centroid_idx ORDER BY distance, vec_id) AS r FROM ({_A}) a) q WHERE r <= 5""")
def q_training_set(spark, sf):
    cents, assigned = _emb_assigned(spark, sf)
    pos = cents.select("vec_id", F.lit(1).alias("label"))
    neg = mt.sample_nearest(assigned, 5, ["vec_id"]).select("vec_id", F.lit(0).alias("label"))
    return mt.training_set(pos, neg)


# ---------------------------------------------------------------------------
# P — scope and history; F15/F16/F18 — metadata encoding
# ---------------------------------------------------------------------------

from surveil.operators import scope as sc  # noqa: E402
from surveil.operators import analysis as an  # noqa: E402

_UB = f"({osql.USER_BARS_SQL})"
_META = f"({osql.CUSTOMER_META_SQL})"


@register("p1_filter_scope_user", f"""
SELECT ticker, date, close FROM {_UB} b WHERE ticker IN (SELECT ticker FROM {_META} m WHERE {osql.SCOPE_SQL})""")
def q_filter_scope(spark, sf):
    bars, _ = sc.filter_scope(fx.user_bars(spark, sf), fx.customer_metadata(spark, sf), fx.SCOPE_COUNTRIES, fx.SCOPE_CURRENCIES)
    return bars.select("ticker", "date", "close")


@register("p2_drop_insufficient_history_user", f"""
SELECT ticker, date FROM {_UB} b WHERE ticker IN (SELECT ticker FROM {_UB} c GROUP BY ticker HAVING count(date) >= 27)""")
def q_history(spark, sf):
    return sc.drop_insufficient_history(fx.user_bars(spark, sf), 27).select("ticker", "date")


@register("p3_p5_preprocess_metadata_user", f"""
SELECT ticker, country, currency FROM {_META} m WHERE {osql.SCOPE_SQL}
  AND ticker IN (SELECT ticker FROM {_UB} b WHERE ticker IN (SELECT ticker FROM {_META} m2 WHERE {osql.SCOPE_SQL})
                 GROUP BY ticker HAVING count(date) >= 27)""")
def q_preprocess(spark, sf):
    _, meta = sc.preprocess(fx.user_bars(spark, sf), fx.customer_metadata(spark, sf), fx.SCOPE_COUNTRIES,
                            fx.SCOPE_CURRENCIES, min_days=27)
    return meta.select("ticker", "country", "currency")


@register("p4_merge_metadata_user", f"""
SELECT b.ticker, b.date, m.country, m.currency, m.market_cap FROM {_UB} b LEFT JOIN {_META} m USING (ticker)""")
def q_merge_meta(spark, sf):
    return sc.merge_metadata(fx.user_bars(spark, sf), fx.customer_metadata(spark, sf)).select(
        "ticker", "date", "country", "currency", "market_cap")


@register("p6_dataset_summary_user", f"""
SELECT CAST(count(*) AS BIGINT) AS n_tickers, CAST(count(*) FILTER (WHERE tp) AS BIGINT) AS n_tp_tickers,
       CAST(sum(d) AS BIGINT) AS n_rows, median(d) AS median_days, min(d) AS min_days, max(d) AS max_days,
       (SELECT list_sort(list(DISTINCT country)) FROM {_META} m WHERE country IS NOT NULL) AS countries
FROM (SELECT ticker, count(date) AS d, max(label) = 1 AS tp FROM ({osql.USER_WINDOWS_SQL}) w GROUP BY ticker) t""")
def q_summary(spark, sf):
    out = sc.dataset_summary(fx.user_windows(spark, sf), fx.customer_metadata(spark, sf))
    return out.select(F.col("n_tickers").cast("long"), F.col("n_tp_tickers").cast("long"), F.col("n_rows").cast("long"),
                      F.col("median_days").cast("double"), F.col("min_days").cast("long"), F.col("max_days").cast("long"), "countries")


@register("p7_removed_keys_user", f"""
SELECT g.ticker, m.country, m.currency FROM (
  SELECT DISTINCT ticker FROM {_UB} b EXCEPT
  SELECT DISTINCT ticker FROM {_UB} b2 WHERE ticker IN (SELECT ticker FROM {_META} m WHERE {osql.SCOPE_SQL})) g
LEFT JOIN {_META} m USING (ticker)""")
def q_removed(spark, sf):
    bars = fx.user_bars(spark, sf)
    meta = fx.customer_metadata(spark, sf)
    after, _ = sc.filter_scope(bars, meta, fx.SCOPE_COUNTRIES, fx.SCOPE_CURRENCIES)
    return sc.removed_keys(bars, after, meta).select("ticker", "country", "currency")


@register("f15_f16_encode_metadata", osql.encoded_meta_sql())
def q_encode(spark, sf):
    return feat.encode_metadata(fx.customer_metadata(spark, sf), fx.metadata_category_lists(spark, sf))


@register("f18_features_with_metadata_user", f"""
SELECT f.*, e.* EXCLUDE (ticker)
FROM ({osql.features_sql(osql.USER_WINDOWS_SQL)}) f LEFT JOIN ({osql.encoded_meta_sql()}) e USING (ticker)""")
def q_features_meta(spark, sf):
    f = feat.transform(fx.user_windows(spark, sf), metadata=fx.customer_metadata(spark, sf),
                       categories=fx.metadata_category_lists(spark, sf))
    return round_doubles(f)


# ---------------------------------------------------------------------------
# E — event-aligned analysis (F_user daily windows, F_brand, F_score)
# ---------------------------------------------------------------------------

_EF = f"({osql.EVENT_FRAME_SQL})"


def _event_frame(spark, sf):
    return an.event_frame(fx.user_windows(spark, sf))


@register("e1_e3_event_frame_user", f"""
SELECT ticker, d_date, date, CAST(days_to_d AS INTEGER) AS days_to_d, round(close_norm, 6) AS close_norm,
       round(volume_norm, 6) AS volume_norm FROM {_EF} f""")
def q_event_frame(spark, sf):
    return round_doubles(_event_frame(spark, sf).select("ticker", "d_date", "date", "days_to_d", "close_norm", "volume_norm"))


@register("e4_median_trajectory_user", f"""
SELECT CAST(days_to_d AS INTEGER) AS days_to_d, round(median(close_norm), 6) AS median_close_norm FROM {_EF} f GROUP BY days_to_d""")
def q_median_traj(spark, sf):
    return round_doubles(an.median_trajectory(_event_frame(spark, sf)))


_RET = f"SELECT ticker, d_date, (arg_max(close_norm, days_to_d) - 1) * 100 AS return_pct FROM {_EF} f GROUP BY ticker, d_date"


@register("e5_window_returns_user", f"SELECT ticker, d_date, round(return_pct, 6) AS return_pct FROM ({_RET}) r")
def q_returns(spark, sf):
    return round_doubles(an.window_returns(_event_frame(spark, sf)))


@register("e5_return_summary_user", f"""
SELECT round(median(return_pct), 6) AS median_return, round(avg(return_pct), 6) AS mean_return,
       round(avg(CASE WHEN return_pct > 0 THEN 1.0 ELSE 0.0 END), 6) AS share_rising, count(*) AS n_windows FROM ({_RET}) r""")
def q_return_summary(spark, sf):
    return round_doubles(an.return_summary(an.window_returns(_event_frame(spark, sf))))


@register("e6_rolling_volume_user", f"""
SELECT ticker, d_date, CAST(days_to_d AS INTEGER) AS days_to_d,
       round(CASE WHEN count(volume_norm) OVER w >= 3 THEN avg(volume_norm) OVER w END, 6) AS volume_norm_roll10
FROM {_EF} f WINDOW w AS (PARTITION BY ticker, d_date ORDER BY days_to_d ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)""")
def q_rolling_volume(spark, sf):
    r = an.rolling_mean_by_group(_event_frame(spark, sf), "volume_norm", 10, 3)
    return round_doubles(r.select("ticker", "d_date", "days_to_d", "volume_norm_roll10"))


@register("e7_quantile_band_user", f"""
SELECT CAST(days_to_d AS INTEGER) AS days_to_d, round(quantile_cont(volume_norm, 0.5), 6) AS median,
       round(quantile_cont(volume_norm, 0.25), 6) AS q25, round(quantile_cont(volume_norm, 0.75), 6) AS q75
FROM {_EF} f GROUP BY days_to_d""")
def q_quantile_band(spark, sf):
    return round_doubles(an.quantile_band(_event_frame(spark, sf), "volume_norm"))


@register("e8_bucket_by_days_user", f"""
SELECT CAST(-91 + i * 10 AS INTEGER) AS bucket_lo, CAST(-91 + (i + 1) * 10 AS INTEGER) AS bucket_hi,
       round(median(close_norm), 6) AS median_close_norm, round(median(volume_norm), 6) AS median_volume_norm
FROM (SELECT *, CAST(ceil((days_to_d + 91) / 10) AS INTEGER) - 1 AS i FROM {_EF} f WHERE days_to_d > -91 AND days_to_d <= -1) b
GROUP BY i""")
def q_buckets(spark, sf):
    return round_doubles(an.bucket_by_days(_event_frame(spark, sf)))


@register("e9_lookback_consistency_user", f"""
SELECT CAST(lookback_days AS INTEGER) AS lookback_days, count(*) AS n_tickers, round(avg(m), 6) AS mean_vol,
       round(stddev_samp(m), 6) AS std_vol, round(CASE WHEN avg(m) > 0 THEN stddev_samp(m) / avg(m) END, 6) AS cv
FROM (SELECT lookback_days, ticker, d_date, avg(volume_norm) AS m
      FROM {_EF} f, (SELECT unnest([30, 45, 60, 90, 120]) AS lookback_days) l
      WHERE days_to_d >= -lookback_days GROUP BY lookback_days, ticker, d_date) p
GROUP BY lookback_days""")
def q_lookback(spark, sf):
    return round_doubles(an.lookback_consistency(_event_frame(spark, sf)))


_BRAND_EF = f"({osql.event_frame_sql(_brand_window_sql(120))})"


@register("e9_lookback_consistency_brand", f"""
SELECT CAST(lookback_days AS INTEGER) AS lookback_days, count(*) AS n_tickers, round(avg(m), 6) AS mean_vol,
       round(stddev_samp(m), 6) AS std_vol, round(CASE WHEN avg(m) > 0 THEN stddev_samp(m) / avg(m) END, 6) AS cv
FROM (SELECT lookback_days, ticker, d_date, avg(volume_norm) AS m
      FROM {_BRAND_EF} f, (SELECT unnest([30, 45, 60, 90, 120]) AS lookback_days) l
      WHERE days_to_d >= -lookback_days GROUP BY lookback_days, ticker, d_date) p
GROUP BY lookback_days""")
def q_lookback_brand(spark, sf):
    return round_doubles(an.lookback_consistency(an.event_frame(brand_windows(spark, sf, 120))))


@register("e10_class_imbalance_user", f"""
SELECT n_tp, CAST(floor(6000 / n_tp) AS BIGINT) AS imbalance_ratio, round(1 - n_tp / 6000, 6) AS naive_accuracy,
       round(n_tp / 3000.0, 6) AS legacy_precision FROM (SELECT count(DISTINCT ticker) AS n_tp FROM ({osql.USER_WINDOWS_SQL}) w WHERE label = 1) c""")
def q_imbalance(spark, sf):
    return round_doubles(an.class_imbalance(fx.user_windows(spark, sf).filter("label = 1"), 6000))


@register("e11_value_counts_country", f"""
SELECT COALESCE(country, 'Unknown') AS country, count(*) AS count FROM {_META} m GROUP BY 1 ORDER BY count DESC, country LIMIT 10""")
def q_value_counts(spark, sf):
    return an.value_counts(fx.customer_metadata(spark, sf), "country", 10)


@register("e12_cases_by_year_user", f"""
SELECT CAST(year(d_date) AS INTEGER) AS year, count(*) AS n_cases FROM ({osql.USER_CASES_SQL}) c
WHERE ticker IN (SELECT ticker FROM {_UB} b WHERE ticker IN (SELECT ticker FROM {_UB} h GROUP BY ticker HAVING count(*) >= 27))
GROUP BY 1""")
def q_cases_by_year(spark, sf):
    return an.cases_by_year(fx.user_cases(spark, sf), sc.drop_insufficient_history(fx.user_bars(spark, sf), 27))


@register("e13_histogram_event_value", """
SELECT bin, round(lo + span * bin / 20.0, 6) AS bin_lo, round(lo + span * (bin + 1) / 20.0, 6) AS bin_hi, count(*) AS count
FROM (SELECT least(CAST(floor((value - lo) / span * 20.0) AS INTEGER), 19) AS bin, lo, span
      FROM events, (SELECT min(value) AS lo, max(value) - min(value) AS span FROM events) r WHERE value IS NOT NULL) q
GROUP BY bin, lo, span""")
def q_histogram(spark, sf):
    return round_doubles(an.histogram(fx.table(spark, sf, "events"), "value", 20))


@register("e16_score_separation_lineitem", f"""
SELECT label, count(*) AS n, round(median(score), 6) AS median_score FROM ({osql.LINEITEM_SCORES_SQL}) s GROUP BY label""")
def q_separation(spark, sf):
    return round_doubles(an.score_separation(fx.lineitem_scores(spark, sf)))


@register("e17_detection_rate_events", f"""
SELECT count(*) AS n_positive, count(*) FILTER (WHERE score >= 0.5) AS n_detected,
       round(CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE score >= 0.5) / count(*) END, 6) AS detection_rate
FROM ({osql.EVENT_SCORES_SQL}) s WHERE label = 1""")
def q_detection(spark, sf):
    return round_doubles(an.detection_rate(fx.event_scores(spark, sf), 0.5))


@register("e19_case_summary_user", f"""
SELECT count(*) AS n_rows, count(DISTINCT ticker) AS n_tickers, min(d_date) AS first_d_date, max(d_date) AS last_d_date
FROM ({osql.USER_CASES_SQL}) c""")
def q_case_summary(spark, sf):
    return an.case_summary(fx.user_cases(spark, sf))


@register("e19_window_summary_brand", f"""
SELECT count(DISTINCT d_date) AS n_d_dates, count(*) AS n_windows, CAST(sum(n) AS BIGINT) AS n_rows, round(avg(n), 6) AS rows_per_window
FROM (SELECT ticker, d_date, count(*) AS n FROM ({_brand_window_sql(90)} UNION ALL {_brand_cand_window_sql(90)}) w
      GROUP BY ticker, d_date) p""")
def q_window_summary(spark, sf):
    w = brand_windows(spark, sf, 90).unionByName(brand_candidate_windows(spark, sf, 90))
    out = an.window_summary(w)
    return round_doubles(out.withColumn("n_rows", F.col("n_rows").cast("long")))


# ---------------------------------------------------------------------------
# A — case sourcing from text; U — candidate universe
# ---------------------------------------------------------------------------

from surveil.functions.constants import DOCUMENT_BASE_URL, TICKER_PATTERNS, TICKER_STOPWORDS  # noqa: E402
from surveil.operators import text as tx  # noqa: E402
from surveil.operators import universe as uv  # noqa: E402


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_STOP_SQL = "[" + ", ".join(_sql_str(s) for s in TICKER_STOPWORDS) + "]"


def _html_text_sql(col: str) -> str:
    x = col
    for tag in ("script", "style", "template"):
        x = f"regexp_replace({x}, {_sql_str(f'(?is)<{tag}\\b[^>]*>.*?</{tag}\\s*>')}, ' ', 'g')"
    x = f"regexp_replace({x}, '(?s)<!--.*?-->', ' ', 'g')"
    x = f"regexp_replace({x}, '(?s)<![^>]*>', ' ', 'g')"
    x = f"regexp_replace({x}, '(?s)<[^>]*>', ' ', 'g')"
    # the references that occur in the pages table; the ampersand comes last, so nothing is decoded twice
    for ent, ch in [("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&amp;", "&")]:
        x = f"replace({x}, {_sql_str(ent)}, {_sql_str(ch)})"
    return x


def _tokens_sql(col: str) -> str:
    return (f"list_sort(list_distinct(list_filter(string_split_regex({col}, '[^A-Za-z0-9_]+'), "
            f"lambda w: regexp_full_match(w, '[A-Z]{{2,5}}') AND NOT list_contains({_STOP_SQL}, w))))")


@register("a1_a2_page_symbols", f"""
SELECT page_id, length(txt) AS text_chars, unnest(CASE WHEN len(syms) = 0 THEN [NULL] ELSE syms END) AS ticker FROM (
  SELECT page_id, txt, {_tokens_sql('txt')} AS syms FROM (SELECT page_id, {_html_text_sql('html')} AS txt FROM pages) p) q""")
def q_page_symbols(spark, sf):
    pages = tx.html_to_text(fx.table(spark, sf, "pages"), "html", "txt")
    toks = tx.extract_tokens(pages, "txt")
    return toks.select("page_id", F.length("txt").alias("text_chars"), F.explode_outer("symbols").alias("ticker"))


_PATTERN_LISTS = " || ".join(f"regexp_extract_all(body, {_sql_str(p)}, 1, 'i')" for p in TICKER_PATTERNS)
_SYMBOL_SQL = "upper(translate(substr(md5(CAST(doc_id AS VARCHAR) || '{k}'), 1, {n}), '0123456789', 'GHIJKLMNOP'))"
#: A sentence made of the document's own id in each of the four ways a symbol is written.
_SENTENCE = [" (ticker: ", 1, 4, ") its trading symbol: ", 2, 3, " is traded under ", 3, 5, " and has the stock symbol ", 4, 2, " "]


def _sentence_sql() -> str:
    out, i = [], 0
    while i < len(_SENTENCE):
        out.append(_sql_str(_SENTENCE[i]))
        if i + 2 < len(_SENTENCE):
            out.append(_SYMBOL_SQL.format(k=_SENTENCE[i + 1], n=_SENTENCE[i + 2]))
        i += 3
    return " || ".join(out)


def _sentence():
    out, i = [], 0
    while i < len(_SENTENCE):
        out.append(F.lit(_SENTENCE[i]))
        if i + 2 < len(_SENTENCE):
            digest = F.md5(F.concat(F.col("doc_id").cast("string"), F.lit(str(_SENTENCE[i + 1]))))
            out.append(F.upper(F.translate(F.substring(digest, 1, _SENTENCE[i + 2]), "0123456789", "GHIJKLMNOP")))
        i += 3
    return F.concat(*out)


@register("a2_extract_symbols_documents", f"""
SELECT doc_id, unnest(syms) AS ticker FROM (
  SELECT doc_id, list_sort(list_distinct(list_filter(list_transform({_PATTERN_LISTS}, lambda s: upper(s)),
         lambda s: length(s) BETWEEN 1 AND 5 AND NOT list_contains({_STOP_SQL}, s)))) AS syms
  FROM (SELECT doc_id, text || {_sentence_sql()} AS body FROM documents) d) q""")
def q_doc_symbols(spark, sf):
    docs = fx.table(spark, sf, "documents").select("doc_id", F.concat("text", _sentence()).alias("body"))
    d = tx.extract_symbols(docs, "body")
    return d.select("doc_id", F.explode("symbols").alias("ticker"))


@register("a3_search_documents", """
SELECT doc_id, lang, filed FROM (SELECT *, CAST(DATE '2010-01-01' + CAST(doc_id % 3650 AS INTEGER) AS DATE) AS filed FROM documents) d
WHERE contains(lower(text), 'the of') AND filed BETWEEN DATE '2010-02-01' AND DATE '2015-12-31'""")
def q_search(spark, sf):
    docs = fx.table(spark, sf, "documents").withColumn(
        "filed", F.date_add(F.lit("2010-01-01").cast("date"), (F.col("doc_id") % 3650).cast("int")))
    return tx.search_documents(docs, "The of", date_col="filed", start="2010-02-01", end="2015-12-31").select("doc_id", "lang", "filed")


_HITS_SQL = f"""
SELECT doc_id, text,
       CASE WHEN doc_id % 10 = 0 THEN NULL ELSE CAST(DATE '2010-01-01' + CAST(doc_id % 3650 AS INTEGER) AS DATE) END AS case_date,
       CASE WHEN lang = 'en' THEN source ELSE upper(lang) END AS company,
       CASE WHEN doc_id % 21 = 0 THEN '' WHEN doc_id % 3 = 0 THEN '{DOCUMENT_BASE_URL}' || 'doc-' || CAST(doc_id AS VARCHAR)
            WHEN doc_id % 3 = 1 THEN '{DOCUMENT_BASE_URL}' || '/litigation/' || source || '/' || CAST(doc_id AS VARCHAR)
            ELSE 'http://' || source || '/' || CAST(doc_id AS VARCHAR) END AS case_url
FROM documents
"""


@register("a4_a5_parse_hits", f"""
SELECT doc_id AS hit_order, company, COALESCE(strftime(case_date, '%Y-%m-%d'), 'not-a-date') AS file_date, case_url
FROM ({_HITS_SQL}) h""")
def q_parse_hits(spark, sf):
    h = tx.document_url(tx.parse_hits(fx.document_hits(spark, sf)))
    return h.select("hit_order", "company", "file_date", "case_url")


@register("a6_build_cases", f"""
SELECT ticker, company, case_date, case_url FROM (
  SELECT *, row_number() OVER (PARTITION BY ticker, case_date ORDER BY doc_id, case_url, company) AS r FROM (
    SELECT doc_id, unnest({_tokens_sql('text')}) AS ticker, company, case_date, case_url FROM ({_HITS_SQL}) h) x
  WHERE case_date IS NOT NULL AND case_url <> '') q WHERE r = 1""")
def q_build_cases(spark, sf):
    h = tx.document_url(tx.parse_hits(fx.document_hits(spark, sf)))
    return tx.build_cases(tx.extract_tokens(h, "text"))


def _listing_sql(tbl: str, key: str, name: str, source: str) -> str:
    base = f"upper(substr(md5({name}), 1, 10))"
    sym = f"substr({base}, 1, CAST({key} % 6 AS INTEGER) + 1)"
    return f"""
SELECT CASE WHEN {key} % 13 = 0 THEN {sym} || 'W' WHEN {key} % 17 = 0 THEN {sym} || '.A'
            WHEN {key} % 19 = 0 THEN ' ' || lower({sym}) || ' ' ELSE {sym} END AS ticker,
       {name} AS security_name,
       CASE WHEN {key} % 9 = 0 THEN 'Y' WHEN {key} % 9 = 1 THEN NULL ELSE 'N' END AS test_issue,
       CASE WHEN {key} % 10 = 0 THEN 'Y' ELSE 'N' END AS etf, '{source}' AS source, {key} AS listing_row
FROM {tbl}"""


_LIST_SQL = (f"({_listing_sql('supplier', 's_suppkey', 's_name', 'nasdaq')} UNION ALL "
             f"{_listing_sql('customer', 'c_custkey', 'c_name', 'other')})")
_FILTERED_SQL = f"""
SELECT upper(trim(ticker)) AS ticker, security_name, source, listing_row FROM {_LIST_SQL} l
WHERE COALESCE(test_issue, '') <> 'Y' AND COALESCE(etf, '') <> 'Y'
  AND NOT regexp_matches(upper(trim(ticker)), '[.+$^~%]') AND NOT suffix(upper(trim(ticker)), 'W')
  AND NOT suffix(upper(trim(ticker)), 'R') AND NOT suffix(upper(trim(ticker)), 'P')
  AND length(upper(trim(ticker))) BETWEEN 1 AND 5"""
_KNOWN_SQL = f"SELECT DISTINCT upper(ticker) AS ticker FROM ({_listing_sql('customer', 'c_custkey', 'c_name', 'other')}) c WHERE listing_row % 25 = 0"
_DEDUP_SQL = f"""
SELECT ticker, security_name, source, listing_row FROM (
  SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY CASE source WHEN 'nasdaq' THEN 1 ELSE 2 END, listing_row, security_name) AS r
  FROM ({_FILTERED_SQL}) f WHERE ticker NOT IN ({_KNOWN_SQL})) q WHERE r = 1"""


def _listings(spark, sf):
    return [fx.supplier_listing(spark, sf), fx.customer_listing(spark, sf)]


@register("u1_u3_filtered_listings", f"SELECT ticker, source, listing_row FROM ({_FILTERED_SQL}) f")
def q_filtered(spark, sf):
    u = uv.filter_symbols(uv.drop_flagged(uv.union_listings(*_listings(spark, sf))))
    return u.select("ticker", "source", "listing_row")


@register("u4_u5_dedupe_universe", f"SELECT ticker, source, listing_row FROM ({_DEDUP_SQL}) d")
def q_dedupe(spark, sf):
    u = uv.filter_symbols(uv.drop_flagged(uv.union_listings(*_listings(spark, sf))))
    u = uv.dedupe_first(uv.exclude_known(u, fx.listing_known_cases(spark, sf)))
    return u.select("ticker", "source", "listing_row")


@register("u6_u7_build_universe", f"""
SELECT ticker, security_name, source FROM ({_DEDUP_SQL}) d ORDER BY md5(ticker || '42'), ticker LIMIT 50""")
def q_universe(spark, sf):
    return uv.build_universe(_listings(spark, sf), fx.listing_known_cases(spark, sf), n=50, seed=42)


# ---------------------------------------------------------------------------
# M — models (keys, folds and weights have SQL; of the fits, what must hold for any of them)
# ---------------------------------------------------------------------------

from surveil.functions.registry import feature_names  # noqa: E402
from surveil.operators import forest as fr  # noqa: E402
from surveil.operators import model as md  # noqa: E402

_BRAND_FEATS_SQL = osql.features_sql(f"{_brand_window_sql(120)} UNION ALL {_brand_cand_window_sql(120)}")


def supplier_feature_sets(spark, sf):
    """Case and candidate feature matrices of F_sup (lookback 90), checkpointed once per query; they grow with the data."""
    both = md.cut_lineage(feat.transform(fx.supplier_windows(spark, sf)))
    return both.filter(F.col("label") == 1), both.filter(F.col("label") == 0)


@register("m4_class_weights_brand", f"""
SELECT ticker, d_date, label, round(count(*) OVER () / (2.0 * count(*) OVER (PARTITION BY label)), 6) AS weight
FROM ({_BRAND_FEATS_SQL}) f""")
def q_class_weights(spark, sf):
    w = feat.transform(brand_windows(spark, sf, 120).unionByName(brand_candidate_windows(spark, sf, 120)))
    return round_doubles(md.class_weights(w.select("ticker", "d_date", "label")))


@register("m9_fold_membership_brand", f"""
SELECT f.fold, x.ticker, x.d_date, x.label, CASE WHEN x.d_date = f.fold THEN 'test' ELSE 'train' END AS role
FROM ({_BRAND_FEATS_SQL}) x, (SELECT DISTINCT d_date AS fold FROM ({osql.BRAND_CASES_SQL}) c) f""")
def q_folds(spark, sf):
    w = feat.transform(brand_windows(spark, sf, 120).unionByName(brand_candidate_windows(spark, sf, 120)))
    folds = md.fold_dates(w.filter(F.col("label") == 1))
    return md.leave_one_group_out(w.select("ticker", "d_date", "label"), folds).select("fold", "ticker", "d_date", "label", "role")


def supplier_keys(spark, sf):
    """Keys of the supplier feature matrix, staged as they are read twice; its features are pruned from the plan."""
    return md.cut_lineage(feat.transform(fx.supplier_windows(spark, sf)).select("ticker", "d_date", "label"))


@register("m4_class_weights_sup", f"""
SELECT ticker, d_date, label, round(count(*) OVER () / (2.0 * count(*) OVER (PARTITION BY label)), 6) AS weight
FROM ({osql.SUP_KEYS_SQL}) f""")
def q_class_weights_sup(spark, sf):
    return round_doubles(md.class_weights(supplier_keys(spark, sf)))


@register("m9_fold_membership_sup", f"""
SELECT f.fold, x.ticker, x.d_date, x.label, CASE WHEN x.d_date = f.fold THEN 'test' ELSE 'train' END AS role
FROM ({osql.SUP_KEYS_SQL}) x, (SELECT DISTINCT d_date AS fold FROM ({osql.SUP_KEYS_SQL}) c WHERE label = 1) f""")
def q_folds_sup(spark, sf):
    keys = supplier_keys(spark, sf)
    folds = md.fold_dates(keys.filter(F.col("label") == 1))
    return md.leave_one_group_out(keys, folds).select("fold", "ticker", "d_date", "label", "role")


@register("m1_m3_isolation_forest_emb", "SELECT vec_id, label, true AS in_bounds, true AS same_again FROM embeddings")
def q_forest(spark, sf):
    """Scores of all rows: inside (0, 1], and the same from a second fit on rows dealt out otherwise."""
    emb = fx.embedding_vectors(spark, sf)
    base = emb.filter(F.col("label") != 0)
    scaled = lambda df: mt.apply_scaler(df, stats)
    stats = mt.fit_scaler(base, "x")
    scored = fr.score_forest(scaled(emb), fr.fit_forest(scaled(base), ["vec_id"], "z"), "z")
    again = fr.score_forest(scaled(emb), fr.fit_forest(scaled(base.repartition(7, "vec_id")), ["vec_id"], "z"), "z", out="again")
    both = scored.select("vec_id", "label", fr.SCORE_COL).join(again.select("vec_id", "again"), "vec_id")
    return both.select("vec_id", "label", ((F.col(fr.SCORE_COL) > 0) & (F.col(fr.SCORE_COL) <= 1)).alias("in_bounds"),
                       (F.col(fr.SCORE_COL) == F.col("again")).alias("same_again"))


_FOLDS_SQL = f"(SELECT DISTINCT d_date FROM ({osql.SUP_KEYS_SQL}) k WHERE label = 1)"
#: A fold needs positives of another date to train on.
_TESTED_SQL = f"""SELECT ticker, d_date, label FROM ({osql.SUP_KEYS_SQL}) k
WHERE d_date IN {_FOLDS_SQL} AND (SELECT count(*) FROM {_FOLDS_SQL} f) > 1"""


@register("m10_cross_validate_oof_sup", f"""
SELECT d_date AS fold, ticker, d_date, label AS true_label, true AS in_range FROM ({_TESTED_SQL}) t""")
def q_cv(spark, sf):
    tp, tn = supplier_feature_sets(spark, sf)
    oof = md.cross_validate(tp, tn, feature_names())
    return oof.select("fold", "ticker", "d_date", "true_label", F.col("pred_proba").between(0, 1).alias("in_range"))


def _final(spark, sf):
    tp, tn = supplier_feature_sets(spark, sf)
    return tp.unionByName(tn), md.fit_final(tp, tn, feature_names(), threshold=0.5)


@register("m5_m8_tree_rules_sup", f"SELECT ticker, d_date, label, 1 AS n_rules, true AS agrees FROM ({osql.SUP_KEYS_SQL}) k")
def q_rules(spark, sf):
    """Every row of the matrix meets exactly one rule, and the rule says what the tree says."""
    feats, fm = _final(spark, sf)
    scored = md.score(fm, feats).withColumnRenamed("fraud_proba", "_p")
    rules = [(F.expr(r["rule"]), r["p_positive"]) for r in fm.rules(spark).collect()]  # a row per leaf
    met_ = sum((F.coalesce(rule, F.lit(False)).cast("int") for rule, _ in rules), F.lit(0))
    said = F.coalesce(*[F.when(rule, F.lit(p)) for rule, p in rules])
    return scored.select("ticker", "d_date", "label", met_.alias("n_rules"), (F.abs(said - F.col("_p")) < 1e-9).alias("agrees"))


@register("m7_top_features_sup", "SELECT true AS sums_to_one, true AS named_in_rules")
def q_importances(spark, sf):
    """Importances sum to one (or the tree is a leaf), and every feature that counts occurs in a rule."""
    _, fm = _final(spark, sf)
    used = fm.importances(spark).filter("importance > 0")
    rules = fm.rules(spark).agg(F.concat_ws(" ", F.collect_list("rule")).alias("rules"))
    out = used.crossJoin(F.broadcast(rules)).agg(
        F.coalesce(F.abs(F.sum("importance") - 1) < 1e-6, F.lit(True)).alias("sums_to_one"),
        F.coalesce(F.every(F.contains("rules", F.concat(F.lit("`"), "feature", F.lit("`")))), F.lit(True)).alias("named_in_rules"))
    return out


@register("m11_m12_train_and_score_sup", f"SELECT ticker, d_date, label, true AS in_range, true AS flagged_right FROM ({osql.SUP_KEYS_SQL}) k")
def q_train(spark, sf):
    """One training run (CV, threshold, final fit), then scores and flags of all rows."""
    tp, tn = supplier_feature_sets(spark, sf)
    run = md.train(tp, tn, feature_names())
    out = md.score(run.model, tp.unionByName(tn), use_threshold=True)
    p, flag = F.col("fraud_proba"), F.col("fraud_flag")
    return out.select("ticker", "d_date", "label", p.between(0, 1).alias("in_range"),
                      (flag == (p >= run.model.threshold).cast("int")).alias("flagged_right"))


# ---------------------------------------------------------------------------
# C on the feature matrix: lookback 90 leaves all-NULL columns (dropped) and NULL values (filled with medians)
# ---------------------------------------------------------------------------

_BRAND90_SQL = osql.features_sql(f"{_brand_window_sql(90)} UNION ALL {_brand_cand_window_sql(90)}")
_FM = osql.matched_features_sql(_BRAND90_SQL, feature_names())
_FA = f"SELECT * FROM ({_FM}) a"
_FM_HASH = "md5(concat_ws(chr(1), ticker, CAST(d_date AS VARCHAR), '42'))"


def _feature_matrix(spark, sf):
    w = brand_windows(spark, sf, 90).unionByName(brand_candidate_windows(spark, sf, 90))
    return mt.as_vector(md.cut_lineage(round_doubles(feat.transform(w))), feature_names())


def _feature_match(spark, sf):
    m = _feature_matrix(spark, sf).select("ticker", "d_date", "label", "x")
    tp = m.filter("label = 1")
    stats = mt.fit_scaler(tp)
    cents = mt.index_centroids(mt.apply_scaler(tp, stats), md.KEY)
    return mt.nearest_centroid(mt.apply_scaler(m.filter("label = 0"), stats), cents, md.KEY, md.KEY).select(
        "ticker", "d_date", "centroid_idx", "distance")


@register("c0_c2_scaler_stats_features_brand", osql.feature_stats_sql(_BRAND90_SQL, feature_names()))
def q_feature_stats(spark, sf):
    st = mt.usable_features(mt.feature_stats(_feature_matrix(spark, sf).filter("label = 1")))
    names = F.array(*[F.lit(n) for n in feature_names()])
    return round_doubles(st.select(names[F.col("i")].alias("feature"), F.col("n").cast("long").alias("n"), "median", "q25", "center", "q75"))


@register("c3_nearest_centroid_features_brand", f"SELECT ticker, d_date, centroid_idx, round(distance, 6) AS distance FROM ({_FA}) a")
def q_feature_nearest(spark, sf):
    return round_doubles(_feature_match(spark, sf))


@register("c4_distance_cutoff_features_brand", f"""
SELECT ticker, d_date, centroid_idx FROM ({_FA}) a WHERE distance <= (SELECT quantile_cont(distance, 0.5) FROM ({_FA}) b)""")
def q_feature_cutoff(spark, sf):
    return mt.distance_cutoff(md.cut_lineage(_feature_match(spark, sf)), 50).select("ticker", "d_date", "centroid_idx")


for _name, _order, _draw in (("c5_sample_random", _FM_HASH, mt.sample_random), ("c6_sample_nearest", "distance", mt.sample_nearest)):
    register(f"{_name}_features_brand", f"""
SELECT ticker, d_date, centroid_idx FROM (
  SELECT *, row_number() OVER (PARTITION BY centroid_idx ORDER BY {_order}, ticker, d_date) AS r FROM ({_FA}) a) q WHERE r <= 5""")(
        lambda spark, sf, draw=_draw: draw(_feature_match(spark, sf), 5, md.KEY).select("ticker", "d_date", "centroid_idx"))


@register("c7_c9_sample_stratified_features_brand", _strat_sql(_FA, "ticker, d_date", _FM_HASH))
def q_feature_stratified(spark, sf):
    return mt.sample_stratified(_feature_match(spark, sf), 5, md.KEY).select("ticker", "d_date", "centroid_idx")


# ---------------------------------------------------------------------------
# ST — streaming (file stream with availableNow → parquet sink, read back)
# ---------------------------------------------------------------------------

from surveil.streaming import bars as stb  # noqa: E402
from surveil.streaming import stateful as st  # noqa: E402


@register("st1_stream_bars_user", f"SELECT * FROM ({osql.USER_BARS_SQL}) b")
def q_stream_bars(spark, sf):
    """Events arrive in several micro-batches, some a day late; after a closing batch the stream equals the batch bars."""
    ev = fx.table(spark, sf, "events")
    path = st.arrivals(ev, "events", "ts", late=F.col("event_id") % 7 == 0, close={"user_id": -1})
    out = scratch_path(spark, "stream-bars")
    with stb.utc(spark):
        st.feed(spark, [(path, ev.schema)], lambda ticks: stb.bars_to(ticks, out, key="user_id", ts="ts", price="value", size=None,
                                                                  order_cols=["event_id"]))
    return spark.read.parquet(out).filter(F.col("ticker") != "-1")


@register("t3_stream_sessions_events", osql.sessions_sql(osql.EVENT_TICKS_SQL, "6 HOURS"))
def q_stream_sessions(spark, sf):
    """The sessions of the batch query from a stream with late ticks."""
    ev = fx.table(spark, sf, "events").withColumn("ticker", F.col("user_id").cast("string"))
    path = st.arrivals(ev, "ticks", "ts", late=F.col("event_id") % 7 == 0, close={"ticker": "-1"})
    out = scratch_path(spark, "stream-sessions")
    with stb.utc(spark):
        st.feed(spark, [(path, ev.schema)], lambda ticks: st.append_to(st.stream_sessions(ticks, ["ticker"], "ts", 6 * 3600, "value"), out))
    return spark.read.parquet(out).filter(F.col("ticker") != "-1")


def _bar_arrivals(spark, sf):
    """Daily bars of users as a stream in which some come a day late, and the cases, whose D-dates follow the last events."""
    bars = fx.user_bars(spark, sf)
    late = F.pmod(F.xxhash64("ticker", "date"), F.lit(7)) == 0
    return bars, st.arrivals(bars, "bars", "date", late=late, close={"ticker": "-1"})


@register("t4_stream_features_user", osql.features_sql(osql.USER_CASE_WINDOWS_SQL))
def q_stream_features(spark, sf):
    """F0 of the case windows from a stream of bars: windows kept in keyed state, closed by event-time timers."""
    bars, path = _bar_arrivals(spark, sf)
    cases = stage_table(fx.user_cases(spark, sf), "cases")  # every micro-batch reads them
    out = scratch_path(spark, "stream-features")
    with stb.utc(spark):
        st.feed(spark, [(path, bars.schema)], lambda b: st.features_to(st.stream_windows(b, cases), out), idle=False)
    return round_doubles(spark.read.parquet(out).drop("batch"))


@register("t5_stream_case_bars_user", f"SELECT ticker, date, close, d_date, label FROM ({osql.USER_CASE_WINDOWS_SQL}) w")
def q_stream_case_bars(spark, sf):
    """W1 from a stream of bars and a stream of cases, which are filed after their bars have come; trimmed when all have met."""
    bars, path = _bar_arrivals(spark, sf)
    cases = fx.user_cases(spark, sf)
    filed = st.arrivals(cases, "cases", "d_date", late=F.pmod(F.xxhash64("ticker"), F.lit(3)) == 0, close={"ticker": "-2"})
    out = scratch_path(spark, "stream-case-bars")
    with stb.utc(spark):
        st.feed(spark, [(path, bars.schema), (filed, cases.schema)], lambda b, c: st.append_to(st.stream_case_bars(b, c), out))
    return win.trim_last(spark.read.parquet(out), 90).select("ticker", "date", "close", "d_date", "label")


_SAME_SQL = f"SELECT ticker, d_date, label, true AS same FROM ({osql.SUP_KEYS_SQL}) k"


def _same_scores(feats, fm, other):
    """Whether ``other`` holds the scores and flags of the batch scorer, per row."""
    want = md.score(fm, feats, use_threshold=True).select("ticker", "d_date", "label", F.col("fraud_proba").alias("_p"), F.col("fraud_flag").alias("_f"))
    both = want.join(other.select("ticker", "d_date", "fraud_proba", "fraud_flag"), ["ticker", "d_date"], "full_outer")
    same = F.col("_p").eqNullSafe(F.col("fraud_proba")) & F.col("_f").eqNullSafe(F.col("fraud_flag"))
    return both.select("ticker", "d_date", "label", same.alias("same"))


@register("st2_stream_scores_sup", _SAME_SQL)
def q_stream_scores(spark, sf):
    feats, fm = _final(spark, sf)
    path = stb.land(feats, "features", files=4)
    return _same_scores(feats, fm, stb.run_stream_scores(spark, fm, path, feats.schema))


# ---------------------------------------------------------------------------
# Remaining inventory: readers/sinks over Spark-written landing files, F14,
# F17, E14/E15/E18, C8 and X1
# ---------------------------------------------------------------------------

from surveil.functions.registry import FEATURES  # noqa: E402
from surveil.session import scratch_path, stage_table  # noqa: E402
from surveil import sources as src  # noqa: E402


@register("s1_read_bars_user", f"SELECT ticker, date, open, high, low, close, volume FROM ({osql.USER_BARS_SQL}) b")
def q_read_bars(spark, sf):
    path = src.write_table(fx.user_bars(spark, sf), scratch_path(spark, "bars"), partition_by=["date"])
    return src.read_bars(spark, path).select("ticker", "date", "open", "high", "low", "close", "volume")


@register("s1_features_missing_volume_user", osql.features_sql(osql.window_sql(
    f"SELECT * REPLACE (CASE WHEN day(date) % 7 = 0 THEN NULL ELSE volume END AS volume) FROM ({osql.USER_BARS_SQL}) b", osql.USER_CASES_SQL, 90, 90)))
def q_missing_volume(spark, sf):
    """Bars without a volume stay bars: they count as one of a window's last bars."""
    bars = fx.user_bars(spark, sf).withColumn("volume", F.when(F.dayofmonth("date") % 7 != 0, F.col("volume")))
    path = src.write_table(bars, scratch_path(spark, "bars"))
    return round_doubles(feat.transform(win.observation_window(src.read_bars(spark, path), fx.user_cases(spark, sf), lookback_bars=90)))


@register("s3_read_cases_brand", f"""
SELECT ticker, 'Brand ' || ticker AS company, d_date, '/case/' || ticker AS case_url FROM ({osql.BRAND_CASES_SQL}) c""")
def q_read_cases(spark, sf):
    scraped = fx.brand_cases(spark, sf).select("ticker", F.concat(F.lit("Brand "), "ticker").alias("company"),
                                               F.date_format("d_date", "MM/dd/yyyy").alias("case_date"),
                                               F.concat(F.lit("/case/"), "ticker").alias("case_url"))
    path = src.write_table(scraped, scratch_path(spark, "cases"), fmt="csv")
    return src.read_cases(spark, path, "MM/dd/yyyy").select("ticker", "company", "d_date", "case_url")


@register("s4_read_metadata_customers", f"SELECT ticker, market_cap, country, currency, exchange FROM ({osql.CUSTOMER_META_SQL}) m")
def q_read_meta(spark, sf):
    meta = fx.customer_metadata(spark, sf).withColumn("market_cap", F.coalesce(F.col("market_cap").cast("string"), F.lit("N/A")))
    path = src.write_table(meta, scratch_path(spark, "meta"), fmt="csv")
    return src.read_metadata(spark, path).select("ticker", "market_cap", "country", "currency", "exchange")


def _listing_lines(listing, spark, layout: str):
    """A listing as the pipe text an exchange publishes: header, rows, trailer."""
    names = {"nasdaq": ["Symbol", "Security Name", "Test Issue", "ETF"], "other": ["ACT Symbol", "Security Name", "ETF", "Test Issue"]}[layout]
    cell = {names[0]: "ticker", "Security Name": "security_name", "Test Issue": "test_issue", "ETF": "etf"}
    row = F.concat_ws("|", *[F.coalesce(cell[n], F.lit("")) for n in names])
    edges = spark.range(1).select(F.explode(F.array(F.lit("|".join(names)), F.lit("File Creation Time: 0000000000|||"))).alias("value"))
    return listing.select(row.alias("value")).unionByName(edges)


def _read_listing_sql(tbl: str, key: str, name: str, layout: str) -> str:
    return f"""SELECT ticker, security_name, test_issue, etf, '{layout}' AS source
FROM ({_listing_sql(tbl, key, name, layout)}) l WHERE ticker IS NOT NULL AND ticker <> ''"""


@register("s5_read_listing_suppliers", _read_listing_sql("supplier", "s_suppkey", "s_name", "nasdaq"))
def q_read_listing(spark, sf):
    path = scratch_path(spark, "listing")
    # every file begins with the header, so the listing is written by as many tasks as it has
    rows = fx.supplier_listing(spark, sf).select(F.col("ticker").alias("Symbol"), F.col("security_name").alias("Security Name"),
                                                 F.col("test_issue").alias("Test Issue"), F.col("etf").alias("ETF"))
    trailer = spark.range(1).select(F.lit("File Creation Time: 0000000000").alias("Symbol"),
                                    *[F.lit(None).cast("string").alias(c) for c in rows.columns[1:]])
    rows.unionByName(trailer).write.csv(path, sep="|", header=True, ignoreLeadingWhiteSpace=False,
                                                       ignoreTrailingWhiteSpace=False)
    return src.read_listing(spark, path, "nasdaq").select("ticker", "security_name", "test_issue", "etf", "source")


@register("s5_parse_listing_customers", _read_listing_sql("customer", "c_custkey", "c_name", "other"))
def q_parse_listing(spark, sf):
    path = scratch_path(spark, "listing-lines")
    _listing_lines(fx.customer_listing(spark, sf), spark, "other").write.text(path)
    return src.parse_listing(spark.read.text(path), "other").select("ticker", "security_name", "test_issue", "etf", "source")


@register("s6_s7_build_once_bars_brand", f"SELECT * FROM ({osql.BRAND_BARS_SQL}) b")
def q_build_once(spark, sf):
    path = scratch_path(spark, "cached-bars")
    src.load_or_build(spark, path, lambda: fx.brand_bars(spark, sf), partition_by=None)
    return src.load_or_build(spark, path, lambda: fx.brand_bars(spark, sf))  # read, not built again


@register("s8_saved_model_scores_sup", _SAME_SQL)
def q_saved_model(spark, sf):
    feats, fm = _final(spark, sf)
    loaded = md.load_model(spark, md.save_model(fm, scratch_path(spark, "model")))
    return _same_scores(feats, fm, md.score(loaded, feats, use_threshold=True))


@register("f14_indicator_series_brand", osql.features_sql(_brand_window_sql(90), last_only=False))
def q_indicators(spark, sf):
    return round_doubles(feat.indicator_series(brand_windows(spark, sf, 90)))


_F17_COLS = ["close_chg_5d", "volume_roll10_sum", "clv_roll5_mean", "cmf_20d", "mfi_14d"]


@register("f17_select_features_user", f"""
SELECT ticker, d_date, label, {", ".join(_F17_COLS)} FROM ({osql.features_sql(osql.USER_WINDOWS_SQL)}) f""")
def q_select(spark, sf):
    return feat.select_features(round_doubles(feat.transform(fx.user_windows(spark, sf))), _F17_COLS)


@register("e14_null_rate_brand", f"""
UNPIVOT (SELECT {", ".join(f"round(avg(CASE WHEN {f.name} IS NULL THEN 1.0 ELSE 0.0 END), 6) AS {f.name}" for f in FEATURES)}
         FROM ({_BRAND_FEATS_SQL}) x) ON COLUMNS(*) INTO NAME feature VALUE null_rate""")
def q_null_rate(spark, sf):
    w = brand_windows(spark, sf, 120).unionByName(brand_candidate_windows(spark, sf, 120))
    return round_doubles(an.null_rate(feat.transform(w)))


_E15_COLS = ["close_roll30_mean", "volume_roll30_mean", "clv_roll30_mean", "mfi_30d", "gap_roll30_std"]
_E15_PAIRS = [(a, b) for i, a in enumerate(_E15_COLS) for b in _E15_COLS[i:]]


@register("e15_correlation_matrix_user", " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM ({osql.features_sql(osql.USER_WINDOWS_SQL, digits=12)}) f"
    for a, b in _E15_PAIRS))
def q_corr(spark, sf):
    f = round_doubles(feat.transform(fx.user_windows(spark, sf)), 12)
    return round_doubles(an.correlation_matrix(f, _E15_COLS))


#: The notebook's groups, written out by name.
_GROUPS_SQL = """CASE WHEN regexp_matches(feature, '^(open|high|low|close)_chg') THEN 'price_change'
  WHEN feature LIKE 'gap_chg%' THEN 'gap_change'
  WHEN regexp_matches(feature, '^(open|high|low|close)_roll') THEN 'price_rolling'
  WHEN feature LIKE 'gap_roll%' THEN 'gap_rolling'
  WHEN regexp_matches(feature, '^(intraday|close_minus_open|high_minus|close_minus_low)') THEN 'intraday'
  WHEN feature LIKE 'volume_chg%' OR feature LIKE 'volume_log%' THEN 'volume_change'
  WHEN feature LIKE 'volume_roll%' THEN 'volume_rolling'
  WHEN regexp_matches(feature, '^(clv|obv|ad|cmf|mfi)_') THEN 'order_flow' END"""


@register("e18_feature_group_counts_brand", f"""
SELECT {_GROUPS_SQL} AS family, count(*) AS n_features, count(*) FILTER (WHERE n > 0) AS n_populated
FROM (UNPIVOT (SELECT count(COLUMNS(* EXCLUDE (ticker, d_date, label))) FROM ({_BRAND_FEATS_SQL}) x) ON COLUMNS(*) INTO NAME feature VALUE n) c
GROUP BY 1""")
def q_groups(spark, sf):
    w = brand_windows(spark, sf, 120).unionByName(brand_candidate_windows(spark, sf, 120))
    return an.feature_group_counts(feat.transform(w))


@register("c8_closer_weighted_emb", _strat_sql(_A, "vec_id", _CLOSER))
def q_closer_weighted(spark, sf):
    _, assigned = _emb_assigned(spark, sf)
    return mt.sample_stratified(assigned, 5, ["vec_id"], bin_weights="closer_weighted").select("vec_id", "centroid_idx")


@register("x1_streak_features_user", osql.streaks_sql(osql.USER_WINDOWS_SQL))
def q_streaks(spark, sf):
    return feat.streak_features(fx.user_windows(spark, sf))


# ---------------------------------------------------------------------------
# X2 / X3 — configuration grid and lookback comparison
# ---------------------------------------------------------------------------

_X3_LOOKBACKS = [30, 45, 60, 90, 120]


def _x3_sql() -> str:
    parts = []
    for lb in _X3_LOOKBACKS:
        trimmed = f"SELECT * FROM ({_brand_window_sql(120)} UNION ALL {_brand_cand_window_sql(120)}) w WHERE rn <= {lb}"
        parts.append(f"SELECT {lb} AS lookback, * FROM ({osql.features_sql(trimmed)}) f")
    return " UNION ALL ".join(parts)


@register("x3_multi_lookback_features_brand", _x3_sql())
def q_multi_lookback(spark, sf):
    w = brand_windows(spark, sf, 120).unionByName(brand_candidate_windows(spark, sf, 120))
    return round_doubles(feat.transform(win.multi_lookback_windows(w, _X3_LOOKBACKS), key=["lookback", "ticker", "d_date"]))


def _compared_sql(settings: str, columns: str) -> str:
    """Per setting the rows that cross-validation must score, and whether the metrics agree."""
    return f"""
SELECT {columns}, n_rows, n_positive, true AS agrees
FROM (SELECT count(*) AS n_rows, count(*) FILTER (WHERE label = 1) AS n_positive FROM ({_TESTED_SQL}) t) n, (VALUES {settings}) v({columns})
WHERE n_rows > 0"""


def _agrees(spark, oof, by: list[str]):
    """The operator's metrics against others computed in plain SQL: mid-ranks for ROC-AUC, a join of thresholds for AP."""
    oof = md.cut_lineage(oof)
    oof.createOrReplaceTempView("compared_oof")
    g, same = ", ".join(by), lambda a, b: " AND ".join(f"{a}.{c} = {b}.{c}" for c in by)
    plain = spark.sql(f"""
      WITH r AS (SELECT {g}, true_label AS y, pred_proba AS s,
                        rank() OVER (PARTITION BY {g} ORDER BY pred_proba)
                        + (count(*) OVER (PARTITION BY {g}, pred_proba) - 1) / 2.0D AS mid FROM compared_oof),
           u AS (SELECT {g}, sum(y) AS p, count(*) - sum(y) AS n, sum(CASE WHEN y = 1 THEN mid END) AS ranks FROM r GROUP BY {g}),
           d AS (SELECT {g}, s, sum(y) AS pos, count(*) AS rows FROM r GROUP BY {g}, s),
           a AS (SELECT {', '.join('d.' + c for c in by)}, d.s, first(d.pos) AS pos, sum(e.pos) AS tp, sum(e.rows) AS pred
                 FROM d JOIN d e ON {same('d', 'e')} AND e.s >= d.s GROUP BY {', '.join('d.' + c for c in by)}, d.s)
      SELECT {', '.join('u.' + c for c in by)}, first((u.ranks - u.p * (u.p + 1) / 2.0D) / (u.p * u.n)) AS auc, sum(a.pos * a.tp / a.pred) / first(u.p) AS ap
      FROM u JOIN a ON {same('u', 'a')} GROUP BY {', '.join('u.' + c for c in by)}""")
    near = lambda a, b: F.abs(F.col(a) - F.col(b)) < 6e-5
    both = md.compared(oof, by).join(plain, by)
    return both.select(*by, "n_rows", "n_positive", F.coalesce(near("roc_auc", "auc") & near("pr_auc", "ap"), F.lit(False)).alias("agrees"))


def _lookback_features(spark, sf):
    w = win.multi_lookback_windows(fx.supplier_windows(spark, sf, 120), _X3_LOOKBACKS)
    return md.cut_lineage(feat.transform(w, key=["lookback", "ticker", "d_date"]))


@register("x3_lookback_comparison_sup")
def q_lookback_cmp(spark, sf):
    return md.lookback_comparison(_lookback_features(spark, sf), feature_names())


@register("x3_lookback_comparison_checked_sup", _compared_sql(", ".join(f"({lb})" for lb in _X3_LOOKBACKS), "lookback"))
def q_lookback_checked(spark, sf):
    return _agrees(spark, md.lookback_oof(_lookback_features(spark, sf), feature_names()), ["lookback"])


_X2_GRID = [(m, r) for m in ("distance_ranked", "random", "stratified") for r in (3, 5)]
_X2_METHODS, _X2_RATIOS = sorted({m for m, _ in _X2_GRID}), sorted({r for _, r in _X2_GRID})


@register("x2_grid_search_sup")
def q_grid(spark, sf):
    tp, tn = supplier_feature_sets(spark, sf)
    return md.grid_search(tp, tn, feature_names(), _X2_METHODS, _X2_RATIOS)


@register("x2_grid_search_checked_sup", _compared_sql(", ".join(f"('{m}', {r})" for m, r in _X2_GRID), "method, ratio"))
def q_grid_checked(spark, sf):
    tp, tn = supplier_feature_sets(spark, sf)
    return _agrees(spark, md.grid_oof(tp, tn, feature_names(), _X2_METHODS, _X2_RATIOS), ["method", "ratio"])


@register("e17_ranked_positives_events", f"""
SELECT event_id, round(score, 6) AS score FROM (
  SELECT event_id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS label, value / 500 AS score FROM events) s
WHERE label = 1""")
def q_ranked_positives(spark, sf):
    return round_doubles(an.ranked_positives(fx.event_scores(spark, sf)).select("event_id", "score"))


@register("v9_cost_curve_events",
          f"SELECT threshold, cost, fp, fn FROM ({osql.sweep_sql(osql.EVENT_SCORES_SQL, 0.01, 0.99, 99)}) z")
def q_cost_curve(spark, sf):
    return met.cost_curve(met.threshold_sweep(fx.event_scores(spark, sf), met.optimiser_thresholds(), with_rank_metrics=False))
