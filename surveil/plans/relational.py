"""Registered queries of the joins over time, grouping sets, reconciliation and SQL functions, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from surveil.functions.columns import round_doubles
from surveil.functions.registry import feature_names
from surveil.functions.sql import register_scorer, register_universe
from surveil.operators import features as feat
from surveil.operators import model as md
from surveil.operators import reconcile as rec
from surveil.operators import scope as sc
from surveil.operators import temporal as tm
from surveil.plans import fixtures as fx
from surveil.plans import oracle as osql
from surveil.plans.catalog import _FILTERED_SQL, _SAME_SQL, _same_scores, register, supplier_feature_sets

# ---------------------------------------------------------------------------
# As-of joins
# ---------------------------------------------------------------------------


@register("t1_asof_previous_bar_events", f"""
SELECT e.event_id, e.ticker, b.date AS bar_date, b.close
FROM (SELECT event_id, CAST(user_id AS VARCHAR) AS ticker, CAST(ts AS DATE) AS day FROM events) e
ASOF LEFT JOIN ({osql.USER_BARS_SQL}) b ON e.ticker = b.ticker AND e.day > b.date""")
def q_asof_events(spark, sf):
    events = fx.table(spark, sf, "events").select("event_id", F.col("user_id").cast("string").alias("ticker"),
                                                  F.col("ts").cast("date").alias("day"))
    return tm.asof_join(events, fx.user_bars(spark, sf), ["ticker"], "day", "date", ["close"], strict=True,
                        matched_time="bar_date").drop("day")


@register("t1_asof_previous_bar_sup", f"""
SELECT l_orderkey, l_linenumber, ticker, CASE WHEN day - date <= 30 THEN date END AS bar_date,
       CASE WHEN day - date <= 30 THEN close END AS close
FROM (SELECT l.l_orderkey, l.l_linenumber, CAST(l.l_suppkey AS VARCHAR) AS ticker, CAST(l.l_shipdate AS DATE) AS day FROM lineitem l) l
ASOF LEFT JOIN (SELECT ticker AS t, date, close FROM ({osql.SUP_BARS_SQL}) q) b ON l.ticker = b.t AND l.day > b.date""")
def q_asof_sup(spark, sf):
    lines = fx.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_suppkey").cast("string").alias("ticker"), F.col("l_shipdate").cast("date").alias("day"))
    got = tm.asof_join(lines, fx.supplier_bars(spark, sf), ["ticker"], "day", "date", ["close"], strict=True, within_days=30,
                       matched_time="bar_date", cell_days=365)
    return got.drop("day")


#: Customers' orders as versions of their metadata: the status and priority of the last order count.
_VERSIONS_SQL = """
SELECT c.ticker, c.d_date, v.o_orderpriority, v.o_orderstatus, CAST(v.day AS DATE) AS as_of
FROM (SELECT CAST(c_custkey AS VARCHAR) AS ticker, DATE '1995-01-01' + CAST(c_custkey % 900 AS INT) AS d_date FROM customer) c
ASOF LEFT JOIN (
  SELECT ticker, day, r.p AS o_orderpriority, r.s AS o_orderstatus FROM (
    SELECT CAST(o_custkey AS VARCHAR) AS ticker, CAST(o_orderdate AS DATE) AS day,
           arg_max({'p': o_orderpriority, 's': o_orderstatus}, o_orderkey) AS r FROM orders GROUP BY ALL) q) v
ON c.ticker = v.ticker AND c.d_date >= v.day"""


@register("t1_asof_metadata_customers", _VERSIONS_SQL)
def q_asof_metadata(spark, sf):
    cases = fx.table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("ticker"),
        F.date_add(F.lit("1995-01-01").cast("date"), (F.col("c_custkey") % 900).cast("int")).alias("d_date"))
    versions = fx.table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("ticker"), "o_orderkey",
                                                    F.col("o_orderdate").cast("date").alias("day"), "o_orderpriority", "o_orderstatus")
    return tm.asof_join(cases, versions, ["ticker"], "d_date", "day", ["o_orderpriority", "o_orderstatus"], order=["o_orderkey"],
                        matched_time="as_of", cell_days=365)


# ---------------------------------------------------------------------------
# Sessions and overlapping intervals
# ---------------------------------------------------------------------------


def event_sessions(spark, sf, **kw):
    ticks = fx.table(spark, sf, "events").withColumn("ticker", F.col("user_id").cast("string"))
    return tm.sessions(ticks, ["ticker"], "ts", 6 * 3600, "value", **kw)


@register("t3_sessions_events", osql.sessions_sql(osql.EVENT_TICKS_SQL, "6 HOURS"))
def q_sessions_events(spark, sf):
    return event_sessions(spark, sf)


@register("t3_sessions_sup", osql.sessions_sql(osql.LINE_TICKS_SQL, "4 DAYS"))
def q_sessions_sup(spark, sf):
    ticks = fx.table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("ticker"), "l_shipdate", (F.col("l_extendedprice") / F.col("l_quantity")).alias("px"), "l_quantity")
    return tm.sessions(ticks, ["ticker"], "l_shipdate", 4 * 86400, "px", "l_quantity", cell_days=180)


@register("t7_window_session_overlaps_user", f"""
SELECT w.ticker, w.d_date, s.first_day, s.last_day, s.n_ticks,
       CAST(least(w.hi, s.last_day) - greatest(w.lo, s.first_day) + 1 AS INTEGER) AS overlap_days
FROM (SELECT ticker, d_date, d_date - 20 AS lo, d_date - 5 AS hi FROM ({osql.USER_WINDOWS_SQL}) w GROUP BY ticker, d_date) w
JOIN (SELECT ticker, CAST(first_ts AS DATE) AS first_day, CAST(last_ts AS DATE) AS last_day, n_ticks
      FROM ({osql.sessions_sql(osql.EVENT_TICKS_SQL, "6 HOURS")}) q) s
ON w.ticker = s.ticker AND w.lo <= s.last_day AND s.first_day <= w.hi""")
def q_overlaps(spark, sf):
    windows = fx.user_windows(spark, sf).select("ticker", "d_date").distinct().withColumn("lo", F.date_sub("d_date", 20)).withColumn(
        "hi", F.date_sub("d_date", 5))
    bursts = event_sessions(spark, sf).select("ticker", F.col("first_ts").cast("date").alias("first_day"),
                                              F.col("last_ts").cast("date").alias("last_day"), "n_ticks")
    return tm.interval_overlaps(windows, bursts, ["ticker"], ("lo", "hi"), ("first_day", "last_day"), bucket_days=7).drop("lo", "hi")


# ---------------------------------------------------------------------------
# Features over calendar days
# ---------------------------------------------------------------------------


def calendar_sql(bars_sql: str, n: int) -> str:
    frame = f"OVER (PARTITION BY ticker ORDER BY date RANGE BETWEEN INTERVAL {n - 1} DAYS PRECEDING AND CURRENT ROW)"
    return f"""
SELECT ticker, date, count(close) {frame} AS bars_{n}cd, round(avg(close) {frame}, 6) AS close_{n}cd_mean,
       round(stddev_samp(close) {frame}, 6) AS close_{n}cd_std, min(low) {frame} AS low_{n}cd_min,
       max(high) {frame} AS high_{n}cd_max, round(sum(volume) {frame}, 6) AS volume_{n}cd_sum,
       round(close / NULLIF(first_value(close) {frame}, 0) - 1, 6) AS close_{n}cd_return
FROM ({bars_sql}) b"""


def _rounded_calendar(df, n):
    """Means, deviations, sums and returns rounded; lows and highs are values of the bars and need none."""
    kept = ["ticker", "date", f"low_{n}cd_min", f"high_{n}cd_max"]
    return round_doubles(df.withColumns({f"_{c}": F.struct(c) for c in kept[2:]})).withColumns(
        {c: F.col(f"_{c}.{c}") for c in kept[2:]}).drop(*[f"_{c}" for c in kept[2:]])


@register("t8_calendar_features_sup", calendar_sql(osql.SUP_BARS_SQL, 30))
def q_calendar_sup(spark, sf):
    return _rounded_calendar(tm.calendar_features(fx.supplier_bars(spark, sf), 30), 30)


@register("t8_calendar_features_user", calendar_sql(osql.USER_BARS_SQL, 7))
def q_calendar_user(spark, sf):
    return _rounded_calendar(tm.calendar_features(fx.user_bars(spark, sf), 7, cell_days=10), 7)


# ---------------------------------------------------------------------------
# Grouping sets
# ---------------------------------------------------------------------------


def _cube_sql(how: str) -> str:
    dims = "country, currency, mktcap_tier"
    return f"""
SELECT {dims}, CAST(GROUPING({dims}) AS BIGINT) AS grouping_id, count(*) AS n_tickers, count(*) FILTER (WHERE tp = 1) AS n_tp_tickers,
       CAST(sum(d) AS BIGINT) AS n_rows, CAST(median(d) AS DOUBLE) AS median_days, min(d) AS min_days, max(d) AS max_days
FROM (SELECT ticker, count(date) AS d, max(label) AS tp FROM ({osql.USER_WINDOWS_SQL}) w GROUP BY ticker) t
LEFT JOIN (SELECT ticker, country, currency, {osql.mktcap_tier_sql()} AS mktcap_tier FROM ({osql.CUSTOMER_META_SQL}) m) m USING (ticker)
GROUP BY {how}({dims})"""


def _summary(spark, sf, how):
    meta = fx.customer_metadata(spark, sf).withColumn("mktcap_tier", feat.market_cap_tier(F.col("market_cap")))
    return sc.summary_cube(fx.user_windows(spark, sf), meta, ["country", "currency", "mktcap_tier"], how)


@register("p6_summary_cube_user", _cube_sql("CUBE"))
def q_cube(spark, sf):
    return _summary(spark, sf, "cube")


@register("p6_summary_rollup_user", _cube_sql("ROLLUP"))
def q_rollup(spark, sf):
    return _summary(spark, sf, "rollup")


# ---------------------------------------------------------------------------
# Reconciliation
# ---------------------------------------------------------------------------

_LEFT_SQL, _RIGHT_SQL = (f"SELECT user_id, event_type, CAST(ts AS DATE) AS day FROM events WHERE event_id % 2 = {i}" for i in (0, 1))


def _tick_sides(spark, sf):
    events = fx.table(spark, sf, "events")
    side = lambda i: events.filter(F.col("event_id") % 2 == i).select("user_id", "event_type", F.col("ts").cast("date").alias("day"))
    return side(0), side(1)


@register("t9_intersect_all_events", f"({_LEFT_SQL}) INTERSECT ALL ({_RIGHT_SQL})")
def q_intersect_all(spark, sf):
    return rec.intersect_all(*_tick_sides(spark, sf))


@register("t9_except_all_events", f"({_LEFT_SQL}) EXCEPT ALL ({_RIGHT_SQL})")
def q_except_all(spark, sf):
    return rec.except_all(*_tick_sides(spark, sf))


@register("t9_reconcile_bars_sup", f"""
SELECT coalesce(a.ticker, b.ticker) AS ticker, coalesce(a.date, b.date) AS date, a.close AS left_close, a.volume AS left_volume,
       b.close AS right_close, b.volume AS right_volume,
       CASE WHEN b.ticker IS NULL THEN 'left only' WHEN a.ticker IS NULL THEN 'right only'
            WHEN a.close = b.close AND a.volume = b.volume THEN 'equal' ELSE 'differs' END AS status
FROM ({osql.SUP_BARS_SQL.replace("FROM lineitem l)", "FROM lineitem l WHERE l_returnflag <> 'R')")}) a
FULL OUTER JOIN ({osql.SUP_BARS_SQL.replace("FROM lineitem l)", "FROM lineitem l WHERE l_linestatus = 'F' OR l_returnflag = 'R')")}) b
ON a.ticker = b.ticker AND a.date = b.date""")
def q_reconcile(spark, sf):
    lines = fx.table(spark, sf, "lineitem")
    sides = [fx.supplier_bars_of(lines.filter(c)) for c in ("l_returnflag <> 'R'", "l_linestatus = 'F' OR l_returnflag = 'R'")]
    return rec.reconcile(*sides, ["ticker", "date"], ["close", "volume"])


# ---------------------------------------------------------------------------
# SQL functions
# ---------------------------------------------------------------------------


@register("t11_sql_universe", f"""
SELECT ticker, source, listing_row, substr(ticker, 1, 1) AS initial FROM ({_FILTERED_SQL}) f""")
def q_sql_universe(spark, sf):
    """U1 to U3 from SQL, by registered functions."""
    register_universe(spark)
    listings = fx.supplier_listing(spark, sf).unionByName(fx.customer_listing(spark, sf))
    return spark.sql("""SELECT normal_symbol(ticker) AS ticker, source, listing_row, substr(normal_symbol(ticker), 1, 1) AS initial
                        FROM {listings} WHERE is_common_stock(ticker, test_issue, etf)""", listings=listings)


@register("t11_sql_tiers_customers", f"SELECT ticker, {osql.mktcap_tier_sql()} AS tier FROM ({osql.CUSTOMER_META_SQL}) m")
def q_sql_tiers(spark, sf):
    register_universe(spark)
    return spark.sql("SELECT ticker, market_cap_tier(market_cap) AS tier FROM {meta}", meta=fx.customer_metadata(spark, sf))


@register("t11_sql_scores_sup", _SAME_SQL)
def q_sql_scores(spark, sf):
    """M12 from SQL by a registered function, against the batch scorer."""
    tp, tn = supplier_feature_sets(spark, sf)
    feats = tp.unionByName(tn)
    fm = md.fit_final(tp, tn, feature_names(), threshold=0.5)
    register_scorer(spark, fm)
    features = ", ".join(f"`{c}`" for c in fm.feature_cols)
    other = spark.sql(f"""SELECT ticker, d_date, p AS fraud_proba, CAST(p >= 0.5 AS INT) AS fraud_flag
                          FROM (SELECT ticker, d_date, fraud_proba(array({features})) AS p FROM {{feats}})""", feats=feats)
    return _same_scores(feats, fm, other)
