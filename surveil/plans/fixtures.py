"""Bars, cases and scores derived from the driver tables (FIXTURES.md §2).

Every builder reads the given parquet tables, so its work grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveil.sources.bars import ticks_to_bars

# full-row tie-break for ticks inside one bar: (l_orderkey, l_linenumber) repeats
LINEITEM_ORDER = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
    "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]
BRAND_EPOCH = "1998-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def brand_number(col: str = "p_brand"):
    return F.substring(F.col(col), 7, 10).cast("int")


def brand_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F_brand: weekly bars per part brand from line items (price = extended price / quantity)."""
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    ticks = li.join(part, li.l_partkey == part.p_partkey)
    return ticks_to_bars(
        ticks,
        key="p_brand",
        ts="l_shipdate",
        price=F.col("l_extendedprice") / F.col("l_quantity"),
        size="l_quantity",
        interval="week",
        order_cols=LINEITEM_ORDER,
    )


def brand_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F_brand cases: brands whose number is a multiple of 5, D = 1998-01-01 + 30·b days."""
    part = table(spark, sf_dir, "part").select("p_brand").distinct()
    b = brand_number()
    return part.filter(b % 5 == 0).select(
        F.col("p_brand").alias("ticker"),
        F.date_add(F.lit(BRAND_EPOCH).cast("date"), b * 30).alias("d_date"),
        F.lit(1).alias("label"),
    )


def brand_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_brand").distinct()
    return part.filter(brand_number() % 5 != 0).select(F.col("p_brand").alias("ticker"))


def user_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F_user: daily bars per user from events (price = value, volume = event count)."""
    ev = table(spark, sf_dir, "events")
    return ticks_to_bars(ev, key="user_id", ts="ts", price="value", size=None, interval="day", order_cols=["event_id"])


def user_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F_user cases: users whose id is a multiple of 4, D = the day after their last event."""
    ev = table(spark, sf_dir, "events")
    return (
        ev.filter(F.col("user_id") % 4 == 0)
        .groupBy("user_id")
        .agg(F.date_add(F.max(F.col("ts").cast("date")), 6).alias("d_date"))
        .select(F.col("user_id").cast("string").alias("ticker"), "d_date", F.lit(1).alias("label"))
    )


def user_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.filter(F.col("user_id") % 4 != 0).select(F.col("user_id").cast("string").alias("ticker")).distinct()


def supplier_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F_sup: daily bars per supplier from line items."""
    return supplier_bars_of(table(spark, sf_dir, "lineitem"))


def supplier_bars_of(lines: DataFrame) -> DataFrame:
    return ticks_to_bars(
        lines,
        key="l_suppkey",
        ts="l_shipdate",
        price=F.col("l_extendedprice") / F.col("l_quantity"),
        size="l_quantity",
        interval="day",
        order_cols=LINEITEM_ORDER,
    )


def supplier_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F_sup cases: suppliers with key % 20 = 0, D = 1998-01-01 + key days."""
    sup = table(spark, sf_dir, "supplier").select("s_suppkey")
    return sup.filter(F.col("s_suppkey") % 20 == 0).select(
        F.col("s_suppkey").cast("string").alias("ticker"),
        F.date_add(F.lit(BRAND_EPOCH).cast("date"), F.col("s_suppkey").cast("int")).alias("d_date"),
        F.lit(1).alias("label"),
    )


def supplier_windows(spark: SparkSession, sf_dir: str, lookback_bars: int = 90) -> DataFrame:
    """Windows of the supplier cases and, at every D-date, of all other suppliers."""
    from surveil.operators import windows as win

    bars, cases = supplier_bars(spark, sf_dir), supplier_cases(spark, sf_dir)
    tp = win.observation_window(bars, cases, lookback_bars=lookback_bars)
    tn = win.candidate_windows(bars, supplier_candidates(spark, sf_dir), cases, lookback_bars=lookback_bars)
    return tp.unionByName(win.attach_label(tn, 0))


def supplier_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = table(spark, sf_dir, "supplier").select("s_suppkey")
    return sup.filter(F.col("s_suppkey") % 20 != 0).select(F.col("s_suppkey").cast("string").alias("ticker"))


def lineitem_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F_score (heavy ties): label = returned, score = discount · 10."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey"), F.col("l_linenumber"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        (F.col("l_discount") * 10).alias("score"),
    )


def event_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F_score (near-continuous): label = error event, score = value / 500."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id", "user_id", "ts",
        (F.col("event_type") == "error").cast("int").alias("label"),
        (F.col("value") / 500).alias("score"),
    )


def embedding_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F_emb: ``vec_id, label, x array<double>`` from the embeddings table."""
    emb = table(spark, sf_dir, "embeddings")
    return emb.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("x"))


def embedding_match(spark: SparkSession, sf_dir: str):
    """F_emb matching inputs: centroids = label 0 (scaled, indexed), candidates = the rest (scaled)."""
    from surveil.operators import matching as mt

    emb = embedding_vectors(spark, sf_dir)
    tp = emb.filter(F.col("label") == 0)
    tn = emb.filter(F.col("label") != 0)
    stats = mt.fit_scaler(tp, "x")
    cents = mt.index_centroids(mt.apply_scaler(tp, stats), ["vec_id"])
    cands = mt.apply_scaler(tn, stats)
    assigned = mt.nearest_centroid(cands, cents, ["vec_id"], ["vec_id"])
    return cents, assigned


# F_meta: customers as securities (country = nation, exchange = region, currency = segment)
SCOPE_COUNTRIES = ["NATION_1", "NATION_6", "NATION_11", "NATION_16", "NATION_21"]
SCOPE_CURRENCIES = ["HOUSEHOLD", "MACHINERY", "BUILDING"]


def customer_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    k = F.col("c_custkey")
    j = cust.join(nation, cust.c_nationkey == nation.n_nationkey).join(region, F.col("n_regionkey") == region.r_regionkey)
    return j.select(
        k.cast("string").alias("ticker"),
        F.when(k % 13 == 0, F.lit(None)).otherwise(F.col("c_acctbal") * F.lit(1e6)).cast("double").alias("market_cap"),
        F.when(k % 7 == 0, F.lit(None)).otherwise(F.col("n_name")).alias("country"),
        F.when(k % 11 == 0, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("currency"),
        F.col("r_name").alias("exchange"),
    )


def metadata_category_lists(spark: SparkSession, sf_dir: str) -> dict[str, list[str]]:
    """Fixed one-hot categories from the dimension tables (bounded: nations, regions, segments)."""
    from surveil.functions.constants import MARKET_CAP_LABELS

    nations = sorted(r[0] for r in table(spark, sf_dir, "nation").select("n_name").distinct().collect())
    regions = sorted(r[0] for r in table(spark, sf_dir, "region").select("r_name").distinct().collect())
    segs = sorted(r[0] for r in table(spark, sf_dir, "customer").select("c_mktsegment").distinct().collect())
    return {
        "mktcap": [*MARKET_CAP_LABELS, "nan"],
        "country": [*nations, "unknown"],
        "currency": [*segs, "unknown"],
        "exchange": regions,
    }


def user_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of the case users and, at every D-date, of all other users."""
    from surveil.operators import windows as win

    bars, cases = user_bars(spark, sf_dir), user_cases(spark, sf_dir)
    tp = win.observation_window(bars, cases, lookback_bars=90)
    tn = win.attach_label(win.candidate_windows(bars, user_candidates(spark, sf_dir), cases), 0)
    return tp.unionByName(tn)


# F_text: documents as litigation releases (hit JSON built from the row, date from doc_id)
def document_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    d = F.col("doc_id")
    file_date = F.when(d % 10 == 0, F.lit("not-a-date")).otherwise(
        F.date_format(F.date_add(F.lit("2010-01-01").cast("date"), (d % 3650).cast("int")), "yyyy-MM-dd"))
    file_path = (
        F.when(d % 3 == 0, F.lit(None).cast("string"))
        .when(d % 3 == 1, F.concat(F.lit("/litigation/"), F.col("source"), F.lit("/"), d.cast("string")))
        .otherwise(F.concat(F.lit("http://"), F.col("source"), F.lit("/"), d.cast("string")))
    )
    display = F.when(F.col("lang") == "en", F.array(F.col("source"))).otherwise(F.array().cast("array<string>"))
    hit = F.struct(
        F.when(d % 21 == 0, F.lit("")).otherwise(F.concat(F.lit("doc-"), d.cast("string"))).alias("_id"),
        F.struct(file_date.alias("file_date"), file_path.alias("file_path"), display.alias("display_names"),
                 F.array(F.upper(F.col("lang"))).alias("entity_names")).alias("_source"),
    )
    return docs.select(d.alias("hit_order"), "text", F.to_json(hit).alias("hit"))


# F_list: customers and suppliers as two listings; symbols from md5 of the name
def _listing(df: DataFrame, key: str, name: str, source: str) -> DataFrame:
    k = F.col(key)
    base = F.upper(F.substring(F.md5(F.col(name)), 1, 10))
    sym = F.substring(base, 1, (k % 6).cast("int") + 1)
    sym = (F.when(k % 13 == 0, F.concat(sym, F.lit("W"))).when(k % 17 == 0, F.concat(sym, F.lit(".A")))
           .when(k % 19 == 0, F.concat(F.lit(" "), F.lower(sym), F.lit(" "))).otherwise(sym))
    return df.select(
        sym.alias("ticker"), F.col(name).alias("security_name"),
        F.when(k % 9 == 0, F.lit("Y")).when(k % 9 == 1, F.lit(None)).otherwise(F.lit("N")).alias("test_issue"),
        F.when(k % 10 == 0, F.lit("Y")).otherwise(F.lit("N")).alias("etf"),
        F.lit(source).alias("source"), k.alias("listing_row"),
    )


def supplier_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listing(table(spark, sf_dir, "supplier"), "s_suppkey", "s_name", "nasdaq")


def customer_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listing(table(spark, sf_dir, "customer"), "c_custkey", "c_name", "other")


def listing_known_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known case tickers: every 25th customer's symbol."""
    return customer_listing(spark, sf_dir).filter(F.col("listing_row") % 25 == 0).select("ticker")
