"""U1–U7 — candidate universe from exchange listings.

Listings are DataFrames with ``ticker, security_name, source`` and optional
flag columns ``test_issue``/``etf`` (see ``sources.tables.read_listing``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveil.functions.constants import SYMBOL_BAD_CHARS, SYMBOL_BAD_SUFFIXES, SYMBOL_MAX_LENGTH

SOURCE_PRIORITY = ["nasdaq", "other"]


def union_listings(*listings: DataFrame) -> DataFrame:
    """Concatenate listings (by column name)."""
    if not listings:
        raise ValueError("no listing was available")
    out = listings[0]
    for other in listings[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out


def drop_flagged(df: DataFrame, flags: Sequence[str] = ("test_issue", "etf")) -> DataFrame:
    """Drop rows whose flag is ``'Y'``; NULL flags are kept; absent flags are ignored."""
    for f in flags:
        if f in df.columns:
            df = df.filter(~F.coalesce(F.col(f) == "Y", F.lit(False)))
    return df


def filter_symbols(df: DataFrame) -> DataFrame:
    """trim+upper; drop symbols with ``. + $ ^ ~ %``, ending in W/R/P, or longer than 5."""
    t = F.upper(F.trim(F.col("ticker").cast("string")))
    bad = t.rlike(SYMBOL_BAD_CHARS)
    for suffix in SYMBOL_BAD_SUFFIXES:
        bad = bad | t.endswith(suffix)
    ok = F.length(t).between(1, SYMBOL_MAX_LENGTH)
    return df.withColumn("ticker", t).filter(~F.coalesce(bad, F.lit(False)) & F.coalesce(ok, F.lit(False)))


def exclude_known(df: DataFrame, cases: DataFrame) -> DataFrame:
    """U4: drop tickers of known cases (upper-cased)."""
    known = cases.select(F.upper(F.col("ticker")).alias("ticker")).distinct()
    return df.join(known, "ticker", "left_anti")


def dedupe_first(df: DataFrame, key: str = "ticker", priority: Sequence[str] = SOURCE_PRIORITY,
                 order: Sequence[str] = ("listing_row",)) -> DataFrame:
    """One row per ticker, the first by source priority then listing order.

    ``min_by`` over a struct ordering is a partial aggregate: a ticker listed
    millions of times is reduced map-side instead of sorted in one task.
    """
    prio = F.array_position(F.array(*[F.lit(p) for p in priority]), F.col("source"))
    tail = [F.col(c) for c in order if c in df.columns] + [F.col("security_name")]
    rest = [c for c in df.columns if c != key]
    best = F.min_by(F.struct(*[F.col(c) for c in rest]), F.struct(prio, *tail))
    return df.groupBy(key).agg(best.alias("_b")).select(key, *[F.col(f"_b.{c}").alias(c) for c in rest])


def sample_n(df: DataFrame, n: int | None, seed: int = 42, key: str = "ticker") -> DataFrame:
    """A seeded sample of ``n`` rows in ``md5(key ‖ seed)`` order (reproducible at any partitioning).

    ``limit`` is the feature here; Spark plans it as a TakeOrdered top-k.
    """
    if n is None:
        return df
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed))))
    return df.orderBy(h, F.col(key)).limit(int(n))


def build_universe(listings: Sequence[DataFrame], cases: DataFrame | None = None, n: int | None = None,
                   seed: int = 42) -> DataFrame:
    """U1 → U2 → U3 → U4 → U5 → U6; errors if no listing is given."""
    u = drop_flagged(union_listings(*listings))
    u = filter_symbols(u)
    if cases is not None:
        u = exclude_known(u, cases)
    u = dedupe_first(u)
    return sample_n(u.select("ticker", "security_name", "source"), n, seed)
