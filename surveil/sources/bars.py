"""S1/S2 — bar readers and tick → OHLCV bar aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveil.schemas import BAR_VALUE_COLS

REQUIRED_BAR_COLS = ["ticker", "date", *BAR_VALUE_COLS]


def clean_bars(df: DataFrame) -> DataFrame:
    """Normalise bar types; drop rows without a key and rows whose values are all NULL.

    A bar with some values missing stays (the features guard against NULLs), so
    it still counts as one of a window's last bars.  NaN is converted to NULL on the way in so that it never reaches an
    aggregate (NaN sorts high and poisons ``stddev_samp``).
    """
    missing = [c for c in REQUIRED_BAR_COLS if c not in df.columns]
    if missing:
        raise ValueError(f"bars are missing required columns: {missing}")
    out = df.withColumn("ticker", F.col("ticker").cast("string")).withColumn("date", F.col("date").cast("date"))
    if "d_date" in df.columns:
        out = out.withColumn("d_date", F.col("d_date").cast("date"))
    for c in BAR_VALUE_COLS:
        out = out.withColumn(c, F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")))
    any_value = F.coalesce(*[F.col(c) for c in BAR_VALUE_COLS]).isNotNull()
    return out.filter(F.col("ticker").isNotNull() & F.col("date").isNotNull() & any_value)


def read_bars(spark: SparkSession, path: str) -> DataFrame:
    """Load OHLCV parquet (any extra columns such as ``d_date``/``label`` are kept)."""
    return clean_bars(spark.read.parquet(path))


def ticks_to_bars(
    ticks: DataFrame,
    key: str | Column,
    ts: str | Column,
    price: str | Column,
    size: str | Column | None = None,
    interval: str = "day",
    order_cols: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Aggregate ticks to OHLCV bars per ``(ticker, date)``.

    ``open``/``close`` are the first/last price in ``(ts, *order_cols)`` order,
    chosen with ``min_by``/``max_by`` on a struct so that the aggregate is
    partial (map-side combine) and needs a single shuffle on the bar key.
    ``size=None`` makes the volume the tick count.
    """
    key_c = F.col(key) if isinstance(key, str) else key
    ts_c = F.col(ts) if isinstance(ts, str) else ts
    price_c = F.col(price) if isinstance(price, str) else price
    order = [ts_c] + [F.col(c) if isinstance(c, str) else c for c in (order_cols or [])]
    order_key = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    vol = F.lit(1.0) if size is None else (F.col(size) if isinstance(size, str) else size).cast("double")
    if interval == "day":
        bucket = ts_c.cast("date")
    else:
        bucket = F.date_trunc(interval, ts_c).cast("date")
    staged = ticks.select(
        key_c.cast("string").alias("ticker"),
        bucket.alias("date"),
        price_c.cast("double").alias("_px"),
        vol.alias("_sz"),
        order_key.alias("_ord"),
    )
    return staged.groupBy("ticker", "date").agg(
        F.min_by("_px", "_ord").alias("open"),
        F.max("_px").alias("high"),
        F.min("_px").alias("low"),
        F.max_by("_px", "_ord").alias("close"),
        F.sum("_sz").alias("volume"),
    )
