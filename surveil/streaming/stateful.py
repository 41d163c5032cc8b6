"""Streams with state: sessions, windows closed by timers, and cases meeting bars.

* ``stream_sessions``: bursts of ticks (``session_window``); a session is kept
  while ticks within the gap can still come, then appended.
* ``stream_windows``: the last bars before every D-date, kept per (ticker, D-date)
  until the watermark passes the window's end, then handed on by an event-time timer.
* ``stream_case_bars``: late cases meet bars; both sides' state is bounded by
  the range of days of a window and both watermarks.

State never holds more than a window: sums for a session, ``lookback_bars`` bars for
a (ticker, D-date), the days that a window can reach for the join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from surveil.functions.constants import DEFAULT_BUFFER_DAYS, DEFAULT_LOOKBACK_BARS, TP_MARGIN_DAYS
from surveil.operators.windows import _range_join, _window_bounds
from surveil.schemas import BAR_VALUE_COLS
from surveil.session import scratch_path, ship_package, stage_table

DAY_MS = 86_400_000
BATCH = "_batch"


# ---------------------------------------------------------------------------
# Feeding a stream
# ---------------------------------------------------------------------------


def arrivals(df: DataFrame, name: str, ts: str, late: Column, close: dict, days_per_batch: int = 4, files: int = 8) -> str:
    """Stage a table as the batches in which its rows arrive, in one job; returns the folder (partitioned by ``_batch``).

    A batch covers ``days_per_batch`` days; rows marked ``late`` arrive a day after
    their event time.  Two closing batches far in the future (with the key values
    ``close``) push the watermark over all real windows.
    """
    path = scratch_path(df.sparkSession, f"arrivals-{name}")
    day = F.datediff(F.col(ts).cast("date"), F.lit("1970-01-01").cast("date")) + F.when(late, 1).otherwise(0)
    arriving = df.withColumn(BATCH, F.floor(day / days_per_batch))
    last = df.agg(F.max(ts).alias("_last"), (F.max(F.floor(day / days_per_batch))).alias("_b")).filter("_last IS NOT NULL")
    ends = last.withColumn("_n", F.explode(F.array(F.lit(1), F.lit(2))))
    row = [(F.col("_last") + F.make_interval(months=F.col("_n") * 2)) if f.name == ts else F.lit(close.get(f.name)) for f in df.schema.fields]
    ends = ends.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(row, df.schema.fields)], (F.col("_b") + F.col("_n")).alias(BATCH))
    spread = F.pmod(F.xxhash64(*df.columns), F.lit(files))
    arriving.unionByName(ends).repartition(BATCH, spread).write.partitionBy(BATCH).parquet(path)
    return path


def feed(spark: SparkSession, staged: Sequence[tuple[str, StructType]], start: Callable[..., StreamingQuery], idle: bool = True) -> list:
    """Let the batches of one or several ``arrivals`` (folder, schema) come in order; ``start`` starts the (same) query on their streams.

    Every batch is added to its table's landing folder by many tasks, and the query,
    restarted from its checkpoint, takes all of it as one micro-batch.  Returns the
    progress of every run.  Without ``idle``, what a batch's watermark closes leaves with the
    next batch instead of a micro-batch without rows in between; the second closing batch
    is there for the last real one.
    """
    tables = [spark.read.schema(StructType(list(schema.fields)).add(BATCH, "long")).parquet(path) for path, schema in staged]
    landings = [scratch_path(spark, "landing") for _ in staged]
    progress = []
    name = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(name)
    for (batch,) in reduce(DataFrame.union, [t.select(BATCH) for t in tables]).distinct().orderBy(BATCH).collect():  # a number a batch
        for table, landing, (_, schema) in zip(tables, landings, staged):
            table.filter(F.col(BATCH) == batch).select(*schema.names).write.mode("append").parquet(landing)
        spark.conf.set(name, before if idle else "false")
        try:
            query = start(*[spark.readStream.schema(schema).parquet(landing) for landing, (_, schema) in zip(landings, staged)])
            query.awaitTermination()
        finally:
            spark.conf.set(name, before)
        progress += query.recentProgress
    return progress


def append_to(df: DataFrame, out: str) -> StreamingQuery:
    """Append a stream to a Parquet folder, all that is there at once."""
    return (df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", out + "-ckpt")
            .trigger(availableNow=True).start(out))


# ---------------------------------------------------------------------------
# Sessions
# ---------------------------------------------------------------------------


def stream_sessions(ticks: DataFrame, by: Sequence[str], ts: str, gap_seconds: int, price: str, size: str | None = None,
                    watermark: str = "2 days") -> DataFrame:
    """The sessions of ``temporal.sessions`` over a stream, appended when the watermark has passed their gap."""
    kind = ticks.schema[ts].dataType
    volume = F.lit(1.0) if size is None else F.col(size).cast("double")
    rows = ticks.select(*by, F.col(ts).cast("timestamp").alias("_ts"), F.col(price).cast("double").alias("_px"), volume.alias("_size"))
    rows = rows.filter(F.col("_ts").isNotNull()).withWatermark("_ts", watermark)
    found = rows.groupBy(*by, F.session_window("_ts", f"{gap_seconds} seconds")).agg(
        F.count(F.lit(1)).alias("n_ticks"), F.min("_ts").cast(kind).alias("first_ts"), F.max("_ts").cast(kind).alias("last_ts"),
        F.sum("_size").alias("volume"), F.min("_px").alias("low"), F.max("_px").alias("high"))
    return found.drop("session_window")


# ---------------------------------------------------------------------------
# Windows by timers
# ---------------------------------------------------------------------------

_VALUES = list(BAR_VALUE_COLS)
_STATE = "label int, closes_ms long, days array<int>, " + ", ".join(f"{c} array<double>" for c in _VALUES)
_WINDOW = "ticker string, d_date date, label int, date date, " + ", ".join(f"{c} double" for c in _VALUES)


def _keep_last(n: int):
    """Keep the last ``n`` bars of a (ticker, D-date); hand them on when the watermark passes the window's end."""
    def handed_on(key: tuple, state: GroupState) -> pd.DataFrame:
        label, _, days, *values = state.get
        state.remove()
        return pd.DataFrame({"ticker": key[0], "d_date": key[1], "label": label,
                             "date": pd.to_datetime(pd.Series(days), unit="D").dt.date, **dict(zip(_VALUES, values))})

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            yield handed_on(key, state)
            return
        parts = list(batches)
        closes = int(parts[0]["_closes_ms"].iloc[0])
        if closes <= state.getCurrentWatermarkMs():  # these bars are too late for the window; a call with rows unsets its timer
            if state.exists:
                yield handed_on(key, state)
            return
        # plain arrays: a group brings a few bars at a time, so the frames around them would cost more than they do
        found = [[part[c].to_numpy(dtype=float) for part in parts] for c in ("_day", *_VALUES)]
        if state.exists:
            found = [[np.array(held, dtype=float), *new] for held, new in zip(state.get[2:], found)]
        days, *values = map(np.concatenate, found)
        last = np.argsort(days, kind="stable")[-n:]
        arrays = [[None if v != v else v for v in column[last].tolist()] for column in values]
        state.update((int(parts[0]["label"].iloc[0]), closes, days[last].astype(int).tolist(), *arrays))
        state.setTimeoutTimestamp(closes)
        yield from ()

    return step


def stream_windows(bars: DataFrame, cases: DataFrame, lookback_bars: int = DEFAULT_LOOKBACK_BARS, buffer_days: int = DEFAULT_BUFFER_DAYS,
                   margin_days: int = TP_MARGIN_DAYS, bucket_days: int = 31, watermark: str = "2 days") -> DataFrame:
    """W1 + W2 over a stream of bars and a table of cases (``ticker, d_date, label``): a window's bars, once, when it has closed."""
    ship_package(bars.sparkSession)
    windows = _window_bounds(cases.select("ticker", "d_date", "label"), lookback_bars, margin_days, buffer_days).withColumn(
        "_closes_ms", F.unix_millis(F.date_add("_hi", 1).cast("timestamp")))
    rows = bars.withColumn("_ts", F.col("date").cast("timestamp")).withWatermark("_ts", watermark)
    met = _range_join(rows, windows, ["ticker"], bucket_days)
    met = met.select("ticker", "d_date", "label", "_ts", "_closes_ms", F.datediff("date", F.lit("1970-01-01").cast("date")).alias("_day"),
                     *[F.col(c).cast("double").alias(c) for c in _VALUES])
    return met.groupBy("ticker", "d_date").applyInPandasWithState(
        _keep_last(lookback_bars), _WINDOW, _STATE, "append", GroupStateTimeout.EventTimeTimeout)


def features_to(windows: DataFrame, out: str, **transform) -> StreamingQuery:
    """F0 of every window that a stream hands on, a folder a micro-batch (written anew if a batch is repeated).

    Most micro-batches close no window.  They leave no folder, but for the first, which gives ``out`` its schema.
    """
    from surveil.operators.features import transform as features

    def write(batch: DataFrame, number: int) -> None:
        closed = stage_table(batch, "closed-windows")  # the state is stepped once, whatever is done with its rows
        if number == 0 or not closed.isEmpty():
            features(closed, **transform).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return windows.writeStream.foreachBatch(write).outputMode("append").option("checkpointLocation", out + "-ckpt").trigger(
        availableNow=True).start()


# ---------------------------------------------------------------------------
# Cases meeting bars
# ---------------------------------------------------------------------------


def stream_case_bars(bars: DataFrame, cases: DataFrame, lookback_days: int = DEFAULT_LOOKBACK_BARS, buffer_days: int = DEFAULT_BUFFER_DAYS,
                     margin_days: int = TP_MARGIN_DAYS, bar_delay: str = "2 days", case_delay: str = "2 days") -> DataFrame:
    """W1 between two streams: every case with the bars of its window, as soon as both are there.

    The range of days bounds the state: a bar is kept until no case that can still
    come reaches back to it, a case until no bar of its window can still come.
    """
    left = bars.withColumn("_bar_ts", F.col("date").cast("timestamp")).withWatermark("_bar_ts", bar_delay)
    right = cases.select(F.col("ticker").alias("_ticker"), "d_date", "label", F.col("d_date").cast("timestamp").alias("_case_ts")).withWatermark(
        "_case_ts", case_delay)
    reach = lookback_days + margin_days
    near = (F.col("ticker") == F.col("_ticker")) & (F.col("_bar_ts") >= F.col("_case_ts") - F.expr(f"INTERVAL {reach} DAYS")) & (
        F.col("_bar_ts") <= F.col("_case_ts") - F.expr(f"INTERVAL {buffer_days} DAYS"))
    return left.join(right, near).drop("_ticker", "_bar_ts", "_case_ts")
