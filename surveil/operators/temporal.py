"""Joins and frames over time: as-of joins, overlapping intervals, calendar frames and sessions.

All four cut time into cells, so that a ticker with a third of all rows is
spread over its cells instead of meeting in one task; what a cell needs from
its neighbours travels as a small summary or as the few rows that reach over
the edge.  Rows whose key or time is NULL never match and are kept apart, so that
many of them do not meet either.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveil.functions.columns import days

DAY_MICROS = 86_400_000_000
#: Days of a cell, unless the caller knows better: narrower for denser rows.
CELL_DAYS = 30


def _micros(col: str | Column) -> Column:
    return F.unix_micros((F.col(col) if isinstance(col, str) else col).cast("timestamp"))


def _known(cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_time: str,
    right_time: str,
    values: Sequence[str],
    strict: bool = False,
    within_days: int | None = None,
    order: Sequence[str] = (),
    matched_time: str | None = None,
    cell_days: int = CELL_DAYS,
) -> DataFrame:
    """Every row of ``left`` with ``values`` of the last row of ``right`` of its key that is not later (``strict``: that is earlier).

    An ordered union: both sides are sorted by time inside (key, cell) and the last
    values seen are carried along; the last values of every cell are carried to the
    cells after it.  Neither side is exploded and no pair is formed.  Of the rows of
    ``right`` at one time, the one with the greatest ``order`` (then values) counts.
    ``within_days`` drops matches that are older; ``matched_time`` names a column for
    their time.  NULL keys and times have no match.
    """
    by, values = list(by), list(values)
    cell = F.floor(F.col("_t") / F.lit(cell_days * DAY_MICROS))
    rows = left.withColumn("_row", F.struct(*left.columns)).withColumn("_t", _micros(left_time)).select(*by, "_t", "_row")
    known = _known([*by, "_t"])
    seen = right.withColumn("_t", _micros(right_time)).filter(known).groupBy(*by, "_t").agg(
        F.max(F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)],
                       *[F.col(c).alias(f"v{i}") for i, c in enumerate([right_time, *values])])).alias("_seen"))
    shape = seen.schema["_seen"].dataType
    side = F.lit(0 if strict else 1)
    both = rows.filter(known).withColumn("_side", side).withColumn("_seen", F.lit(None).cast(shape)).unionByName(
        seen.withColumn("_side", F.lit(1) - side).withColumn("_row", F.lit(None).cast(rows.schema["_row"].dataType)))
    both = both.withColumn("_cell", cell)
    # the last of every cell, carried to the cells after it: one small row a cell
    ends = both.groupBy(*by, "_cell").agg(F.max_by("_seen", F.when(F.col("_seen").isNotNull(), F.col("_t"))).alias("_last"))
    before = Window.partitionBy(*by).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*by, "_cell", F.last("_last", ignorenulls=True).over(before).alias("_carried"))
    inside = Window.partitionBy(*by, "_cell").orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = both.withColumn("_in_cell", F.last("_seen", ignorenulls=True).over(inside)).filter(F.col("_row").isNotNull())
    found = found.join(carried, [*by, "_cell"]).withColumn("_found", F.coalesce("_in_cell", "_carried")).select("_row", "_t", "_found")
    if within_days is not None:
        age = F.col("_t") - _micros(F.col("_found.v0"))
        found = found.withColumn("_found", F.when(age <= F.lit(within_days * DAY_MICROS), F.col("_found")))
    found = found.select("_row", "_found").unionByName(
        rows.filter(~known).select("_row", F.lit(None).cast(shape).alias("_found")))
    names = [matched_time, *values]
    got = [F.col(f"_found.v{i}").alias(c) for i, c in enumerate(names) if c is not None]
    return found.select(*[F.col(f"_row.`{c}`") for c in left.columns if c not in names], *got)


def interval_overlaps(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_span: tuple[str, str],
    right_span: tuple[str, str],
    bucket_days: int = 31,
) -> DataFrame:
    """Pairs of rows of one key whose closed date spans overlap, with ``overlap_days``, each pair once.

    Spans are cut into the buckets of days that they cover and joined on (key,
    bucket).  A pair that shares several buckets is kept in the first of them
    only, so nothing is made distinct afterwards.  Other columns must not clash.  Rows
    with a NULL key or end, and spans that end before they begin, have no pairs.
    """
    by = list(by)

    def cut(df: DataFrame, span: tuple[str, str], tag: str) -> DataFrame:
        low, high = (days(F.col(c).cast("date")) for c in span)
        df = df.withColumn(f"_lo{tag}", low).withColumn(f"_hi{tag}", high)
        df = df.filter(_known([*by, f"_lo{tag}", f"_hi{tag}"]) & (F.col(f"_lo{tag}") <= F.col(f"_hi{tag}")))
        first, last = (F.floor(F.col(f"_{end}{tag}") / F.lit(bucket_days)) for end in ("lo", "hi"))
        return df.withColumn("_bucket", F.explode(F.sequence(first, last)))

    met = cut(left, left_span, "1").join(cut(right, right_span, "2"), [*by, "_bucket"])
    low, high = F.greatest("_lo1", "_lo2"), F.least("_hi1", "_hi2")
    met = met.filter((low <= high) & (F.col("_bucket") == F.floor(low / F.lit(bucket_days))))
    return met.withColumn("overlap_days", (high - low + 1).cast("int")).drop("_bucket", "_lo1", "_hi1", "_lo2", "_hi2")


def calendar_features(bars: DataFrame, n_days: int = 30, cell_days: int = 120) -> DataFrame:
    """Features of every bar over the last ``n_days`` calendar days, its own included (RANGE frames, not rows).

    Bars are framed inside (ticker, cell of days); bars that later cells' frames
    reach back to are repeated there as history and dropped afterwards, at most
    ``n_days / cell_days`` of all.  One bar a ticker and day is expected.
    """
    day = days(F.col("date"))
    own = F.floor(F.col("_day") / F.lit(cell_days))
    reach = F.floor((F.col("_day") + F.lit(n_days - 1)) / F.lit(cell_days))
    spread = bars.filter(_known(["ticker", "date"])).withColumn("_day", day).withColumn("_own", own)
    spread = spread.withColumn("_cell", F.explode(F.sequence(own, reach)))
    w = Window.partitionBy("ticker", "_cell").orderBy("_day").rangeBetween(-(n_days - 1), 0)
    first = F.min_by("close", F.struct("date", "close")).over(w)
    out = spread.select(
        "ticker", "date", "_own", "_cell",
        F.count("close").over(w).alias(f"bars_{n_days}cd"),
        F.avg("close").over(w).alias(f"close_{n_days}cd_mean"),
        F.stddev_samp("close").over(w).alias(f"close_{n_days}cd_std"),
        F.min("low").over(w).alias(f"low_{n_days}cd_min"),
        F.max("high").over(w).alias(f"high_{n_days}cd_max"),
        F.sum("volume").over(w).alias(f"volume_{n_days}cd_sum"),
        (F.try_divide(F.col("close"), first) - 1).alias(f"close_{n_days}cd_return"),
    )
    return out.filter(F.col("_cell") == F.col("_own")).drop("_own", "_cell")


#: What is kept of a session: how it is made from ticks, and from pieces of a session.
_SESSION_SUMS = {"n_ticks": F.sum, "first_ts": F.min, "last_ts": F.max, "volume": F.sum, "low": F.min, "high": F.max}


def _session_ends(df: DataFrame, by: Sequence[str], gap: int, first: str, last: str, order: Sequence[str]) -> DataFrame:
    """``df`` with ``_session``, a number that rises where ``gap`` or more lies before ``first``."""
    w = Window.partitionBy(*by).orderBy(*order)
    starts = F.coalesce(F.col(first) - F.lag(last).over(w) >= F.lit(gap), F.lit(True)).cast("int")
    return df.withColumn("_starts", starts).withColumn(
        "_session", F.sum("_starts").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop("_starts")


def sessions(ticks: DataFrame, by: Sequence[str], ts: str, gap_seconds: int, price: str, size: str | Column | None = None,
             cell_days: int = CELL_DAYS) -> DataFrame:
    """Bursts of ticks: per key, ticks less than ``gap_seconds`` apart are one session.

    Sessions are found inside (key, cell) first.  Only those that come within the gap
    of a cell's edge, two a cell at most, are merged across cells.  The result is
    that of ``stream_sessions`` (``session_window``) over the same ticks.
    """
    gap, width = gap_seconds * 1_000_000, cell_days * DAY_MICROS
    if gap > width:
        raise ValueError("a cell must be at least as long as the gap")
    by = list(by)
    volume = F.lit(1.0) if size is None else (F.col(size) if isinstance(size, str) else size).cast("double")
    rows = ticks.select(*by, F.col(ts).alias("_ts"), F.col(price).cast("double").alias("_px"), volume.alias("_size"))
    rows = rows.filter(_known([*by, "_ts"])).withColumn("_t", _micros("_ts")).withColumn("_cell", F.floor(F.col("_t") / F.lit(width)))
    rows = _session_ends(rows, [*by, "_cell"], gap, "_t", "_t", ["_t"])
    pieces = rows.groupBy(*by, "_cell", "_session").agg(
        F.count(F.lit(1)).alias("n_ticks"), F.min("_ts").alias("first_ts"), F.max("_ts").alias("last_ts"), F.sum("_size").alias("volume"),
        F.min("_px").alias("low"), F.max("_px").alias("high"), F.min("_t").alias("_first"), F.max("_t").alias("_last"))
    edge = (F.col("_first") - F.col("_cell") * F.lit(width) < F.lit(gap)) | (
        (F.col("_cell") + 1) * F.lit(width) - F.col("_last") < F.lit(gap) + 1)
    kept = [*by, *_SESSION_SUMS]
    merged = _session_ends(pieces.filter(edge), by, gap, "_first", "_last", ["_first"]).groupBy(*by, "_session").agg(
        *[how(c).alias(c) for c, how in _SESSION_SUMS.items()])
    return pieces.filter(~edge).select(*kept).unionByName(merged.select(*kept))
