"""Exact quantiles and running sums that never put a group into one task.

``exact_quantiles`` gives the linearly interpolated quantiles of pandas.  A
mergeable sketch brackets every wanted rank first; values outside the brackets
are then replaced by the nearest bracket edge, which keeps their order, and
equal values are counted before they meet.  What is left of a group is a few
values around the wanted ranks, whatever its size.

``running_sums`` orders a whole table without a global sort: rows are cut into
cells of equal width, the crowded cells again, the cells' totals are summed up,
and only inside a cell are rows sorted.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Relative rank error of the sketch, as its inverse; brackets reach twice as far.
ACCURACY = 10_000
#: Below so many values the brackets may be too narrow for the two ranks of an interpolation: all values stay.
FEW = 50_000
CELLS = 4096


def _same(left: str, right: str, cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in cols])


def exact_quantiles(df: DataFrame, value: str, qs: Sequence[float], by: Sequence[str] = (), out: str = "q") -> DataFrame:
    """One row per group (one row without ``by``): the quantiles of the non-NULL values as an array.

    Groups without any value have no row; without ``by`` the array is NULL then.
    """
    by = list(by)
    rows = df.select(*by, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    margin = 2.0 / ACCURACY
    marks = [(max(q - margin, 0.0), min(q + margin, 1.0)) for q in qs]
    flat = sorted({m for pair in marks for m in pair})
    edges = rows.groupBy(*by).agg(F.count("_v").alias("_n"), F.percentile_approx("_v", flat, ACCURACY).alias("_e"))
    if by:
        # groups of up to FEW values keep them all; the others number at most rows / FEW, so no group's rows meet in one task
        large = F.broadcast(edges.filter(F.col("_n") > FEW))
        joined = rows.alias("l").join(large.alias("r"), _same("l", "r", by), "left").select(*[F.col(f"l.{c}") for c in by], "_v", "_n", "_e")
    else:
        joined = rows.crossJoin(F.broadcast(edges))  # one row
    v, e = F.col("_v"), F.col("_e")
    wanted = reduce(lambda a, b: a | b, [v.between(e[flat.index(lo)], e[flat.index(hi)]) for lo, hi in marks])
    below = F.coalesce(F.array_max(F.filter(e, lambda x: x < v)), e[0])
    kept = F.when(F.col("_n").isNull() | (F.col("_n") <= FEW) | wanted, v).otherwise(below)
    counted = joined.groupBy(*by, kept.alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    return counted.groupBy(*by).agg(F.percentile("_v", list(qs), F.col("_c")).alias(out))


def exact_median(df: DataFrame, value: str, by: Sequence[str] = (), out: str = "median") -> DataFrame:
    return exact_quantiles(df, value, [0.5], by, "_q").select(*by, F.col("_q")[0].alias(out))


def join_groups(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Left join on group columns that may be NULL; without group columns both sides are one row."""
    by = list(by)
    if not by:
        return left.crossJoin(F.broadcast(right))
    rest = [c for c in right.columns if c not in by]
    return left.alias("l").join(right.alias("r"), _same("l", "r", by), "left").select("l.*", *[F.col(f"r.{c}") for c in rest])


def _cell(order: str, low: str, high: str) -> Column:
    width = F.col(high) - F.col(low)
    cell = F.least(F.floor((F.col(order) - F.col(low)) / width * CELLS), F.lit(CELLS - 1))
    return F.when(F.col(order).isNull(), -1).when(width > 0, cell).otherwise(0).cast("int")


def running_sums(df: DataFrame, order: str, sums: Sequence[str]) -> DataFrame:
    """``df`` (one row per value of ``order``; NULL comes first) with ``<c>_below`` and ``<c>_total`` for every ``c`` of ``sums``."""
    bounds = df.agg(F.min(order).alias("_lo"), F.max(order).alias("_hi"))
    one = df.crossJoin(F.broadcast(bounds)).withColumn("_c1", _cell(order, "_lo", "_hi")).drop("_lo", "_hi")
    # CELLS + 1 rows at most: a bounded broadcast and a bounded window
    first = one.groupBy("_c1").agg(F.min(order).alias("_lo"), F.max(order).alias("_hi"), *[F.sum(c).alias(f"_s_{c}") for c in sums])
    upto = Window.orderBy("_c1").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("_c1").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = first.select("_c1", "_lo", "_hi", *[F.coalesce(F.sum(f"_s_{c}").over(upto), F.lit(0)).alias(f"_b1_{c}") for c in sums],
                         *[F.sum(f"_s_{c}").over(whole).alias(f"{c}_total") for c in sums])
    two = one.join(F.broadcast(first), "_c1").withColumn("_c2", _cell(order, "_lo", "_hi")).drop("_lo", "_hi")
    second = two.groupBy("_c1", "_c2").agg(*[F.sum(c).alias(f"_s_{c}") for c in sums])
    upto = Window.partitionBy("_c1").orderBy("_c2").rowsBetween(Window.unboundedPreceding, -1)
    second = second.select("_c1", "_c2", *[F.coalesce(F.sum(f"_s_{c}").over(upto), F.lit(0)).alias(f"_b2_{c}") for c in sums])
    inside = Window.partitionBy("_c1", "_c2").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    out = two.join(second, ["_c1", "_c2"])
    below = [(F.col(f"_b1_{c}") + F.col(f"_b2_{c}") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(f"{c}_below") for c in sums]
    return out.select(*df.columns, *below, *[f"{c}_total" for c in sums])
