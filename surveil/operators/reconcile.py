"""Reconciliation of two sources that should hold the same rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def multiset_difference(left: DataFrame, right: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per distinct row (NULLs equal): ``n_left``, ``n_right``, ``n_both``, ``n_only_left``, ``n_only_right``.

    ``n_both`` are the multiplicities of INTERSECT ALL, ``n_only_left`` those of
    EXCEPT ALL.  Both sides are counted in one partial aggregate, so a row that makes
    up a third of a side is one row a map task before the exchange; nothing is joined.
    """
    cols = list(cols or left.columns)
    tagged = left.select(*cols, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(*cols, F.lit(0).alias("_l"), F.lit(1).alias("_r")))
    counted = tagged.groupBy(*cols).agg(F.sum("_l").alias("n_left"), F.sum("_r").alias("n_right"))
    zero = F.lit(0).cast("long")
    return counted.select(
        *cols, "n_left", "n_right", F.least("n_left", "n_right").alias("n_both"),
        F.greatest(F.col("n_left") - F.col("n_right"), zero).alias("n_only_left"),
        F.greatest(F.col("n_right") - F.col("n_left"), zero).alias("n_only_right"))


def intersect_all(left: DataFrame, right: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """The rows of both sides, as often as both hold them (INTERSECT ALL)."""
    return _repeated(multiset_difference(left, right, cols), "n_both", list(cols or left.columns))


def except_all(left: DataFrame, right: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """The rows of ``left``, as often as it holds them more than ``right`` does (EXCEPT ALL)."""
    return _repeated(multiset_difference(left, right, cols), "n_only_left", list(cols or left.columns))


def _repeated(counted: DataFrame, times: str, cols: list[str]) -> DataFrame:
    rows = counted.filter(F.col(times) > 0)
    return rows.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col(times)))).select(*cols)


def reconcile(left: DataFrame, right: DataFrame, key: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Per key (NULL keys meet) both sides' values and a ``status``: equal, differs, left only, right only.

    Keys should be unique on either side (see ``multiset_difference``).
    """
    key, values = list(key), list(values)
    a = left.select(F.struct(*key).alias("_k"), F.struct(*values).alias("_a"))
    b = right.select(F.struct(*key).alias("_j"), F.struct(*values).alias("_b"))
    met = a.join(b, F.col("_k").eqNullSafe(F.col("_j")), "full_outer")
    status = (F.when(F.col("_b").isNull(), "left only").when(F.col("_a").isNull(), "right only")
              .when(F.col("_a").eqNullSafe(F.col("_b")), "equal").otherwise("differs"))
    at = F.coalesce("_k", "_j")
    return met.select(*[at[c].alias(c) for c in key], *[F.col(f"_a.{c}").alias(f"left_{c}") for c in values],
                      *[F.col(f"_b.{c}").alias(f"right_{c}") for c in values], status.alias("status"))
