"""Small Column helpers shared by operators (all JVM-side expressions)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num: Column, den: Column) -> Column:
    """Division that yields NULL (not an error / inf) on a zero or NULL denominator."""
    return F.try_divide(num, den)


def pct(cur: Column, prev: Column) -> Column:
    """``cur / prev - 1``; NULL when ``prev`` is 0 or NULL."""
    return F.try_divide(cur, prev) - F.lit(1.0)


def up_move(cur: Column, prev: Column) -> Column:
    """Whether the pct change is positive, counting a move off zero (±inf in pandas) by sign."""
    return F.when(prev == 0, cur > 0).otherwise(pct(cur, prev) > 0)


def days(c: Column) -> Column:
    """Days since 1970-01-01 as an integer (bucketing key for range joins)."""
    return F.datediff(c, F.lit("1970-01-01").cast("date"))


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (comparison hygiene for oracle checks)."""
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() in ("double", "float"):
            out.append(f"round(CAST(`{f.name}` AS DOUBLE), {digits}) + 0.0D AS `{f.name}`")
        else:
            out.append(f"`{f.name}`")
    return df.selectExpr(*out)
