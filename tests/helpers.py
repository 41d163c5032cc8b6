import datetime as dt

from pyspark.sql import functions as F

BAR_SCHEMA = "ticker string, d_date date, date date, open double, high double, low double, close double, volume double"


def bars(spark, rows, ticker="T", d_date=dt.date(2024, 2, 1)):
    """rows: (date, open, high, low, close, volume)."""
    data = [(ticker, d_date, d, float(o), float(h), float(lo), float(c), float(v)) for d, o, h, lo, c, v in rows]
    return spark.createDataFrame(data, BAR_SCHEMA)


def day(i):
    return dt.date(2024, 1, 1) + dt.timedelta(days=i)


G1 = [
    (day(0), 10, 11, 9, 10, 100),
    (day(1), 10, 12, 10, 11, 0),
    (day(2), 11, 11, 11, 11, 200),
    (day(3), 11, 11, 9, 9, 300),
    (day(4), 9, 12, 9, 12, 400),
    (day(5), 12, 12, 12, 12, 500),
]


def one(df):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0].asDict()


def approx(a, b, tol=1e-6):
    if a is None or b is None:
        return a is None and b is None
    return abs(a - b) <= tol * max(1.0, abs(b))


def col_sum(df, c):
    return df.agg(F.sum(c)).first()[0]
