"""Every registered query with an oracle matches DuckDB on the smallest driver tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
HEAVY = ("m10_", "m5_", "m7_", "m11_", "st2_", "x2_", "x3_")


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        s = str(v)[:19]
        return s[:10] if s.endswith("00:00:00") or len(s) == 10 else s
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(pdf):
    import pandas as pd

    cols = sorted(pdf.columns)
    out = [tuple(None if x is pd.NaT else _norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


NAMES = sorted(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sdf = entry.queries()[name](spark, SF_SMALL).toPandas()
    odf = con.execute(entry.oracle_sql()[name]).df()
    assert sorted(sdf.columns) == sorted(odf.columns)
    assert _rows(sdf) == _rows(odf)


def test_every_query_has_a_callable_and_entry_runs(spark):
    qs = entry.queries()
    assert set(entry.oracle_sql()) <= set(qs)
    df = entry.entry(spark)
    assert df.count() >= 0 and len(df.columns) > 250


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if n not in entry.oracle_sql() and not n.startswith(HEAVY)))
def test_rows_only_queries_run(spark, name):
    assert entry.queries()[name](spark, SF_SMALL).count() >= 0
