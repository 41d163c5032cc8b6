"""Streams with state against their batch operators: late rows, timers, and state that is given up."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from surveil.operators import features as feat
from surveil.operators import temporal as tm
from surveil.operators import windows as win
from surveil.session import scratch_path
from surveil.streaming import bars as stb
from surveil.streaming import stateful as st

DAY0 = dt.datetime(2024, 1, 1)


def ticks(spark, n=400, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rnd.random() < 0.34 else rnd.choice("ab")
        rows.append((i, key, DAY0 + dt.timedelta(minutes=rnd.randrange(20 * 24 * 60)), float(rnd.randrange(100))))
    return spark.createDataFrame(rows, "id long, ticker string, ts timestamp, px double")


def state_rows(progress):
    return [op for p in progress for op in p["stateOperators"]]


def test_streamed_sessions_are_the_batch_sessions_and_leave_the_state(spark):
    t = ticks(spark)
    path = st.arrivals(t, "t", "ts", late=F.col("id") % 5 == 0, close={"ticker": "end"})
    out = scratch_path(spark, "s")
    with stb.utc(spark):
        progress = st.feed(spark, [(path, t.schema)], lambda x: st.append_to(st.stream_sessions(x, ["ticker"], "ts", 5 * 3600, "px"), out))
    got = spark.read.parquet(out).filter("ticker <> 'end'")
    want = tm.sessions(t, ["ticker"], "ts", 5 * 3600, "px")
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    ops = state_rows(progress)
    assert ops[-1]["numRowsTotal"] <= 2 < max(o["numRowsTotal"] for o in ops)  # only closing rows are left
    assert len(progress) >= 5


def test_too_late_ticks_are_dropped(spark):
    rows = [(0, "a", DAY0, 1.0), (1, "a", DAY0 + dt.timedelta(days=12), 2.0), (2, "a", DAY0 + dt.timedelta(hours=1), 3.0)]
    schema = "id long, ticker string, ts timestamp, px double"
    path, out = scratch_path(spark, "late"), scratch_path(spark, "s")
    for batch, row in ((0, rows[0]), (1, rows[1]), (2, rows[2]), (3, (3, "end", DAY0 + dt.timedelta(days=90), 0.0)), (4, (4, "end", DAY0 + dt.timedelta(days=190), 0.0))):
        spark.createDataFrame([row], schema).write.parquet(f"{path}/_batch={batch}")
    with stb.utc(spark):
        st.feed(spark, [(path, spark.createDataFrame([], schema).schema)],
                lambda x: st.append_to(st.stream_sessions(x, ["ticker"], "ts", 3600, "px"), out))
    got = spark.read.parquet(out).filter("ticker = 'a'").collect()
    assert sorted((r["n_ticks"], r["low"]) for r in got) == [(1, 1.0), (1, 2.0)]


@pytest.fixture(scope="module")
def daily(spark):
    rnd = random.Random(8)
    rows = []
    for ticker, n in (("hot", 60), ("b", 25), ("c", 9), ("quiet", 2)):
        for d in sorted(rnd.sample(range(60), n)):
            c = float(rnd.randrange(10, 50))
            rows.append((ticker, (DAY0 + dt.timedelta(days=d)).date(), c, c + 2, c - 2, None if d % 9 == 0 else c + 1, 100.0 + d))
    bars = spark.createDataFrame(rows, "ticker string, date date, open double, high double, low double, close double, volume double")
    cases = [(t, (DAY0 + dt.timedelta(days=d)).date(), int(t == "hot")) for t in ("hot", "b", "c", "quiet", "none") for d in (20, 40, 66)]
    return bars, spark.createDataFrame(cases, "ticker string, d_date date, label int")


def test_features_of_streamed_bars_are_those_of_the_batch(spark, daily):
    bars, cases = daily
    late = F.pmod(F.xxhash64("ticker", "date"), F.lit(4)) == 0
    path = st.arrivals(bars, "bars", "date", late=late, close={"ticker": "end"}, days_per_batch=10)
    rows_out, feats_out = scratch_path(spark, "w"), scratch_path(spark, "f")
    with stb.utc(spark):
        progress = st.feed(spark, [(path, bars.schema)], lambda b: st.append_to(st.stream_windows(b, cases, lookback_bars=15), rows_out))
        st.feed(spark, [(path, bars.schema)], lambda b: st.features_to(st.stream_windows(b, cases, lookback_bars=15), feats_out))
    want = win.observation_window(bars, cases, lookback_bars=15)
    cols = ["ticker", "d_date", "label", "date", "open", "high", "low", "close", "volume"]
    assert sorted(map(str, spark.read.parquet(rows_out).select(*cols).collect())) == sorted(map(str, want.select(*cols).collect()))
    got = spark.read.parquet(feats_out).drop("batch")
    expected = feat.transform(want)
    assert got.count() == expected.count() > 5
    assert got.select(*expected.columns).exceptAll(expected).count() == 0
    ops = state_rows(progress)
    assert ops[-1]["numRowsTotal"] == 0 < max(o["numRowsTotal"] for o in ops)  # every window was handed on


def test_streamed_cases_meet_their_bars_and_state_is_evicted(spark, daily):
    bars, cases = daily
    a = st.arrivals(bars, "bars", "date", late=F.lit(False), close={"ticker": "end"}, days_per_batch=10)
    b = st.arrivals(cases, "cases", "d_date", late=F.col("label") == 1, close={"ticker": "done"}, days_per_batch=10)
    out = scratch_path(spark, "j")
    with stb.utc(spark):
        progress = st.feed(spark, [(a, bars.schema), (b, cases.schema)],
                           lambda x, y: st.append_to(st.stream_case_bars(x, y, lookback_days=10, margin_days=2), out))
    want = win.observation_window(bars, cases, lookback_bars=1000, lookback_days=10, margin_days=2)
    cols = ["ticker", "d_date", "label", "date", "close"]
    assert sorted(map(str, spark.read.parquet(out).select(*cols).collect())) == sorted(map(str, want.select(*cols).collect()))
    ops = state_rows(progress)
    assert sum(o["numRowsRemoved"] for o in ops) > 40  # bars and cases that nothing can meet any more
    assert max(o["numRowsTotal"] for o in ops) < bars.count() + cases.count()
    assert ops[-1]["numRowsTotal"] <= 6


class _State:
    """What a group's state does between batches, without a stream."""

    hasTimedOut = False

    def __init__(self):
        self.get = None

    exists = property(lambda self: self.get is not None)

    def getCurrentWatermarkMs(self):
        return 0

    def update(self, value):
        self.get = value

    def setTimeoutTimestamp(self, at):
        self.at = at


def test_an_open_window_keeps_its_last_bars_without_building_frames(monkeypatch):
    import pandas as pd

    rnd = random.Random(5)
    days = list(range(30))
    rnd.shuffle(days)
    bars = [(d, *[None if rnd.random() < 0.2 else float(rnd.randrange(50)) for _ in st._VALUES]) for d in days]
    frames = [pd.DataFrame(bars[i:i + 7], columns=["_day", *st._VALUES]).assign(label=1, _closes_ms=10**12) for i in range(0, 30, 7)]
    frames = [f.astype({c: float for c in st._VALUES}) for f in frames]
    for name in ("concat", "DataFrame", "Series"):
        monkeypatch.setattr(st.pd, name, None)  # each would cost a group more than its bars
    state, step = _State(), st._keep_last(12)
    assert list(step(("a", None), iter(frames[:2]), state)) == []
    for f in frames[2:]:
        assert list(step(("a", None), iter([f]), state)) == []
    want = sorted(bars)[-12:]
    assert state.get == (1, 10**12, *[[b[i] for b in want] for i in range(len(st._VALUES) + 1)]) and state.at == 10**12


def test_a_closed_window_that_gets_late_bars_is_handed_on_once(monkeypatch):
    """A call with rows unsets the group's timer, so a window that is closed by then must leave with that call."""
    import pandas as pd

    frame = lambda d: pd.DataFrame([(d, *[float(d)] * len(st._VALUES))], columns=["_day", *st._VALUES]).assign(label=1, _closes_ms=1000)
    state, step = _State(), st._keep_last(12)
    assert list(step(("a", None), iter([frame(3)]), state)) == []
    monkeypatch.setattr(_State, "getCurrentWatermarkMs", lambda self: 2000)
    monkeypatch.setattr(_State, "remove", lambda self: setattr(self, "get", None), raising=False)
    out = list(step(("a", None), iter([frame(4)]), state))
    assert len(out) == 1 and out[0]["close"].tolist() == [3.0] and not state.exists
    assert list(step(("a", None), iter([frame(5)]), state)) == [] and not state.exists


def test_a_batch_is_one_micro_batch_and_features_run_where_windows_close(spark, daily):
    import os

    bars, cases = daily
    path = st.arrivals(bars, "bars", "date", late=F.lit(False), close={"ticker": "end"}, days_per_batch=4)
    out = scratch_path(spark, "f")
    some = cases.filter("d_date = date'%s'" % (DAY0 + dt.timedelta(days=40)).date())
    with stb.utc(spark):
        progress = st.feed(spark, [(path, bars.schema)], lambda b: st.features_to(st.stream_windows(b, some, lookback_bars=15), out), idle=False)
    batches = spark.read.parquet(path).select(st.BATCH).distinct().count()
    assert batches >= 15 and len({p["batchId"] for p in progress if p["durationMs"].get("addBatch")}) == batches
    assert len([d for d in os.listdir(out) if d.startswith("batch=")]) <= 3 and spark.read.parquet(out).count() > 1
    assert spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled") == "true"
