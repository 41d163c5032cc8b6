"""As-of joins, sessions, overlaps, calendar frames, cubes and reconciliation against plain Python, hot keys and NULLs included."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from surveil.operators import reconcile as rec
from surveil.operators import scope as sc
from surveil.operators import temporal as tm

EPOCH = dt.datetime(2024, 1, 1)


def at(hours):
    return EPOCH + dt.timedelta(hours=hours)


def hot_rows(rnd, n, hours=4000):
    """A third of the rows have the key 'hot'; some keys and times are NULL."""
    out = []
    for i in range(n):
        key = "hot" if rnd.random() < 0.34 else rnd.choice(["a", "b", "c", None])
        out.append((i, key, at(rnd.randrange(hours)) if rnd.random() > 0.03 else None, float(rnd.randrange(100)) if rnd.random() > 0.1 else None))
    return out


def group_sizes(df, cols):
    return [r["count"] for r in df.groupBy(*cols).count().collect()]


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("within", [None, 3])
def test_asof_join_is_the_last_row_before(spark, strict, within):
    rnd = random.Random(5)
    left, right = hot_rows(rnd, 400), hot_rows(rnd, 300)
    right += [(1000 + i, k, t, -1.0) for i, (_, k, t, _) in enumerate(right[:40])]  # several rows at one time: the greatest id counts
    got = tm.asof_join(spark.createDataFrame(left, "id long, k string, t timestamp, v double"),
                       spark.createDataFrame(right, "rid long, k string, rt timestamp, w double"), ["k"], "t", "rt", ["rid", "w"],
                       strict=strict, within_days=within, order=["rid"], matched_time="seen", cell_days=5)
    assert got.columns == ["id", "k", "t", "v", "seen", "rid", "w"]
    rows = {r["id"]: r for r in got.collect()}
    assert len(rows) == len(left) == got.count()
    for i, k, t, _ in left:
        best = [r for r in right if k is not None and t is not None and r[1] == k and r[2] is not None and (r[2] < t or (r[2] == t and not strict))]
        best = max(best, key=lambda r: (r[2], r[0]), default=None)
        if best and within is not None and t - best[2] > dt.timedelta(days=within):
            best = None
        assert (rows[i]["rid"], rows[i]["w"], rows[i]["seen"]) == ((best[0], best[3], best[2]) if best else (None, None, None)), (i, k, t)


def test_asof_carries_values_over_many_empty_cells_and_keeps_plans_free_of_pairs(spark):
    left = spark.createDataFrame([(i, "x", at(24 * 400 + i)) for i in range(5)] + [(9, "y", at(5))], "id long, k string, t timestamp")
    right = spark.createDataFrame([("x", at(1), None), ("x", at(0), 7.0)], "k string, rt timestamp, w double")
    got = tm.asof_join(left, right, ["k"], "t", "rt", ["w"], matched_time="seen", cell_days=1)
    assert {(r["id"], r["w"], r["seen"]) for r in got.collect()} == {(i, None, at(1)) for i in range(5)} | {(9, None, None)}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    empty = tm.asof_join(left, right.filter("1 = 0"), ["k"], "t", "rt", ["w"])
    assert empty.count() == 6 and empty.filter("w is not null").count() == 0


def brute_sessions(rows, gap):
    out, last = [], {}
    for _, k, t, px in sorted((r for r in rows if r[1] is not None and r[2] is not None), key=lambda r: (r[1], r[2])):
        s = last.get(k)
        if s is None or (t - s["last"]).total_seconds() >= gap:
            s = last[k] = {"k": k, "n": 0, "first": t, "last": t, "px": []}
            out.append(s)
        s["n"] += 1
        s["last"] = t
        s["px"].append(px)
    low = lambda v, f: f([x for x in v if x is not None], default=None)
    return sorted((s["k"], s["n"], s["first"], s["last"], float(s["n"]), str(low(s["px"], min)), str(low(s["px"], max))) for s in out)


@pytest.mark.parametrize("gap_hours,cell", [(6, 1), (24, 1), (30, 7), (1, 30)])
def test_sessions_are_bursts_whatever_the_cells(spark, gap_hours, cell):
    if gap_hours > 24 * cell:
        cell = 2
    rnd = random.Random(gap_hours)
    rows = hot_rows(rnd, 600) + [(9000 + i, "steady", at(i), 1.0) for i in range(0, 1500)]  # one session over many cells
    got = tm.sessions(spark.createDataFrame(rows, "id long, k string, t timestamp, px double"), ["k"], "t", gap_hours * 3600, "px", cell_days=cell)
    mine = sorted((r["k"], r["n_ticks"], r["first_ts"], r["last_ts"], r["volume"], str(r["low"]), str(r["high"])) for r in got.collect())
    assert mine == brute_sessions(rows, gap_hours * 3600)


def test_sessions_need_cells_as_long_as_the_gap(spark):
    with pytest.raises(ValueError):
        tm.sessions(spark.range(1).selectExpr("'a' k", "current_timestamp() t", "1.0D px"), ["k"], "t", 90_000, "px", cell_days=1)


def test_overlaps_are_found_once_without_nested_loops(spark):
    rnd = random.Random(3)
    span = lambda: (lambda a: (a, a + rnd.randrange(-2, 90)))(rnd.randrange(400))
    day = lambda d: (EPOCH + dt.timedelta(days=d)).date()
    rows = [[(i, "hot" if rnd.random() < 0.34 else rnd.choice("ab"), *span()) for i in range(120)] for _ in range(2)]
    left = spark.createDataFrame([(i, k, day(a), day(b)) for i, k, a, b in rows[0]] + [(500, None, day(0), day(9)), (501, "a", None, day(9))],
                                 "i long, k string, a date, b date")
    right = spark.createDataFrame([(i, k, day(a), day(b)) for i, k, a, b in rows[1]], "j long, k string, c date, d date")
    got = tm.interval_overlaps(left, right, ["k"], ("a", "b"), ("c", "d"), bucket_days=14)
    mine = Counter((r["i"], r["j"], r["overlap_days"]) for r in got.collect())
    expected = Counter((i, j, min(b, d) - max(a, c) + 1) for i, k, a, b in rows[0] for j, m, c, d in rows[1]
                       if k == m and a <= b and c <= d and max(a, c) <= min(b, d))
    assert mine == expected and len(expected) > 300
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n,cell", [(30, 120), (30, 7), (5, 5), (1, 3)])
def test_calendar_frames_reach_over_cells(spark, n, cell):
    rnd = random.Random(n)
    days = {"hot": sorted(rnd.sample(range(900), 500)), "thin": [0, 40, 400], "one": [3]}
    rows = [(k, (EPOCH + dt.timedelta(days=d)).date(), float(rnd.randrange(0, 50))) for k, ds in days.items() for d in ds]
    bars = spark.createDataFrame([(k, d, c, c + 1, c - 1, c, 10.0) for k, d, c in rows] + [(None, EPOCH.date(), 1.0, 1.0, 1.0, 1.0, 1.0)],
                                 "ticker string, date date, open double, high double, low double, close double, volume double")
    got = {(r["ticker"], r["date"]): r for r in tm.calendar_features(bars, n, cell_days=cell).collect()}
    assert len(got) == len(rows)
    for k, d, c in rows:
        frame = [(x, y) for kk, x, y in rows if kk == k and dt.timedelta(0) <= d - x < dt.timedelta(days=n)]
        closes, r = [y for _, y in frame], got[(k, d)]
        mean = sum(closes) / len(closes)
        std = (sum((y - mean) ** 2 for y in closes) / (len(closes) - 1)) ** 0.5 if len(closes) > 1 else None
        assert r[f"bars_{n}cd"] == len(closes) and abs(r[f"close_{n}cd_mean"] - mean) < 1e-9
        assert r[f"close_{n}cd_std"] is None if std is None else abs(r[f"close_{n}cd_std"] - std) < 1e-9
        assert (r[f"low_{n}cd_min"], r[f"high_{n}cd_max"], r[f"volume_{n}cd_sum"]) == (min(closes) - 1, max(closes) + 1, 10.0 * len(closes))
        first = min(frame)[1]
        assert r[f"close_{n}cd_return"] is None if first == 0 else abs(r[f"close_{n}cd_return"] - (c / first - 1)) < 1e-9


def test_multisets_of_hot_and_null_rows(spark):
    rnd = random.Random(1)
    value = lambda: "hot" if rnd.random() < 0.34 else rnd.choice(["a", "b", None])
    sides = [[(value(), rnd.choice([1, 2, None])) for _ in range(n)] for n in (700, 500)]
    left, right = (spark.createDataFrame(s, "x string, y int") for s in sides)
    a, b = map(Counter, sides)
    rows = lambda df: Counter(map(tuple, df.collect()))
    assert rows(rec.intersect_all(left, right)) == a & b == rows(left.intersectAll(right))
    assert rows(rec.except_all(left, right)) == a - b == rows(left.exceptAll(right))
    counted = {(r["x"], r["y"]): tuple(r)[2:] for r in rec.multiset_difference(left, right).collect()}
    assert counted == {k: (a[k], b[k], min(a[k], b[k]), max(a[k] - b[k], 0), max(b[k] - a[k], 0)) for k in a.keys() | b.keys()}
    assert rec.intersect_all(left.filter("1 = 0"), right).count() == 0


def test_reconcile_meets_null_keys(spark):
    left = spark.createDataFrame([("a", 1, 1.0), (None, 2, 2.0), ("c", None, None), ("d", 4, 4.0)], "k string, d int, v double")
    right = spark.createDataFrame([("a", 1, 1.0), (None, 2, 3.0), ("c", None, None), ("e", 5, None)], "k string, d int, v double")
    got = {(r["k"], r["d"]): (r["left_v"], r["right_v"], r["status"]) for r in rec.reconcile(left, right, ["k", "d"], ["v"]).collect()}
    assert got == {("a", 1): (1.0, 1.0, "equal"), (None, 2): (2.0, 3.0, "differs"), ("c", None): (None, None, "equal"),
                   ("d", 4): (4.0, None, "left only"), ("e", 5): (None, None, "right only")}


def test_cube_tells_subtotals_from_null_categories(spark):
    bars = spark.createDataFrame([(f"t{i % 7}", EPOCH.date() + dt.timedelta(days=i), int(i % 7 == 0)) for i in range(60)],
                                 "ticker string, date date, label int")
    meta = spark.createDataFrame([(f"t{i}", None if i == 3 else "AB"[i % 2], "X" if i < 4 else "Y") for i in range(6)],
                                 "ticker string, country string, currency string")
    got = sc.summary_cube(bars, meta, ["country", "currency"])
    rows = {(r["country"], r["currency"], r["grouping_id"]): r for r in got.collect()}
    whole = rows[(None, None, 3)]
    assert (whole["n_tickers"], whole["n_tp_tickers"], whole["n_rows"]) == (7, 1, 60)
    null_country = rows[(None, None, 0)]  # t6 has no metadata at all
    assert null_country["n_tickers"] == 1 and rows[(None, "X", 0)]["n_tickers"] == 1 and rows[(None, "X", 2)]["n_tickers"] == 4
    assert rows[("A", None, 1)]["median_days"] == 9.0
    assert sc.summary_cube(bars, meta, ["country", "currency"], "rollup").filter("grouping_id = 2").count() == 0
    with pytest.raises(ValueError):
        sc.summary_cube(bars, meta, ["country"], "sets")


def test_hot_keys_are_spread_over_cells(spark):
    rows = [(i, "hot", at(i)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, k string, t timestamp").withColumn("_cell", F.floor(tm._micros("t") / F.lit(5 * tm.DAY_MICROS)))
    assert max(group_sizes(df, ["k", "_cell"])) <= 120
