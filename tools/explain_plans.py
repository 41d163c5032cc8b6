"""Print a compact physical-plan summary (operators, exchanges, pushed filters) of headline queries.

usage: python tools/explain_plans.py [sf_dir]  — writes PLANS.md at the repo root.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import bench  # noqa: E402
from surveil.plans import catalog  # noqa: E402
from surveil.session import local_session  # noqa: E402

SHOW = {
    "f0_features_sup_1000x1": bench.sup_one_date,
    "s2_bars_sup": bench.QUERIES["s2_bars_sup"],
    "v6_sweep_lineitem": bench.QUERIES["v6_sweep_lineitem"],
    "c3_nearest_centroid_emb": bench.nearest,
    "c7_stratified_emb": catalog.QUERIES["c7_c9_sample_stratified_emb"],
    "e4_median_trajectory_user": catalog.QUERIES["e4_median_trajectory_user"],
    "p1_filter_scope_user": catalog.QUERIES["p1_filter_scope_user"],
    "a6_build_cases": catalog.QUERIES["a6_build_cases"],
    "t1_asof_previous_bar_sup": catalog.QUERIES["t1_asof_previous_bar_sup"],
    "t3_sessions_sup": catalog.QUERIES["t3_sessions_sup"],
    "t8_calendar_features_sup": catalog.QUERIES["t8_calendar_features_sup"],
    "t9_reconcile_bars_sup": catalog.QUERIES["t9_reconcile_bars_sup"],
}


NOTES = {
    "f0_features_sup_1000x1": "Data-sized shuffles: the tick→bar aggregation and the single (ticker, d_date) exchange after the "
    "bucketed range join (WindowGroupLimit on both sides keeps ≤ lookback bars per window before the shuffle). The per-bar "
    "windows, the per-(window, size) aggregate and the map collect all reuse that partitioning. The D-date window is pushed "
    "into the parquet scan, and the candidate semi-join sits below the bar aggregation.",
    "s2_bars_sup": "Partial sort aggregate → one shuffle on (ticker, date) → final aggregate (struct orderings keep open/close exact).",
    "v6_sweep_lineitem": "Raw rows are shuffled once, already counted per distinct score. Threshold buckets are summed from that table; the "
    "rank metrics order it by two levels of cells, whose tables (≤ 4,097 rows) are broadcast; a row sort only happens inside a cell. "
    "No job runs while the plan is built.",
    "c3_nearest_centroid_emb": "Candidates never shuffle: centroids are broadcast in blocks of bounded bytes, an Arrow UDF keeps the running minimum.",
    "c7_stratified_emb": "Ranks run inside (centroid, bin) or under a group limit; bin edges come from the exact distributed quantiles.",
    "e4_median_trajectory_user": "A sketch brackets the wanted ranks, values outside are clamped to the bracket, equal values are counted, "
    "and the exact percentile sees (value, count) pairs only.",
    "p1_filter_scope_user": "A plain semi-join: the planner broadcasts the ticker list where its real size allows it.",
    "t1_asof_previous_bar_sup": "Both sides meet in one ordered union, shuffled by (ticker, cell); the carries of the cells are a small "
    "aggregate joined by the same key. No pair of rows is formed.",
    "t3_sessions_sup": "One exchange by (ticker, cell) serves the window and the pieces' aggregate; only pieces near a cell's edge are shuffled by ticker.",
    "t8_calendar_features_sup": "Bars are aggregated once, then framed by (ticker, cell); history rows that a later cell needs are repeated before that exchange.",
    "t9_reconcile_bars_sup": "Both sides are aggregated by (ticker, date), then meet in a full outer join by null-safe keys.",
    "a6_build_cases": "First hit per (ticker, date) as a partial min_by aggregate; one shuffle plus the final sort.",
}


def summarise(plan: str) -> tuple[list[str], str, list[str]]:
    tree = plan.split("\n\n")[0]
    ops = [ln.rstrip() for ln in tree.splitlines()[1:] if ln.strip()]
    shuffles = len(re.findall(r"(?<![A-Za-z])Exchange \(", tree))
    broadcasts = len(re.findall(r"BroadcastExchange \(", tree))
    pushed = sorted(set(re.findall(r"PushedFilters: \[([^\]]*)\]", plan)))
    return ops, f"{shuffles} shuffle, {broadcasts} broadcast", pushed


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 16)
    out = ["# PLANS", "", f"Physical plans (`explain('formatted')`, AQE initial plan) at `{sf}`, generated by `tools/explain_plans.py`.", ""]
    for name, fn in SHOW.items():
        df = fn(spark, sf)
        plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        ops, n_ex, pushed = summarise(plan)
        out += [f"## {name}", "", NOTES.get(name, ""), "",
                f"Exchanges: {n_ex}" + (f"; pushed filters: {pushed}" if pushed and any(pushed) else ""), "", "```"]
        out += ops[:60] + (["..."] if len(ops) > 60 else []) + ["```", ""]
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
