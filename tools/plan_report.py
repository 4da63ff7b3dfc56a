"""Summarize the physical plan of every batch query into PLANS.md.

    python tools/plan_report.py [sf_dir] > PLANS.md

For each registered query: shuffles (Exchange), windows, aggregates, join
strategies and, per Parquet scan, the columns read and the filters pushed.
Plans are taken before execution (AQE may still turn a shuffle join into a
broadcast join at run time after measuring the smaller side).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from candlewick.plans import catalog  # noqa: E402
from candlewick.session import get_spark  # noqa: E402
from candlewick.sources.tables import table  # noqa: E402
from candlewick.streaming import hot_path, replay  # noqa: E402

# These read what the stream left behind (state, sinks) or run jobs first; the plans of its batches are listed instead.
SKIP = {"stream_snapshot", "stream_recent", "stream_alerts", "stream_alerts_blocks", "stream_alerts_every", "stream_recent_capped", "stream_routed", "stream_rejected", "stream_orderbook", "realtime_price"}


def batch_plans(spark, sf):
    """What a micro-batch runs, on the events as one batch."""
    raw = replay.kafka_records(table(spark, sf, "events"))
    checked = hot_path.parse_stream(raw)
    yield "(stream batch) parse and check", checked
    yield "(stream batch) routed messages", hot_path.route_by_type(checked)
    yield "(stream batch) rows of the keyed state", hot_path.symbol_rows(checked)
    yield "(stream batch) rejected rows", hot_path.rejected_rows(checked)


def summarize(plan: str) -> dict:
    lines = [ln.strip() for ln in plan.split("\n")]
    out = {"exchange": 0, "window": 0, "limit": 0, "agg": 0, "joins": [], "scans": []}
    for ln in lines:
        node = re.sub(r"^[:+\-\s|]*", "", ln)
        node = re.sub(r"^\*\(\d+\)\s*", "", node)
        if node.startswith("Exchange") or node.startswith("ShuffleQueryStage"):
            out["exchange"] += node.startswith("Exchange")
        elif node.startswith("WindowGroupLimit"):
            out["limit"] += 1
        elif node.startswith("Window"):
            out["window"] += 1
        elif re.match(r"(HashAggregate|SortAggregate|ObjectHashAggregate)", node):
            out["agg"] += 1
        elif re.match(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin)", node):
            kind = node.split(" ")[0]
            how = re.search(r"\b(Inner|LeftSemi|LeftAnti|LeftOuter|RightOuter|FullOuter)\b", node)
            out["joins"].append(f"{kind}({how.group(1) if how else '?'})")
        elif node.startswith("FileScan parquet"):
            cols = re.search(r"FileScan parquet \[([^\]]*)\]", node)
            pushed = re.search(r"PushedFilters: \[([^\]]*)\]", node)
            table = re.search(r"/([a-z_]+)\.parquet", node)
            out["scans"].append((table.group(1) if table else "?",
                                 re.sub(r"#\d+L?", "", cols.group(1)) if cols else "",
                                 pushed.group(1) if pushed else ""))
    return out


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_spark("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `tools/plan_report.py` on `{sf}` (plans before execution; AQE can still switch a")
    print("shuffle join to a broadcast join once it has measured the smaller side). Of the streaming queries")
    print("the steps of a micro-batch are listed. Group limits stand on both sides of an exchange.\n")
    print("| query | exchanges | windows | group limits | aggregates | joins | scans: table [columns read] (pushed filters) |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    frames = [(n, lambda f=f: f(spark, sf)) for n, f in catalog.queries().items() if n not in SKIP]
    frames += [(n, lambda d=d: d) for n, d in batch_plans(spark, sf)]
    for name, make in frames:
        try:
            df = make()
            s = summarize(df._jdf.queryExecution().executedPlan().toString())
        except Exception as e:  # noqa: BLE001
            print(f"| {name} | error: {type(e).__name__} | | | | |")
            continue
        scans = "<br>".join(f"{t} [{c}]" + (f" ({p})" if p else "") for t, c, p in s["scans"])
        print(f"| {name} | {s['exchange']} | {s['window']} | {s['limit']} | {s['agg']} | {', '.join(s['joins']) or '-'} | {scans} |")


if __name__ == "__main__":
    main()
