"""Summarise the physical plan of every registered query into PLANS.md.

For each query: shuffles (Exchange), join strategies, window partitioning,
Python UDF operators, parquet scans with pushed filters and read schema.
Model queries (which run jobs while planning) are skipped.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pulsekit import get_spark  # noqa: E402
from pulsekit.plans.catalog import load_all  # noqa: E402


def summarise(plan: str) -> dict:
    lines = plan.splitlines()
    ex = [ln for ln in lines if "Exchange " in ln and "BroadcastExchange" not in ln and "ReusedExchange" not in ln]
    kinds = sorted({re.sub(r".*Exchange (\w+).*", r"\1", ln) for ln in ex})
    joins = sorted({m for ln in lines for m in re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)", ln)})
    wins = [ln for ln in lines if "Window [" in ln]
    unpart = sum(1 for ln in wins if "], [], [" in ln)
    py = sorted({m for ln in lines for m in re.findall(r"(ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroupsInPandas)", ln)})
    pushed = sorted({m for ln in lines for m in re.findall(r"PushedFilters: \[([^\]]+)\]", ln)})
    schemas = sorted({m for ln in lines for m in re.findall(r"ReadSchema: (struct<[^>]*>)", ln)})
    return {"shuffles": len(ex), "kinds": ",".join(kinds), "joins": ",".join(joins) or "-",
            "windows": f"{len(wins)} ({unpart} unpartitioned)" if wins else "-", "python": ",".join(py) or "-",
            "pushed": "; ".join(pushed) or "-", "schemas": " ".join(schemas)}


def main() -> None:
    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = get_spark("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    q, _ = load_all()
    rows = []
    for name, fn in q.items():
        if name.startswith("model_") and name != "model_gates":
            continue
        df = fn(spark, sf_dir)
        s = summarise(df._jdf.queryExecution().executedPlan().toString())
        rows.append((name, s))
        print(name, s["shuffles"], flush=True)
    out = ["# Physical plans of the registered queries", "",
           f"Generated by `tools/plan_report.py` at {os.path.basename(sf_dir)} (AQE initial plans; "
           "intermediates that are checkpointed appear as scans of the checkpoint).", "",
           "`RoundRobinPartitioning` comes from the small-scan rule: the test files are single row groups, so the "
           "scan is spread over the task slots; inputs with enough splits (any large table) skip it.", "",
           "| query | shuffles | exchange kinds | joins | windows | python | pushed filters |", "|---|---|---|---|---|---|---|"]
    for name, s in rows:
        out.append(f"| {name} | {s['shuffles']} | {s['kinds']} | {s['joins']} | {s['windows']} | {s['python']} | {s['pushed']} |")
    out += ["", "Read schemas per query (column pruning at the parquet scan):", ""]
    for name, s in rows:
        out.append(f"* `{name}`: {s['schemas'] or '(checkpoint / local data)'}")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out) + "\n")


if __name__ == "__main__":
    main()
