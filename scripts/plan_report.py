"""Summarise the executed (post-AQE) physical plan of the headline queries.

Usage: python scripts/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from quarry.plans import all_queries  # noqa: E402
from quarry.session import get_session  # noqa: E402

def _op(line: str) -> str:
    """The operator text of one plan line, without tree drawing and codegen ids."""
    return re.sub(r"^[\s:|+\-]*(\*\(\d+\)\s*)?", "", line)


COUNTS = [
    ("shuffles", lambda op, raw: op.startswith("Exchange ")),
    ("reused", lambda op, raw: op.startswith("ReusedExchange")),
    ("broadcasts", lambda op, raw: op.startswith("BroadcastExchange")),
    ("SMJ", lambda op, raw: op.startswith("SortMergeJoin")),
    ("BHJ", lambda op, raw: op.startswith("BroadcastHashJoin")),
    ("windows", lambda op, raw: op.startswith("Window [")),
    ("group-limit", lambda op, raw: op.startswith("WindowGroupLimit")),
    ("codegen ops", lambda op, raw: re.match(r"^[\s:|+\-]*\*\(\d+\)", raw) is not None),
    ("python", lambda op, raw: op.startswith(("FlatMapCoGroupsInPandas", "FlatMapGroupsInPandas",
                                               "ArrowEvalPython", "BatchEvalPython"))),
]


def final_plan(df) -> str:
    df.collect()  # runs this DataFrame's own query execution, so AQE finalises its plan
    out, hidden = [], None
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = len(line) - len(line.lstrip(" :|+-"))
        if hidden is not None and depth > hidden:
            continue  # below an initial plan, of the query or of one of its subqueries
        hidden = depth if "== Initial Plan ==" in line else None
        if hidden is None:
            out.append(line)
    return "\n".join(out)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=16)
    qs = all_queries()
    print("# Executed plans of the headline queries\n")
    print(f"Generated by `scripts/plan_report.py` on `{sf_dir}` (local[8], 16 shuffle partitions,")
    print("AQE on).  Counts are over the final adaptive plan of the last job with its subqueries;")
    print("jobs that write intermediate tables before it are not included.  Small inputs make AQE pick")
    print("broadcast joins that become sort-merge joins at scale.\n")
    print("| query | " + " | ".join(c for c, _ in COUNTS) + " | scans (ReadSchema) |")
    print("| --- | " + " | ".join("---" for _ in COUNTS) + " | --- |")
    for key in HEADLINE:
        plan = final_plan(qs[key](spark, sf_dir))
        lines = plan.splitlines()
        counts = [sum(1 for raw in lines if f(_op(raw), raw)) for _, f in COUNTS]
        scans = sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan)))
        print(f"| {key} | " + " | ".join(str(c) for c in counts) + " | " + "<br>".join(scans) + " |")


if __name__ == "__main__":
    main()
