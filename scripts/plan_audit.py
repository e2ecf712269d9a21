"""Audit the physical plans of all registered queries for scale red flags.

    python scripts/plan_audit.py [sf_dir] [name ...] > PLANS.md

Per query: shuffles, broadcasts (and what they carry), windows, Python stages, joins
that are cartesian or nested-loop, single-partition exchanges, and scans with their
pushed filters.  Plans are the AQE initial plans (before runtime re-optimisation).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.plans.registry import load_all  # noqa: E402
from tessera.plans.views import Views  # noqa: E402
from tessera.session import local_session  # noqa: E402

FLAGS = {
    "cartesian": r"CartesianProduct",
    "nested_loop": r"BroadcastNestedLoopJoin",
    "single_partition": r"SinglePartition",
    "window": r"\bWindow\b",
}


def plan_text(df) -> str:
    """The executed plan plus the plans of all its (scalar) subqueries."""
    plan = df._jdf.queryExecution().executedPlan()
    parts = [plan.toString()]
    subs = plan.subqueriesAll()
    for i in range(subs.size()):
        parts.append(subs.apply(i).toString())
    return "\n".join(parts)


def main():
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    spark = local_session(8, 16)
    reg = load_all()
    print("# Plan audit\n")
    print(f"Generated by `scripts/plan_audit.py` over `{sf}` (initial AQE plans).\n")
    print("| query | shuffles | broadcasts | python stages | windows | red flags | pushed filters |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    for name, q in reg.items():
        if names and name not in names:
            continue
        df = q.fn(Views(spark, sf))
        txt = plan_text(df)
        shuffles = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobin|SinglePartition)", txt))
        bcast = len(re.findall(r"BroadcastExchange", txt))
        py = len(re.findall(r"(MapInPandas|FlatMapGroupsInPandas|ArrowEvalPython|BatchEvalPython|MapInArrow)", txt))
        win = len(re.findall(FLAGS["window"], txt))
        red = [k for k, pat in FLAGS.items() if k not in ("window", "single_partition") and re.search(pat, txt)]
        # a SinglePartition exchange is only a flag when it does not carry partial
        # aggregates or a top-n (both are one row / n rows per task)
        lines = txt.split("\n")
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line and i + 1 < len(lines):
                nxt = lines[i + 1]
                if not re.search(r"HashAggregate|ObjectHashAggregate|SortAggregate|TakeOrderedAndProject|"
                                 r"CollectLimit|GlobalLimit|LocalLimit", nxt):
                    red.append("single_partition")
                    break
        pushed = sorted(set(re.findall(r"PushedFilters: \[([^\]]+)\]", txt)))
        pf = "; ".join(p[:60] for p in pushed[:2]) if pushed else ""
        print(f"| {name} | {shuffles} | {bcast} | {py} | {win} | {', '.join(red)} | {pf} |")


if __name__ == "__main__":
    main()
