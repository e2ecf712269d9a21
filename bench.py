"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is planned and executed in full through the ``noop`` sink (no collect to
the driver), once to warm up and then ``BENCH_REPEAT`` times; the best warm time is
reported.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "platform_snapshot", "latest_per_key", "status_transitions", "join_evaluations",
    "consumer_lag", "repair_responses", "build_solutions", "sessions", "stream_join",
    "domains", "apply_idea_actions", "cost_rollup", "late_rows", "previews_and_lines",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    names = sys.argv[1:] or HEADLINE

    from tessera.plans.registry import load_all
    from tessera.plans.views import Views
    from tessera.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2, app="tessera-bench")
    reg = load_all()
    times: dict[str, float] = {}
    for name in names:
        q = reg[name]
        best = None
        for i in range(1 + repeat):
            t0 = time.perf_counter()
            df = q.fn(Views(spark, sf_dir))
            df.write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            if i > 0:
                best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total_warm", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
