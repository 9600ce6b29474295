"""Benchmark the headline queries; prints ONE JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEATS (default 3; the best run of each query is reported), BENCH_WARMUP
(default 1: one untimed pass over all queries first, so timings are steady-state).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "profile_all_tables",  # type-driven profile of every table (scan agg + per-column frequency passes)
    "profile_numeric",
    "check_status_rollup",  # checks, statuses and roll-up
    "expect_between",
    "expect_unexpected_sample",  # rule counts + bounded value samples
    "generate_suite",  # metrics -> rules
    "combined_validation",  # metrics -> rules -> validation, 5 tables
    "rule_agreement",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))

    from assay.plans.queries import QUERIES, table
    from assay.operators.profile import profile
    from assay.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, memory="16g")
    profile(table(spark, sf_dir, "region"), "region").collect()
    if os.environ.get("BENCH_WARMUP", "1") != "0":
        for name in HEADLINE:  # one untimed pass: JVM JIT and codegen caches reach steady state
            QUERIES[name](spark, sf_dir).collect()

    times: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in HEADLINE:
        best = None
        for _ in range(repeats):
            t = time.perf_counter()
            out = QUERIES[name](spark, sf_dir).collect()
            dt = time.perf_counter() - t
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
        rows[name] = len(out)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "headline_total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "rows": rows,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
