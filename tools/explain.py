"""Print the plan facts that matter at scale for the headline operators and registered queries.

Usage: python tools/explain.py [sf_dir] > PLANS.md
For each operator: the scans (columns read, filters pushed to Parquet), the
exchanges (shuffles) and any partial top-k or broadcast, from the executed
physical plan (``explain("formatted")``). Registered queries compute and checkpoint their
small results while they are built, so the plans of those inner frames are recorded on the way.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEEP = re.compile(r"^(ReadSchema|PushedFilters|Arguments: (hashpartitioning|SinglePartition|HashedRelationBroadcastMode))")
NODES = re.compile(r"\((\d+)\) (Exchange|WindowGroupLimit|BroadcastExchange|BroadcastHashJoin|TakeOrderedAndProject|Generate|Union)")


def facts(df) -> list[str]:
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    out, tree = [], text.split("\n\n")[0]
    counts = {}
    for name in ("Exchange", "WindowGroupLimit", "BroadcastExchange", "TakeOrderedAndProject", "Scan parquet"):
        counts[name] = len(re.findall(rf"[-+] {name} ", tree + " "))
    out.append("operators: " + ", ".join(f"{k} x{v}" for k, v in counts.items() if v))
    seen = []
    for line in text.splitlines():
        line = line.strip()
        if KEEP.match(line) and line not in seen:
            seen.append(line)
    return out + seen


#: The costliest registered queries of the bench.
QUERIES = ["combined_validation", "profile_all_tables", "expect_unexpected_sample", "generate_suite", "rule_agreement"]


def inner_plans(spark, sf_dir: str, name: str) -> list[list[str]]:
    """Facts of every frame that a registered query materializes."""
    from assay.operators import expectations
    from assay.plans import flows, parallel, queries

    found: list[list[str]] = []
    plain = parallel.materialize

    def recorded(df):
        found.append(facts(df))
        return plain(df)

    holders = [m for m in (parallel, flows, queries, expectations) if hasattr(m, "materialize")]
    for m in holders:
        m.materialize = recorded
    try:
        queries.QUERIES[name](spark, sf_dir).collect()
    finally:
        for m in holders:
            m.materialize = plain
    return found


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from assay.operators import expectations as X
    from assay.operators.analyzers import analyzer_plans
    from assay.operators.checks import Check
    from assay.operators.profile import profile, profile_analyzers
    from assay.session import local_session

    spark = local_session()
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    cases = {
        "profile(lineitem): one scan aggregate + one single-column pass per column, shared stats": profile(li, "lineitem"),
        "validate with samples: counts + one sample scan with pushed predicates and partial top-k": X.validate(
            li,
            [
                X.expect_column_values_to_be_in_set("l_returnflag", ["A", "N"]),
                X.expect_column_values_to_be_between("l_quantity", 1, 40),
                X.expect_column_values_to_be_unique("l_orderkey"),
            ],
            "lineitem",
        ),
        "checks: the analyzers of all constraints in one plan": __import__(
            "assay.operators.analyzers", fromlist=["run_analyzers"]
        ).run_analyzers(
            li,
            Check("c").has_size().is_complete("l_orderkey").is_contained_in("l_returnflag", ["A", "N", "R"])
            .satisfies("l_quantity > 0", "qty").analyzers(),
            "lineitem",
        ),
        "bounded plans for a wide table (first of several)": analyzer_plans(
            li, profile_analyzers(li.schema), "lineitem", max_columns=4
        )[0],
    }
    print(f"# Plan facts ({os.path.basename(sf_dir)}, generated by tools/explain.py)\n")
    for title, df in cases.items():
        print(f"## {title}\n\n```")
        for line in facts(df):
            print(line[:300])
        print("```\n")
    for name in QUERIES:
        plans = inner_plans(spark, sf_dir, name)
        print(f"## {name}: {len(plans)} materialized plans\n\n```")
        for plan in sorted(plans):
            print(plan[0])
            keys = [line for line in plan if line.startswith("Arguments: hash")]
            for line in keys:
                print("  " + re.sub(r"#\d+L?|, \[plan_id=\d+\]", "", line)[11:200])
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main()
