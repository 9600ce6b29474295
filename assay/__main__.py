"""Command line: run the directory flows.

    python -m assay checks      DATASET_DIR OUTPUT_DIR   # metrics + checks (F1)
    python -m assay suites      DATASET_DIR OUTPUT_DIR   # registered expectation suites (F2)
    python -m assay generated   DATASET_DIR OUTPUT_DIR   # suites from saved metrics + summary (F4, F5)
    python -m assay all         DATASET_DIR OUTPUT_DIR   # the three in order

Uses the session configuration of the environment (spark-submit / defaults);
``--local N`` starts a local session instead. Types and null tokens of CSV tables:

    --null-token NA --null-token -               # for every table
    --schema orders="id BIGINT, price DOUBLE"    # for one table, as often as needed

A run reads and stages every table once, whatever the number of its flows.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from assay.plans import flows
from assay.sources.tables import list_tables


def _report(name: str, result: flows.FlowResult) -> dict:
    return {
        "flow": name,
        "ok": result.by_status("ok"),
        "skipped": result.by_status("skipped"),
        "failed": {r.table_name: r.detail for r in result.runs if r.status == "failed"},
    }


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="python -m assay", description="Data-quality flows over a directory of tables")
    p.add_argument("mode", choices=["checks", "suites", "generated", "all"])
    p.add_argument("dataset")
    p.add_argument("output")
    p.add_argument("--suffix", default=".csv", help="file suffix of the tables (default .csv)")
    p.add_argument("--parallel", type=int, default=4, help="tables processed side by side")
    p.add_argument("--local", metavar="N", help="start a local[N] session instead of the configured one")
    p.add_argument("--schema", action="append", default=[], metavar="TABLE=DDL", help="declared types of a CSV table (else inferred)")
    p.add_argument("--null-token", action="append", default=[], metavar="TEXT", help="text that is null in string columns, besides the empty one")
    args = p.parse_args(argv)
    bad = [x for x in args.schema if "=" not in x]
    if bad:
        p.error(f"--schema {bad[0]}: TABLE=DDL expected")

    if args.local:
        from assay.session import local_session

        spark = local_session(cores=args.local)
    else:
        spark = SparkSession.builder.appName("assay").getOrCreate()

    schemas = {name.strip().lower(): ddl for name, ddl in (x.split("=", 1) for x in args.schema)}
    tokens = ("", *args.null_token)
    names = [name for name, _ in list_tables(spark, args.dataset, args.suffix)]
    options = {n: {"null_tokens": tokens} | ({"schema": schemas[n]} if n in schemas else {}) for n in names}
    run = {"checks": flows.profile_and_check, "suites": flows.validate_static, "generated": flows.validate_generated}
    reports = []
    with flows.Staging(spark, options=options) as staging:
        for mode, flow in run.items():
            if args.mode in (mode, "all"):
                result = flow(spark, args.dataset, args.output, suffix=args.suffix, max_parallel=args.parallel, staging=staging)
                reports.append(_report(mode, result))
    for r in reports:
        print(json.dumps(r))
    return 1 if any(r["failed"] for r in reports) else 0


if __name__ == "__main__":
    sys.exit(main())
