"""End-to-end flows over a directory of tables.

* :func:`profile_and_check`  - metrics + checks for every table (profile and
  check analyzers share one scan per table).
* :func:`validate_static`    - the registered expectation suite of every table.
* :func:`validate_generated` - suites derived from saved metrics, then validated,
  plus a cross-table summary.

Per-table work runs in a small thread pool (Spark runs the jobs of several
threads side by side), each table in its own ``try``: a broken file is
reported and the other tables still finish. Every table's results are
checkpointed (small frames), then all tables are written together, so the
number of write jobs does not grow with the number of tables.

For a single DataFrame already in hand, :func:`generate_and_validate` is the
in-memory version of the generated-suite flow.
"""

from __future__ import annotations

import logging
import os
import threading
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.operators import expectations as X
from assay.operators.analyzers import DuplicateRows
from assay.operators.checks import Check, evaluate_checks, rollup
from assay.operators.generate import RULES_SCHEMA, generate_rules, rules_to_expectations, suite_name_for
from assay.operators.profile import profile_analyzers
from assay.plans.registry import STATIC_CHECKS, STATIC_SUITES, checks_for, suite_for, suite_name_of
from assay.plans.parallel import compute_metrics
from assay.session import materialize, remove, stage_as_parquet
from assay.sources import results as R
from assay.sources.tables import MALFORMED, list_tables, read_table

log = logging.getLogger("assay")

PIPELINE_TYPE = "combined_metrics_to_expectations"


@dataclass
class TableRun:
    table_name: str
    path: str
    status: str  # ok | skipped | failed
    detail: str = ""
    malformed: int = 0  # CSV lines that do not fit the header or the declared types
    frames: dict[str, DataFrame] = field(default_factory=dict, repr=False)


@dataclass
class FlowResult:
    runs: list[TableRun]
    outputs: dict[str, DataFrame] = field(default_factory=dict, repr=False)

    def by_status(self, status: str) -> list[str]:
        return [r.table_name for r in self.runs if r.status == status]


def load(
    spark: SparkSession,
    path: str,
    fmt: str | None = None,
    stage: bool = True,
    name: str = "t",
    options: Mapping | None = None,
    staged: list[str] | None = None,
) -> tuple[DataFrame, int]:
    """(table, number of malformed lines); row-oriented sources are staged to Parquet once.

    ``options`` are reader arguments of the table (``schema``, ``null_tokens``). Malformed
    CSV lines stay in the table as far as they can be read, and are counted.
    """
    kind = (fmt or path.rsplit(".", 1)[-1]).lower()
    df = read_table(spark, path, fmt, malformed=stage and kind == "csv", **(options or {}))
    if not stage or kind not in ("csv", "json"):
        return df, 0
    df = stage_as_parquet(df, name, staged)
    if MALFORMED not in df.columns:
        return df, 0
    bad = df.where(F.col(MALFORMED).isNotNull()).count()
    if bad:
        log.warning("table %s: %d malformed lines", name, bad)
    return df.drop(MALFORMED), bad


class Staging:
    """Tables of a run, each read (and staged, if it is row-oriented) once however many flows use it.

    As a context manager it removes the staged copies at the end, also after an error.
    """

    def __init__(self, spark: SparkSession, stage: bool = True, options: Mapping[str, Mapping] | None = None):
        self.spark, self.stage, self.options = spark, stage, options or {}
        self.folders: list[str] = []
        self._tables: dict[str, tuple[DataFrame, int]] = {}
        self._locks: dict[str, threading.Lock] = {}
        self._guard = threading.Lock()

    def table(self, name: str, path: str) -> tuple[DataFrame, int]:
        """(table, number of malformed lines)."""
        with self._guard:
            lock = self._locks.setdefault(path, threading.Lock())
        with lock:
            if path not in self._tables:
                self._tables[path] = load(self.spark, path, stage=self.stage, name=name, options=self.options.get(name), staged=self.folders)
            return self._tables[path]

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *error) -> None:
        while self.folders:
            remove(self.spark, self.folders.pop())


@contextmanager
def _staging(given: Staging | None, spark: SparkSession, stage: bool, options: Mapping[str, Mapping] | None) -> Iterator[Staging]:
    """The caller's staging, which the caller ends, or one for this flow alone."""
    if given is not None:
        yield given
        return
    with Staging(spark, stage, options) as own:
        yield own


def _run_tables(
    tables: Sequence[tuple[str, str]], work: Callable[[str, str], TableRun], max_parallel: int
) -> list[TableRun]:
    def guarded(t):
        name, path = t
        try:
            return work(name, path)
        except Exception as e:  # noqa: BLE001 - isolate one table's failure
            log.error("table %s failed: %s", name, e)
            return TableRun(name, path, "failed", str(e).splitlines()[0] if str(e) else type(e).__name__)

    with ThreadPoolExecutor(max_workers=max(1, max_parallel)) as pool:
        return list(pool.map(guarded, tables))


def _union(runs: list[TableRun], key: str) -> DataFrame | None:
    frames = [r.frames[key] for r in runs if r.status == "ok" and key in r.frames]
    return reduce(DataFrame.unionByName, frames) if frames else None


# ---- F1: profile + checks -------------------------------------------------------------


def profile_and_check_frame(
    df: DataFrame, table_name: str, checks: Sequence[Check]
) -> tuple[DataFrame, DataFrame]:
    """(profile metrics, constraint results) of one table from ONE metrics run."""
    spark = df.sparkSession
    analyzers = profile_analyzers(df.schema)
    n_profile = len(analyzers)
    analyzers += [a for c in checks for a in c.analyzers()]
    all_metrics = compute_metrics({table_name: (df, analyzers)})
    constraints = evaluate_checks(spark, all_metrics, {table_name: list(checks)}).constraints
    return all_metrics.where(F.col("seq") < n_profile), materialize(constraints)


def profile_and_check(
    spark: SparkSession,
    dataset_dir: str,
    output_dir: str,
    checks: Mapping[str, Sequence[Check]] = STATIC_CHECKS,
    suffix: str = ".csv",
    max_parallel: int = 4,
    stage: bool = True,
    options: Mapping[str, Mapping] | None = None,
    staging: Staging | None = None,
) -> FlowResult:
    """Metrics and checks of every table; ``options`` gives reader arguments by table name."""

    with _staging(staging, spark, stage, options) as tables_of:
        def work(name, path):
            df, bad = tables_of.table(name, path)
            metrics, constraints = profile_and_check_frame(df, name, checks_for(name, checks))
            return TableRun(name, path, "ok", malformed=bad, frames={"metrics": metrics, "constraints": constraints})

        runs = _run_tables(list_tables(spark, dataset_dir, suffix), work, max_parallel)
        out: dict[str, DataFrame] = {}
        metrics, constraints = _union(runs, "metrics"), _union(runs, "constraints")
        if metrics is not None:
            out["metrics"] = metrics
            R.write_result(metrics, output_dir, R.METRICS)
            R.write_report(metrics.drop("entity", "instance", "metric"), output_dir, "metrics", "metrics")
        if constraints is not None:
            check_df, status = rollup(constraints)
            out.update(constraints=constraints, checks=check_df, verification=status)
            R.write_result(constraints, output_dir, R.CONSTRAINTS)
            R.write_result(check_df, output_dir, R.CHECKS)
            R.write_result(status, output_dir, R.VERIFICATION)
            R.write_result(R.one_file_per_table(check_documents(constraints, check_df, status)), os.path.join(output_dir, R.REPORTS), R.CHECKS)
        return FlowResult(runs, out)


def check_documents(constraints: DataFrame, checks: DataFrame, status: DataFrame) -> DataFrame:
    """One document per table: overall_status and check_results[{check_name, status, constraints[]}]."""
    rows = constraints.groupBy("table_name", "check_seq").agg(
        F.sort_array(F.collect_list(F.struct("seq", "constraint", "status", "message"))).alias("rows")
    )
    rows = rows.withColumn("constraints", F.transform("rows", lambda c: c.dropFields("seq"))).drop("rows")
    listed = checks.join(rows, ["table_name", "check_seq"]).groupBy("table_name").agg(
        F.sort_array(F.collect_list(F.struct("check_seq", "check_name", "status", "constraints"))).alias("rows")
    )
    return listed.join(status, "table_name").select(
        "table_name",
        F.current_timestamp().cast("string").alias("timestamp"),
        "overall_status",
        F.transform("rows", lambda c: c.dropFields("check_seq")).alias("check_results"),
    )


# ---- F2: static suites ------------------------------------------------------------------


def data_shapes(results: DataFrame) -> DataFrame:
    """Rows and columns validated per table, carried by the rule results."""
    return results.groupBy("table_name").agg(
        F.max("n_rows").alias("rows"),
        F.max("n_columns").alias("columns"),
    )


def validate_frame(
    df: DataFrame,
    table_name: str,
    rules: Sequence[X.Expectation],
    suite_name: str,
    known: tuple[DataFrame, set] | None = None,
) -> DataFrame:
    """Materialized results of one suite; its metrics come from bounded plans run side by side.

    ``known`` = (metric rows already measured on this same ``df``, their
    ``(metric, instance)`` keys), e.g. duplicate-row counts from its profile;
    those analyzers are not rerun.
    """
    analyzers = X.rule_analyzers(rules)
    if known is not None:
        known, have = known
        analyzers = [a for a in analyzers if a.key not in have]
    metrics = compute_metrics({table_name: (df, analyzers)})
    if known is not None:
        metrics = metrics.unionByName(known)
    res = X.validate(df, rules, table_name, suite_name, metrics=metrics)
    size = metrics.where("metric = 'Size'").select("value").first()  # one number
    rows = int(size["value"]) if size is not None and size["value"] is not None else None
    return materialize(
        res.withColumn("n_columns", F.lit(len(df.columns))).withColumn("n_rows", F.lit(rows).cast("long"))
    )


def _write_expectations(results: DataFrame, output_dir: str, name: str, extra: dict | None = None) -> DataFrame:
    R.write_result(results.drop("n_columns", "n_rows"), output_dir, name)
    outcome = X.suite_outcome(results).join(data_shapes(results), "table_name")
    doc = (
        R.nested_report(results.drop("n_columns", "n_rows", "suite_name"), "results", extra=extra)
        .join(outcome, "table_name")
        .select(
            "table_name",
            "timestamp",
            *(extra or {}),
            F.struct("rows", "columns").alias("data_shape"),
            "validation_success",
            "results",
        )
    )
    R.write_result(R.one_file_per_table(doc), os.path.join(output_dir, R.REPORTS), name)
    return outcome


def validate_static(
    spark: SparkSession,
    dataset_dir: str,
    output_dir: str,
    suites: Mapping[str, Sequence[X.Expectation]] = STATIC_SUITES,
    suffix: str = ".csv",
    max_parallel: int = 4,
    stage: bool = True,
    options: Mapping[str, Mapping] | None = None,
    staging: Staging | None = None,
) -> FlowResult:
    """The registered suite of every table; tables without one are skipped."""

    with _staging(staging, spark, stage, options) as tables_of:
        def work(name, path):
            suite = suite_for(name, suites)
            if suite is None:
                log.warning("no expectation suite for table %s", name)
                return TableRun(name, path, "skipped", "no suite")
            df, bad = tables_of.table(name, path)
            results = validate_frame(df, name, suite, suite_name_of(name))
            return TableRun(name, path, "ok", malformed=bad, frames={"results": results})

        runs = _run_tables(list_tables(spark, dataset_dir, suffix), work, max_parallel)
        results = _union(runs, "results")
        out: dict[str, DataFrame] = {}
        if results is not None:
            out["results"] = results
            out["outcome"] = _write_expectations(results, output_dir, R.EXPECTATIONS)
        return FlowResult(runs, out)


# ---- F3-F5: generated suites + summary ---------------------------------------------------


def generate_and_validate(
    df: DataFrame, table_name: str, metrics: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """(rules, results) for one table: profile (unless ``metrics`` given) -> rules -> validation.

    The rules are data dependent, so the small rules frame is collected to
    plan the validation (a few rows per column); the data itself never
    leaves the executors.

    When the profile is computed here from ``df`` itself, the duplicate-row
    counts that uniqueness rules need are taken from the profile's own
    frequency passes (same data, same shuffle), so validating the suite
    costs one shuffle-free aggregation instead of repeating those shuffles.
    Saved ``metrics`` may describe other data, so then everything is
    measured again.
    """
    carried = None
    if metrics is None:
        strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        extra = [DuplicateRows(c) for c in strings]
        metrics = compute_metrics({table_name: (df, profile_analyzers(df.schema) + extra)})
        carried = (metrics.where(F.col("metric") == DuplicateRows.metric), {a.key for a in extra})
    else:
        metrics = materialize(metrics)
    # the rules plan the validation, so they come to the driver anyway (a few rows per
    # column); the returned frame is rebuilt from those rows instead of recomputed
    rows = generate_rules(metrics, {table_name: df.columns}).collect()
    rules = df.sparkSession.createDataFrame(rows, RULES_SCHEMA)
    expectations = rules_to_expectations(rows)
    return rules, validate_frame(df, table_name, expectations, suite_name_for(table_name), carried)


def summary(results: DataFrame) -> DataFrame:
    """Per table: validation_success and rule counts (total, successful, failed)."""
    return X.suite_outcome(results)


def validate_generated(
    spark: SparkSession,
    dataset_dir: str,
    output_dir: str,
    suffix: str = ".csv",
    max_parallel: int = 4,
    stage: bool = True,
    options: Mapping[str, Mapping] | None = None,
    staging: Staging | None = None,
) -> FlowResult:
    """Suites from saved metrics, validated, with a summary document over all tables."""
    tables = list_tables(spark, dataset_dir, suffix)
    if not tables:
        log.warning("no tables in %s", dataset_dir)
        return FlowResult([])

    with _staging(staging, spark, stage, options) as tables_of:
        def work(name, path):
            metrics = R.read_metrics(spark, output_dir, name)
            if metrics is None:
                log.warning("skipping %s: no saved metrics", name)
                return TableRun(name, path, "skipped", "no metrics")
            df, bad = tables_of.table(name, path)
            rules, results = generate_and_validate(df, name, metrics)
            return TableRun(name, path, "ok", malformed=bad, frames={"rules": rules, "results": results})

        runs = _run_tables(tables, work, max_parallel)
        out: dict[str, DataFrame] = {}
        rules, results = _union(runs, "rules"), _union(runs, "results")
        if rules is not None:
            out["rules"] = rules
            R.write_result(rules, output_dir, R.RULES)
        if results is not None:
            out["results"] = results
            extra = {"pipeline_type": PIPELINE_TYPE, "expectations_from_metrics": True}
            _write_expectations(results, output_dir, R.COMBINED, extra)
            processed = len([r for r in runs if r.status == "ok"])
            s = summary(results)
            out["summary"] = s.select(
                F.lit(PIPELINE_TYPE).alias("pipeline_type"), F.lit(processed).alias("total_tables_processed"), "*"
            )
            # one row per table: one document
            document = s.groupBy().agg(F.sort_array(F.collect_list(F.struct("*"))).alias("table_results")).select(
                F.lit(PIPELINE_TYPE).alias("pipeline_type"),
                F.current_timestamp().cast("string").alias("timestamp"),
                F.lit(processed).alias("total_tables_processed"),
                "table_results",
            )
            document.coalesce(1).write.mode("overwrite").json(os.path.join(output_dir, R.SUMMARY))
        return FlowResult(runs, out)
