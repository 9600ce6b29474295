"""Registered queries: one per operator family, each over the whole given tables.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame whose
columns carry the same names as the matching SQL in :mod:`assay.plans.oracle`.
Mean and standard deviation are rounded to 6 places in these views (both
engines sum in their own order); all other values are exact.

Rule parameters below are ordinary user configuration for the given tables
(the way a user registers checks for their own tables), not fixed values.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.operators import expectations as X
from assay.operators.analyzers import (
    SKETCH_ERROR,
    ApproxCountDistinct,
    Completeness,
    CountDistinct,
    Distinctness,
    Maximum,
    MaxLength,
    Mean,
    Minimum,
    MinLength,
    Size,
    StandardDeviation,
    Uniqueness,
    run_analyzers,
)
from assay.operators.checks import Check, evaluate_checks
from assay.operators.compare import rule_agreement, threshold_analyzers, threshold_monitor
from assay.operators.domains import discover_domains
from assay.operators.generate import generate_rules, rule_metrics
from assay.operators.history import append_history, deviations, read_history
from assay.operators.profile import profile, profile_analyzers
from assay.operators.sampling import value_sampled_profile
from assay.operators.states import compute_states, metrics_of
from assay.operators.verdicts import RowRule, quarantine
from assay.plans.flows import Staging, generate_and_validate, profile_and_check, summary, validate_generated, validate_static
from assay.plans.parallel import compute_metrics, map_tables, materialized_union, profile_tables, union_all
from assay.plans.registry import checks_for
from assay.session import ensure_checkpoint_dir
from assay.sources import results as R
from assay.sources.typed import read_csv_typed

TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name == "events_nulled":
        return events_nulled(spark, sf_dir)
    if name == "documents_labels":
        return documents_labels(spark, sf_dir)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_nulled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with ``value`` missing for error events (a column with real nulls)."""
    e = table(spark, sf_dir, "events")
    return e.withColumn("value", F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("value")))


def documents_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels where present (``quality``/``toxic`` null otherwise)."""
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")


def tables_of(spark: SparkSession, sf_dir: str, names) -> dict[str, DataFrame]:
    """Open several tables side by side (each open reads file listings and footers)."""
    names = list(names)
    return dict(zip(names, map_tables(lambda n: table(spark, sf_dir, n), names)))


def _round_stats(df: DataFrame) -> DataFrame:
    v = F.col("value")
    return df.withColumn(
        "value", F.when(F.col("metric").isin("Mean", "StandardDeviation"), F.round(v, 6)).otherwise(v)
    )


def _metrics(spark, sf_dir, names, analyzers_for) -> DataFrame:
    return compute_metrics({n: (df, analyzers_for(df)) for n, df in tables_of(spark, sf_dir, names).items()})


# ---- profile --------------------------------------------------------------------------


def profile_size(spark, sf_dir):
    m = _metrics(spark, sf_dir, TABLES, lambda df: [Size()])
    return m.select("table_name", "analyzer", "value")


def profile_completeness(spark, sf_dir):
    m = _metrics(spark, sf_dir, ["events_nulled", "documents_labels"], lambda df: [Completeness(c) for c in df.columns])
    return m.select("table_name", "instance", "value")


def profile_completeness_all(spark, sf_dir):
    m = _metrics(spark, sf_dir, ["events_nulled", "documents_labels", "orders"], lambda df: [Completeness("*")])
    return m.select("table_name", "value")


def profile_distinctness(spark, sf_dir):
    m = _metrics(
        spark, sf_dir, ["orders", "part", "documents", "embeddings"], lambda df: [Distinctness(c) for c in df.columns]
    )
    return m.select("table_name", "instance", "value")


def profile_uniqueness(spark, sf_dir):
    m = _metrics(spark, sf_dir, ["orders", "part", "documents", "pages"], lambda df: [Uniqueness(c) for c in df.columns])
    return m.select("table_name", "instance", "value")


def _numeric(df):
    return [c for c, t in df.dtypes if t in ("int", "bigint", "double", "float", "smallint", "tinyint")]


def profile_numeric(spark, sf_dir):
    m = _metrics(
        spark,
        sf_dir,
        ["lineitem", "customer"],
        lambda df: [a(c) for c in _numeric(df) for a in (Minimum, Maximum, Mean, StandardDeviation)],
    )
    return _round_stats(m).select("table_name", "instance", "metric", "value")


def profile_string_length(spark, sf_dir):
    m = _metrics(
        spark,
        sf_dir,
        ["documents", "customer", "pages", "conversations"],
        lambda df: [a(c) for c, t in df.dtypes if t == "string" for a in (MinLength, MaxLength)],
    )
    return m.select("table_name", "instance", "metric", "value")


def _profiles(spark, sf_dir, names):
    m = profile_tables(tables_of(spark, sf_dir, names))
    return _round_stats(m).select("table_name", "seq", "instance", "metric", "analyzer", "value", "status")


def profile_table(spark, sf_dir):
    return _profiles(spark, sf_dir, ["orders", "events_nulled"])


def profile_all_tables(spark, sf_dir):
    return _profiles(spark, sf_dir, TABLES)


TEXT_COLUMNS = {
    "documents": ["text", "lang", "source"],
    "pages": ["url", "html"],
    "conversations": ["role", "text"],
    "benchmark": ["text"],
}


def profile_text_hashed(spark, sf_dir):
    """Distinctness and uniqueness of text columns: grouped by digests, never by the texts."""
    tables = {
        n: (table(spark, sf_dir, n), [k(c) for c in cols for k in (Distinctness, Uniqueness)])
        for n, cols in TEXT_COLUMNS.items()
    }
    m = compute_metrics(tables)
    return m.select("table_name", "instance", "metric", "value")


def profile_sampled(spark, sf_dir):
    """Profile of a 10% sample of lineitem, chosen by a hash of its key (sampling is the feature)."""
    key = ["l_orderkey", "l_linenumber"]
    m = profile(table(spark, sf_dir, "lineitem"), "lineitem", sample_fraction=0.1, sample_key=key)
    return _round_stats(m).select("table_name", "instance", "metric", "value")


def profile_value_sampled(spark, sf_dir):
    """Profiles with distinctness and uniqueness from a 20% sample of each column's values, and error bounds."""
    parts = []
    for name, columns in (("documents", None), ("orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"])):
        df = table(spark, sf_dir, name)
        parts.append(value_sampled_profile(df.select(columns or df.columns), name, fraction=0.2))
    m = union_all(parts).where("metric NOT IN ('Mean', 'StandardDeviation')")
    return m.select("table_name", "instance", "metric", "metric_type", *(F.round(c, 9).alias(c) for c in ("value", "lower", "upper")))


def profile_merged(spark, sf_dir):
    """Profiles of orders and documents, merged from the stored states of two halves of each."""
    parts = []
    for name, key in (("orders", "o_orderkey"), ("documents", "doc_id")):
        df = table(spark, sf_dir, name)
        wanted, out = profile_analyzers(df.schema), _output(spark)
        halves = [compute_states(df.where(f"pmod(xxhash64({key}), 2) = {h}"), wanted, f"{out}/{name}-{h}") for h in (0, 1)]
        parts.append(metrics_of(halves, df.schema, wanted, name))
    return _round_stats(union_all(parts)).select("table_name", "seq", "instance", "metric", "analyzer", "value", "status")


def profile_sketched(spark, sf_dir):
    """Sketched distinct counts of orders, documents and lineitem, merged from states of two halves, beside the exact ones."""
    parts = []
    for name, key in (("orders", "o_orderkey"), ("documents", "doc_id"), ("lineitem", "l_orderkey")):
        df = table(spark, sf_dir, name)
        wanted, out = [ApproxCountDistinct(c) for c in df.columns], _output(spark)
        halves = [compute_states(df.where(f"pmod(xxhash64({key}), 2) = {h}"), wanted, f"{out}/{name}-{h}") for h in (0, 1)]
        exact = compute_metrics({name: (df, [CountDistinct(c) for c in df.columns])}).select("instance", F.col("value").alias("exact"))
        both = metrics_of(halves, df.schema, wanted, name).join(exact, "instance")
        parts.append(both.select("table_name", "instance", "exact", (F.abs(F.col("value") - F.col("exact")) <= SKETCH_ERROR * F.col("exact")).alias("within_error")))
    return union_all(parts)


HISTORY_METRICS = [
    Size(), Completeness("value"), Minimum("value"), Maximum("value"), Mean("value"), Distinctness("user_id"), Uniqueness("event_type"),
]


def metric_history(spark, sf_dir):
    """Metrics of events by day (one pass, a state for each day), kept as runs, each held against its own past."""
    df = table(spark, sf_dir, "events_nulled")
    out = _output(spark)
    days = compute_states(df, HISTORY_METRICS, f"{out}/states", segment="CAST(ts AS DATE)")
    metrics = metrics_of(days, df.schema, HISTORY_METRICS, "events_nulled", by_segment=True)
    append_history(_round_stats(metrics).withColumnRenamed("segment", "run"), f"{out}/history")
    history = read_history(spark, f"{out}/history")
    views = {
        "trend": deviations(history, window=14, limit=3.0, least=7),
        "weekday": deviations(history, window=4, limit=3.0, least=2, phase="weekday(CAST(run AS DATE))"),
    }
    rounded = [F.round(c, 6).alias(c) for c in ("expected", "spread", "score")]
    return union_all([d.select(F.lit(n).alias("view"), "metric", "instance", "run", "value", "earlier", *rounded, "status") for n, d in views.items()])


QUARANTINE_RULES = [
    X.expect_column_values_to_be_unique("o_custkey"),
    X.expect_column_values_to_be_in_set("o_orderstatus", ["O", "F"]),
    X.expect_column_values_to_be_between("o_totalprice", 1000, 400000),
    X.expect_column_values_to_not_be_null("o_orderpriority"),
    X.expect_column_value_lengths_to_be_between("o_orderpriority", 5, 8),
    RowRule("dated after 1993", "o_orderdate >= DATE'1993-01-01'"),
    RowRule("not a column", "no_such_column > 0"),
]


def quarantine_orders(spark, sf_dir):
    """Orders split by row-level rules into passed and quarantined rows, as written; rule counts as rows without a key."""
    split = quarantine(table(spark, sf_dir, "orders"), QUARANTINE_RULES, f"{_output(spark)}/orders")
    listed = F.concat_ws(",", F.col("failed_rules").cast("array<string>")).alias("rules")
    none = F.lit(None).cast("string")
    rows = split.quarantined.select("o_orderkey", F.lit("quarantined").alias("part"), listed, F.lit(1).cast("long").alias("n"))
    kept = split.passed.select("o_orderkey", F.lit("passed").alias("part"), none.alias("rules"), F.lit(1).cast("long").alias("n"))
    counts = split.counts.selectExpr("CAST(NULL AS BIGINT) AS o_orderkey", "rule AS part", "CAST(seq AS STRING) AS rules", "failed_rows AS n")
    return rows.unionByName(kept).unionByName(counts)


# ---- checks -----------------------------------------------------------------------------

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _verify_many(spark, sf_dir, plan: dict[str, list[Check]]):
    dfs = tables_of(spark, sf_dir, plan)
    tables = {n: (dfs[n], [a for c in checks for a in c.analyzers()]) for n, checks in plan.items()}
    return evaluate_checks(spark, compute_metrics(tables), plan)


def _constraint_view(v):
    return v.constraints.select("table_name", "constraint", "column", "status", "metric_value")


def check_has_size(spark, sf_dir):
    plan = {t: [Check(f"{t}_size").has_size("value >= 1000")] for t in TABLES}
    return _verify_many(spark, sf_dir, plan).constraints.select(
        "table_name", "check_name", "constraint", "status", "metric_value"
    )


def check_is_complete(spark, sf_dir):
    plan = {
        "events_nulled": [Check("events_complete").is_complete("value").is_complete("event_id")],
        "documents_labels": [Check("documents_labels_complete").is_complete("quality").is_complete("text")],
        "orders": [Check("orders_complete").is_complete("o_orderkey")],
    }
    return _constraint_view(_verify_many(spark, sf_dir, plan))


def check_is_unique(spark, sf_dir):
    plan = {
        "orders": [Check("orders_unique").is_unique("o_orderkey").is_unique("o_custkey")],
        "documents": [Check("documents_unique").is_unique("text").is_unique("doc_id")],
        "part": [Check("part_unique").is_unique("p_name")],
        "pages": [Check("pages_unique").is_unique("url")],
        "benchmark": [Check("benchmark_unique").is_unique("text")],
        "customer": [Check("customer_unique").is_unique("c_name")],
    }
    return _constraint_view(_verify_many(spark, sf_dir, plan))


def check_contained_in(spark, sf_dir):
    plan = {
        "customer": [Check("customer_domain").is_contained_in("c_mktsegment", SEGMENTS)],
        "orders": [Check("orders_domain").is_contained_in("o_orderstatus", ["O", "F"])],
        "conversations": [Check("conversations_domain").is_contained_in("role", ["system", "user", "assistant"])],
        "lineitem": [Check("lineitem_domain").is_contained_in("l_returnflag", ["A", "N", "R"])],
        "events_nulled": [Check("events_domain").is_contained_in("value", [1.0, 2.0])],
    }
    return _constraint_view(_verify_many(spark, sf_dir, plan))


def check_isolation(spark, sf_dir):
    """Rules that cannot be computed fail alone, with a message; the good rule beside them keeps its value."""
    plan = {
        "customer": [
            Check("customer_mixed")
            .satisfies("no_such_column > 0", "missing column")
            .satisfies("1 / (c_custkey - c_custkey) > 0", "division by zero")
            .is_complete("no_such_column")
            .is_complete("c_name")
        ]
    }
    dfs = tables_of(spark, sf_dir, plan)
    analyzers = [a for c in plan["customer"] for a in c.analyzers()] + [Minimum("c_name")]
    metrics = compute_metrics({"customer": (dfs["customer"], analyzers)})
    # error classes only: the texts behind them belong to the engine
    brief = F.expr("CASE WHEN {m} LIKE '[%' THEN regexp_extract({m}, '^.([A-Z_]+)', 1) ELSE coalesce({m}, '') END".format(m="message"))
    constraints = evaluate_checks(spark, metrics, plan).constraints.select(
        "table_name", F.col("constraint").alias("rule"), "status", brief.alias("message")
    )
    minimum = metrics.where("metric = 'Minimum'").select(
        "table_name", F.col("analyzer").alias("rule"), "status", brief.alias("message")
    )
    suite = [
        X.expect_column_values_to_be_between("c_name", 1, 3),
        X.expect_column_value_lengths_to_be_between("c_custkey", 1, 3),
        X.expect_column_values_to_be_in_set("no_such_column", [1]),
        X.expect_column_values_to_be_unique("c_custkey"),
    ]
    results = X.validate(dfs["customer"], suite, "customer").select(
        "table_name", F.col("expectation_type").alias("rule"), F.expr("if(success, 'Success', 'Failure')").alias("status"), F.lit("").alias("message")
    )
    return constraints.unionByName(minimum).unionByName(results)


def check_satisfies(spark, sf_dir):
    plan = {
        "customer": [
            Check("customer_rules")
            .satisfies("c_acctbal >= 0", "balance not negative")
            .satisfies("c_name rlike '^Customer#[0-9]{9}$'", "name")
            .satisfies("c_name rlike '^Customer#0{6}[0-9]{3}$'", "name")
        ],
        "lineitem": [
            Check("lineitem_rules")
            .satisfies("l_quantity > 0", "quantity positive")
            .satisfies("l_discount <= l_tax + 0.05", "discount bounded by tax")
        ],
        "orders": [Check("orders_rules").satisfies("o_totalprice > 0", "price positive")],
        "events_nulled": [Check("events_rules").satisfies("value >= 0", "value not negative")],
    }
    return _constraint_view(_verify_many(spark, sf_dir, plan))


def _rollup_plan():
    return {
        "orders": [
            Check("orders_keys").has_size().is_complete("o_orderkey").is_unique("o_orderkey"),
            Check("orders_status", level="Warning").is_contained_in("o_orderstatus", ["O", "F"]),
        ],
        "customer": [
            Check("customer_keys").is_unique("c_custkey"),
            Check("customer_balance", level="Warning").satisfies("c_acctbal >= 0", "balance not negative"),
        ],
        "lineitem": [Check("lineitem_keys").is_complete("l_orderkey"), Check("lineitem_qty").satisfies("l_quantity <= 50", "qty")],
        "events_nulled": [
            Check("events_values", level="Warning").has_completeness("value", "value >= 0.75"),
            Check("events_strict").is_complete("value"),
        ],
        "region": [Check("region_keys").is_unique("r_regionkey").is_unique("r_name")],
    }


def check_status_rollup(spark, sf_dir):
    v = _verify_many(spark, sf_dir, _rollup_plan())
    return v.checks.join(v.status, "table_name").select("table_name", "check_name", "status", "overall_status")


def check_default(spark, sf_dir):
    """The table-name registry on the given tables: none is registered, so each gets the default check."""
    plan = {t: checks_for(t) for t in TABLES}
    v = _verify_many(spark, sf_dir, plan)
    return v.constraints.join(v.status, "table_name").select(
        "table_name", "check_name", "constraint", "status", "overall_status"
    )


# ---- expectations --------------------------------------------------------------------------


def _validate_many(spark, sf_dir, plan: dict[str, list[X.Expectation]], sample_size=X.SAMPLE_SIZE):
    """Each table's results, materialized side by side.

    All tables' rule metrics are computed first (one batch of bounded plans), so that a bad rule
    fails alone and only rules with unexpected values are sampled.
    """
    tables = tables_of(spark, sf_dir, plan)
    metrics = compute_metrics({n: (tables[n], X.rule_analyzers(rules)) for n, rules in plan.items()})
    builders = [
        (lambda n=n, rules=rules: X.validate(
            tables[n], rules, n, f"{n}_suite", sample_size, metrics=metrics.where(F.col("table_name") == n)
        ))
        for n, rules in plan.items()
    ]
    return materialized_union(builders)  # each table's plan is built and run in a worker thread


def _counts_view(res):
    return res.select(
        "table_name",
        "seq",
        "column",
        "success",
        "element_count",
        "missing_count",
        "unexpected_count",
        F.round("unexpected_percent", 6).alias("unexpected_percent"),
    )


def expect_unique(spark, sf_dir):
    plan = {
        "orders": [X.expect_column_values_to_be_unique("o_orderkey"), X.expect_column_values_to_be_unique("o_custkey")],
        "documents": [X.expect_column_values_to_be_unique("text")],
        "part": [X.expect_column_values_to_be_unique("p_type", mostly=0.001)],
        "pages": [X.expect_column_values_to_be_unique("url")],
        "documents_labels": [X.expect_column_values_to_be_unique("quality")],
    }
    return _counts_view(_validate_many(spark, sf_dir, plan, 0))


def expect_not_null(spark, sf_dir):
    plan = {
        "events_nulled": [X.expect_column_values_to_not_be_null("value"), X.expect_column_values_to_not_be_null("ts")],
        "orders": [X.expect_column_values_to_not_be_null("o_custkey")],
        "documents_labels": [X.expect_column_values_to_not_be_null("quality")],
    }
    return _counts_view(_validate_many(spark, sf_dir, plan, 0))


def expect_not_null_mostly(spark, sf_dir):
    plan = {
        "events_nulled": [
            X.expect_column_values_to_not_be_null("value", mostly=0.75),
            X.expect_column_values_to_not_be_null("value", mostly=0.85),
        ],
        "documents_labels": [
            X.expect_column_values_to_not_be_null("quality", mostly=0.3),
            X.expect_column_values_to_not_be_null("toxic", mostly=0.5),
        ],
    }
    return _counts_view(_validate_many(spark, sf_dir, plan, 0))


def expect_in_set(spark, sf_dir):
    plan = {
        "orders": [
            X.expect_column_values_to_be_in_set("o_orderstatus", ["O", "F"]),
            X.expect_column_values_to_be_in_set("o_orderstatus", ["O", None]),
        ],
        "part": [X.expect_column_values_to_be_in_set("p_name", [])],
        "events_nulled": [X.expect_column_values_to_be_in_set("value", [None])],
        "conversations": [X.expect_column_values_to_be_in_set("role", ["system", "user", "assistant"])],
        "customer": [X.expect_column_values_to_be_in_set("c_mktsegment", SEGMENTS[:3], mostly=0.5)],
        "lineitem": [X.expect_column_values_to_be_in_set("l_linestatus", ["O"])],
        "documents_labels": [X.expect_column_values_to_be_in_set("quality", [1])],
    }
    return _counts_view(_validate_many(spark, sf_dir, plan, 0))


def expect_between(spark, sf_dir):
    plan = {
        "lineitem": [
            X.expect_column_values_to_be_between("l_quantity", 1, 50),
            X.expect_column_values_to_be_between("l_discount", 0, 0.05),
        ],
        "orders": [X.expect_column_values_to_be_between("o_totalprice", None, 400000)],
        "customer": [X.expect_column_values_to_be_between("c_acctbal", 0, None, mostly=0.9)],
        "part": [X.expect_column_values_to_be_between("p_size", 1, 40)],
        "events_nulled": [X.expect_column_values_to_be_between("value", 100, 400)],
    }
    return _counts_view(_validate_many(spark, sf_dir, plan, 0))


def expect_length_between(spark, sf_dir):
    plan = {
        "part": [X.expect_column_value_lengths_to_be_between("p_name", 8, 11)],
        "customer": [X.expect_column_value_lengths_to_be_between("c_name", None, 18)],
        "conversations": [X.expect_column_value_lengths_to_be_between("text", 30, 1500)],
        "documents": [X.expect_column_value_lengths_to_be_between("text", 100, None)],
        "pages": [X.expect_column_value_lengths_to_be_between("url", 40, 50)],
    }
    return _counts_view(_validate_many(spark, sf_dir, plan, 0))


def expect_row_count_between(spark, sf_dir):
    plan = {t: [X.expect_table_row_count_to_be_between(100, 20000)] for t in TABLES}
    res = _validate_many(spark, sf_dir, plan, 0)
    return res.select("table_name", "success", "observed_value")


def expect_columns_ordered(spark, sf_dir):
    plan = {
        "region": [X.expect_table_columns_to_match_ordered_list(["r_regionkey", "r_name"])],
        "nation": [X.expect_table_columns_to_match_ordered_list(["n_regionkey", "n_name", "n_nationkey"])],
        "orders": [
            X.expect_table_columns_to_match_ordered_list(
                ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
            )
        ],
        "labels": [X.expect_table_columns_to_match_ordered_list(["doc_id", "quality"])],
    }
    res = _validate_many(spark, sf_dir, plan, 0)
    return res.select("table_name", "success", "observed_value")


def expect_unexpected_sample(spark, sf_dir):
    plan = {
        "orders": [
            X.expect_column_values_to_be_in_set("o_orderstatus", ["O", "F"]),
            X.expect_column_values_to_be_unique("o_custkey"),
        ],
        "lineitem": [
            X.expect_column_values_to_be_in_set("l_returnflag", ["A", "N"]),
            X.expect_column_values_to_be_between("l_linenumber", 2, 6),
        ],
        "part": [X.expect_column_value_lengths_to_be_between("p_name", 8, 11)],
        "conversations": [X.expect_column_values_to_be_unique("conv_id")],
        "events_nulled": [X.expect_column_values_to_not_be_null("value")],
    }
    res = _validate_many(spark, sf_dir, plan)
    return res.select(
        "table_name",
        "seq",
        "expectation_type",
        "unexpected_count",
        F.size("partial_unexpected_list").alias("sample_size"),
        F.array_join("partial_unexpected_list", "|", "null").alias("sample"),
    )


# ---- suite generation ---------------------------------------------------------------------


def _rules(spark, sf_dir, names, kinds=None):
    """Generated rules; with ``kinds``, from the metrics that those rules need only."""
    tables = tables_of(spark, sf_dir, names)
    if kinds is None:
        metrics = profile_tables(tables)
    else:
        metrics = compute_metrics({n: (df, rule_metrics(df.schema, kinds)) for n, df in tables.items()})
    return generate_rules(metrics, {n: df.columns for n, df in tables.items()})


def generate_row_count(spark, sf_dir):
    r = _rules(spark, sf_dir, TABLES, [X.TABLE_ROWS]).where(F.col("expectation_type") == X.TABLE_ROWS)
    return r.select("table_name", "min_value", "max_value")


def generate_completeness_bands(spark, sf_dir):
    r = _rules(spark, sf_dir, ["events_nulled", "documents_labels", "orders"], [X.NOT_NULL])
    return r.where(F.col("expectation_type") == X.NOT_NULL).select("table_name", "column", "mostly")


def generate_uniqueness(spark, sf_dir):
    r = _rules(spark, sf_dir, ["orders", "part", "documents", "pages", "benchmark", "customer"], [X.UNIQUE])
    return r.where(F.col("expectation_type") == X.UNIQUE).select("table_name", "column")


def generate_ranges(spark, sf_dir):
    r = _rules(spark, sf_dir, ["lineitem", "orders", "customer"], [X.BETWEEN])
    return r.where(F.col("expectation_type") == X.BETWEEN).select("table_name", "column", "min_value", "max_value")


def generate_min_length(spark, sf_dir):
    r = _rules(spark, sf_dir, ["documents", "customer", "part", "conversations"], [X.LENGTHS])
    return r.where(F.col("expectation_type") == X.LENGTHS).select("table_name", "column", "min_value")


def generate_suite(spark, sf_dir):
    r = _rules(spark, sf_dir, ["orders", "events_nulled"])
    return r.select(
        "table_name",
        "seq",
        "expectation_type",
        "column",
        "min_value",
        "max_value",
        "mostly",
        F.to_json("column_list").alias("column_list"),
    )


# ---- metrics -> generated suite -> validation ------------------------------------------------

COMBINED_TABLES = ["orders", "customer", "part", "events_nulled", "documents"]


def _combined(spark, sf_dir):
    results = map_tables(lambda n: generate_and_validate(table(spark, sf_dir, n), n)[1], COMBINED_TABLES)
    return union_all(results)


def combined_validation(spark, sf_dir):
    return _combined(spark, sf_dir).select(
        "table_name", "seq", "expectation_type", "column", "success", "element_count", "missing_count", "unexpected_count"
    )


def combined_summary(spark, sf_dir):
    return summary(_combined(spark, sf_dir))


# ---- directory flows over the given folder --------------------------------------------------

FLOW_CHECKS = {
    "orders": [
        Check("orders_keys").has_size().is_complete("o_orderkey").is_unique("o_orderkey"),
        Check("orders_status", level="Warning").is_contained_in("o_orderstatus", ["O", "F"]),
    ],
    "customer": [Check("customer_rules").satisfies("c_acctbal >= 0", "balance not negative")],
}
FLOW_SUITES = {
    "orders": [
        X.expect_table_columns_to_match_ordered_list(["o_orderkey"]),
    ],
    "customer": [
        X.expect_column_values_to_be_unique("c_custkey"),
        X.expect_column_values_to_be_between("c_acctbal", 0, None),
    ],
}


def _output(spark) -> str:
    """A new folder under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/flows/{uuid.uuid4().hex}"


def flow_checks(spark, sf_dir):
    """Profile and check every table of the folder; the check documents, read back."""
    out = _output(spark)
    profile_and_check(spark, sf_dir, out, FLOW_CHECKS, suffix=".parquet", max_parallel=8)
    doc = spark.read.json(f"{out}/{R.REPORTS}/{R.CHECKS}")
    rows = doc.select("table_name", "overall_status", F.explode("check_results").alias("k"))
    rows = rows.select("table_name", "overall_status", "k.check_name", F.col("k.status").alias("check_status"), F.explode("k.constraints").alias("c"))
    return rows.select("table_name", "overall_status", "check_name", "check_status", "c.constraint", "c.status", "c.message")


def flow_suites(spark, sf_dir):
    """Validate the folder against a registry of two suites (other tables are skipped); the documents, read back."""
    out = _output(spark)
    validate_static(spark, sf_dir, out, FLOW_SUITES, suffix=".parquet", max_parallel=8)
    doc = spark.read.json(f"{out}/{R.REPORTS}/{R.EXPECTATIONS}")
    return doc.select(
        "table_name",
        F.col("data_shape.rows").alias("rows"),
        F.col("data_shape.columns").alias("columns"),
        "validation_success",
        F.size("results").cast("long").alias("rules"),
    )


def flow_generated(spark, sf_dir):
    """Metrics to files, suites from the files, validation; the summary document, read back."""
    out = _output(spark)
    profile_and_check(spark, sf_dir, out, {}, suffix=".parquet", max_parallel=8)
    validate_generated(spark, sf_dir, out, suffix=".parquet", max_parallel=8)
    doc = spark.read.json(f"{out}/{R.SUMMARY}")
    rows = doc.select("total_tables_processed", F.explode("table_results").alias("t"))
    return rows.select("total_tables_processed", "t.*")


def flow_combined_document(spark, sf_dir):
    """The combined documents of the folder (shape, outcome and every rule's result), as written, read back."""
    out = _output(spark)
    with Staging(spark) as staging:
        profile_and_check(spark, sf_dir, out, {}, suffix=".parquet", max_parallel=8, staging=staging)
        validate_generated(spark, sf_dir, out, suffix=".parquet", max_parallel=8, staging=staging)
    doc = spark.read.json(f"{out}/{R.REPORTS}/{R.COMBINED}")
    rows = doc.select("table_name", "pipeline_type", "expectations_from_metrics", "data_shape.*", "validation_success", F.posexplode("results").alias("seq", "r"))
    return rows.select(
        "table_name", "pipeline_type", "expectations_from_metrics", "rows", "columns", "validation_success", "seq",
        "r.expectation_type", "r.column", "r.success", "r.element_count", "r.unexpected_count",
    ).withColumnsRenamed({"columns": "n_columns", "rows": "n_rows"})


def io_csv_scan(spark, sf_dir):
    """Orders written as CSV with broken lines and wrong cells added, read back in one parse with inferred types."""
    orders = table(spark, sf_dir, "orders")
    folder = f"{_output(spark)}/orders.csv"
    orders.write.option("header", "true").csv(folder)
    short = orders.where("o_orderkey % 500 = 0").selectExpr("concat(o_orderkey, ',cut off') AS value")
    wrong = orders.where("o_orderkey % 700 = 1").selectExpr("concat(o_orderkey, ',', o_custkey, ',O,n/a,1995-05-05T00:00:00.000Z,1-URGENT') AS value")
    header = spark.createDataFrame([(",".join(orders.columns),)], "value string")
    for part in (short, wrong):  # every file begins with the header, as the written ones do
        header.coalesce(1).union(part).coalesce(1).write.mode("append").text(folder)
    read = read_csv_typed(spark, folder, max_bad_share=0.05, name="orders")
    types = spark.createDataFrame([(c, read.types[c], read.bad[c]) for c in orders.columns], "column string, type string, n_bad long")
    kept = run_analyzers(read.table, [Completeness(c) for c in orders.columns] + [Size()])
    counts = kept.where("metric = 'Completeness'").select(F.col("instance").alias("column"), "value")
    total = kept.where("metric = 'Size'").select(F.lit("lines").alias("column"), F.lit("malformed").alias("type"), F.lit(read.malformed_lines).cast("long").alias("n_bad"), "value")
    return types.join(counts, "column").unionByName(total).select("column", "type", "n_bad", F.round("value", 9).alias("value"))


def discover_domains_query(spark, sf_dir):
    """Value sets of orders, events and the columns of conversations, documents and customer with few values."""
    tables = {"orders": None, "events": ["event_type", "user_id"], "conversations": ["role", "turn"], "documents": ["lang", "source", "text"], "customer": ["c_mktsegment", "c_nationkey"]}
    parts = map_tables(lambda n: discover_domains(table(spark, sf_dir, n), n, tables[n]), tables)
    return union_all(parts).where("column <> 'o_totalprice'").select(
        "table_name", "column", "rank", "value", "n", F.round("share", 9).alias("share"), F.round("coverage", 9).alias("coverage"), "values", "proposed", "mostly"
    )


def generate_bad_metric(spark, sf_dir):
    """A metric without a value yields no rule; the other rules of its table are still derived."""
    df = table(spark, sf_dir, "customer")
    lost = (F.col("metric") == "MinLength") & (F.col("instance") == "c_name")
    metrics = profile_tables({"customer": df}).withColumn("value", F.when(~lost, F.col("value")))
    return generate_rules(metrics, {"customer": df.columns}).select("table_name", "suite_name", "expectation_type", "column")


# ---- cross-tool agreement and threshold monitoring ---------------------------------------------


def rule_agreement_query(spark, sf_dir):
    checks = {
        "orders": [
            Check("orders_checks")
            .has_size()
            .is_complete("o_orderkey")
            .is_unique("o_orderkey")
            .is_contained_in("o_orderstatus", ["O", "F"])
        ],
        "customer": [
            Check("customer_checks").is_unique("c_name").satisfies("c_acctbal >= 0", "balance not negative")
        ],
        "events_nulled": [Check("events_checks").is_complete("value").is_complete("event_id")],
    }
    suites = {
        "orders": [
            X.expect_table_row_count_to_be_between(1, None),
            X.expect_column_values_to_not_be_null("o_orderkey"),
            X.expect_column_values_to_be_unique("o_orderkey"),
            X.expect_column_values_to_be_in_set("o_orderstatus", ["O", "F", "P"]),
        ],
        "customer": [
            X.expect_column_values_to_be_unique("c_name"),
            X.expect_column_values_to_be_between("c_acctbal", 0, None),
        ],
        "events_nulled": [
            X.expect_column_values_to_not_be_null("value", mostly=0.7),
            X.expect_column_values_to_not_be_null("event_id"),
        ],
    }
    v = _verify_many(spark, sf_dir, checks)
    e = _validate_many(spark, sf_dir, suites, 0)
    return rule_agreement(v.constraints, e)


def threshold_monitor_query(spark, sf_dir):
    limits = [
        ("events_nulled", "Completeness", "value", 0.9, None),
        ("events_nulled", "Size", "*", 1.0, None),
        ("events_nulled", "Maximum", "value", None, 400.0),
        ("orders", "Distinctness", "o_orderkey", 1.0, 1.0),
        ("orders", "Uniqueness", "o_orderstatus", 0.5, None),
        ("orders", "Mean", "o_totalprice", 100000.0, 300000.0),
        ("orders", "Minimum", "o_missing", 0.0, None),
    ]
    tables = {n: table(spark, sf_dir, n) for n in ["events_nulled", "orders"]}
    wanted = threshold_analyzers(limits, {n: df.schema for n, df in tables.items()})
    metrics = compute_metrics({n: (df, wanted[n]) for n, df in tables.items()})
    thresholds = spark.createDataFrame(
        limits, "table_name string, metric string, instance string, min_value double, max_value double"
    )
    return _round_stats(threshold_monitor(metrics, thresholds))


QUERIES: dict[str, Query] = {
    "profile_size": profile_size,
    "profile_completeness": profile_completeness,
    "profile_completeness_all": profile_completeness_all,
    "profile_distinctness": profile_distinctness,
    "profile_uniqueness": profile_uniqueness,
    "profile_numeric": profile_numeric,
    "profile_string_length": profile_string_length,
    "profile_table": profile_table,
    "profile_all_tables": profile_all_tables,
    "profile_text_hashed": profile_text_hashed,
    "profile_sampled": profile_sampled,
    "profile_value_sampled": profile_value_sampled,
    "profile_merged": profile_merged,
    "profile_sketched": profile_sketched,
    "metric_history": metric_history,
    "quarantine_orders": quarantine_orders,
    "check_has_size": check_has_size,
    "check_is_complete": check_is_complete,
    "check_is_unique": check_is_unique,
    "check_contained_in": check_contained_in,
    "check_satisfies": check_satisfies,
    "check_isolation": check_isolation,
    "check_status_rollup": check_status_rollup,
    "check_default": check_default,
    "expect_unique": expect_unique,
    "expect_not_null": expect_not_null,
    "expect_not_null_mostly": expect_not_null_mostly,
    "expect_in_set": expect_in_set,
    "expect_between": expect_between,
    "expect_length_between": expect_length_between,
    "expect_row_count_between": expect_row_count_between,
    "expect_columns_ordered": expect_columns_ordered,
    "expect_unexpected_sample": expect_unexpected_sample,
    "generate_row_count": generate_row_count,
    "generate_completeness_bands": generate_completeness_bands,
    "generate_uniqueness": generate_uniqueness,
    "generate_ranges": generate_ranges,
    "generate_min_length": generate_min_length,
    "generate_suite": generate_suite,
    "combined_validation": combined_validation,
    "combined_summary": combined_summary,
    "flow_checks": flow_checks,
    "flow_suites": flow_suites,
    "flow_generated": flow_generated,
    "flow_combined_document": flow_combined_document,
    "io_csv_scan": io_csv_scan,
    "discover_domains": discover_domains_query,
    "generate_bad_metric": generate_bad_metric,
    "rule_agreement": rule_agreement_query,
    "threshold_monitor": threshold_monitor_query,
}
