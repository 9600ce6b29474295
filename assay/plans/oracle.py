"""Independent SQL (DuckDB dialect) for every registered query with a SQL twin.

Written from the metric and rule definitions, not from the Spark code path:
each metric is a plain aggregate or a GROUP BY over the base tables. Table
column lists are declared here so the SQL does not depend on Spark.
"""

from __future__ import annotations

import json

NUM, STR, OTHER = "num", "str", "other"

SCHEMAS: dict[str, list[tuple[str, str]]] = {
    "region": [("r_regionkey", NUM), ("r_name", STR)],
    "nation": [("n_nationkey", NUM), ("n_name", STR), ("n_regionkey", NUM)],
    "customer": [
        ("c_custkey", NUM),
        ("c_name", STR),
        ("c_nationkey", NUM),
        ("c_acctbal", NUM),
        ("c_mktsegment", STR),
    ],
    "supplier": [("s_suppkey", NUM), ("s_name", STR), ("s_nationkey", NUM), ("s_acctbal", NUM)],
    "part": [
        ("p_partkey", NUM),
        ("p_name", STR),
        ("p_brand", STR),
        ("p_type", STR),
        ("p_size", NUM),
        ("p_retailprice", NUM),
    ],
    "orders": [
        ("o_orderkey", NUM),
        ("o_custkey", NUM),
        ("o_orderstatus", STR),
        ("o_totalprice", NUM),
        ("o_orderdate", OTHER),
        ("o_orderpriority", STR),
    ],
    "lineitem": [
        ("l_orderkey", NUM),
        ("l_partkey", NUM),
        ("l_suppkey", NUM),
        ("l_linenumber", NUM),
        ("l_quantity", NUM),
        ("l_extendedprice", NUM),
        ("l_discount", NUM),
        ("l_tax", NUM),
        ("l_returnflag", STR),
        ("l_linestatus", STR),
        ("l_shipdate", OTHER),
    ],
    "events": [
        ("event_id", NUM),
        ("ts", OTHER),
        ("user_id", NUM),
        ("event_type", STR),
        ("value", NUM),
        ("props", STR),
    ],
    "documents": [("doc_id", NUM), ("text", STR), ("lang", STR), ("source", STR), ("n_chars", NUM)],
    "embeddings": [("vec_id", NUM), ("embedding", OTHER), ("label", NUM)],
    "pages": [("page_id", NUM), ("url", STR), ("html", STR)],
    "benchmark": [("item_id", NUM), ("text", STR)],
    "labels": [("doc_id", NUM), ("quality", NUM), ("toxic", NUM)],
    "conversations": [("conv_id", NUM), ("turn", NUM), ("role", STR), ("text", STR)],
}
SCHEMAS["events_nulled"] = SCHEMAS["events"]
SCHEMAS["documents_labels"] = SCHEMAS["documents"] + [("quality", NUM), ("toxic", NUM)]

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

SOURCES = {
    "events_nulled": "(SELECT event_id, ts, user_id, event_type, "
    "CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value, props FROM events)",
    "documents_labels": "(SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic "
    "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)",
}


def src(t: str) -> str:
    return SOURCES.get(t, t)


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def ident(c: str) -> str:
    return '"' + c + '"'


def union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# ---- metric expressions over the base table ----------------------------------------------


def freq(t: str, c: str) -> str:
    """Frequency table of a column's non-null values."""
    return f"(SELECT {ident(c)} AS v, count(*) AS n FROM {src(t)} WHERE {ident(c)} IS NOT NULL GROUP BY 1)"


def metric_value(t: str, metric: str, c: str | None) -> str:
    """A scalar subquery with the metric's value (double, NULL when undefined)."""
    s = src(t)
    if metric == "Size":
        return f"(SELECT CAST(count(*) AS DOUBLE) FROM {s})"
    if metric == "Completeness" and c == "*":
        cols = SCHEMAS[t]
        total = " + ".join(f"count({ident(x)})" for x, _ in cols)
        return f"(SELECT CAST({total} AS DOUBLE) / NULLIF(count(*) * {len(cols)}, 0) FROM {s})"
    e = ident(c)
    if metric == "Completeness":
        return f"(SELECT CAST(count({e}) AS DOUBLE) / NULLIF(count(*), 0) FROM {s})"
    if metric == "Minimum":
        return f"(SELECT CAST(min({e}) AS DOUBLE) + CAST(0.0 AS DOUBLE) FROM {s})"
    if metric == "Maximum":
        return f"(SELECT CAST(max({e}) AS DOUBLE) + CAST(0.0 AS DOUBLE) FROM {s})"
    if metric == "Mean":
        return f"(SELECT round(avg(CAST({e} AS DOUBLE)), 6) FROM {s})"
    if metric == "StandardDeviation":
        return f"(SELECT round(stddev_pop(CAST({e} AS DOUBLE)), 6) FROM {s})"
    if metric == "MinLength":
        return f"(SELECT CAST(min(length({e})) AS DOUBLE) FROM {s})"
    if metric == "MaxLength":
        return f"(SELECT CAST(max(length({e})) AS DOUBLE) FROM {s})"
    if metric == "Distinctness":
        return f"(SELECT CAST(count(*) AS DOUBLE) / NULLIF(sum(n), 0) FROM {freq(t, c)})"
    if metric == "Uniqueness":
        return f"(SELECT CAST(count(*) FILTER (WHERE n = 1) AS DOUBLE) / NULLIF(sum(n), 0) FROM {freq(t, c)})"
    raise ValueError(metric)


def profile_list(t: str) -> list[tuple[str, str | None]]:
    """(metric, column) in profile order: table metrics, then per column by type."""
    out: list[tuple[str, str | None]] = [("Size", None), ("Completeness", "*")]
    for c, kind in SCHEMAS[t]:
        out += [("Completeness", c), ("Distinctness", c)]
        if kind == NUM:
            out += [("Minimum", c), ("Maximum", c), ("Mean", c), ("StandardDeviation", c)]
        elif kind == STR:
            out += [("MinLength", c), ("MaxLength", c), ("Uniqueness", c)]
    return out


def analyzer_name(metric: str, c: str | None) -> str:
    return f"{metric}({'' if c is None else c})"


def profile_rows(t: str) -> str:
    parts = []
    for seq, (metric, c) in enumerate(profile_list(t)):
        v = metric_value(t, metric, c)
        parts.append(
            f"SELECT {q(t)} AS table_name, {seq} AS seq, {q(c or '*')} AS instance, {q(metric)} AS metric, "
            f"{q(analyzer_name(metric, c))} AS analyzer, {v} AS value, "
            f"CASE WHEN {v} IS NULL THEN 'Failure' ELSE 'Success' END AS status"
        )
    return union(parts)


def metric_rows(pairs: list[tuple[str, str, str | None]], cols: str) -> str:
    """Rows (table_name, instance, metric, analyzer, value) for (table, metric, column) triples."""
    parts = []
    for t, metric, c in pairs:
        row = {
            "table_name": q(t),
            "instance": q(c or "*"),
            "metric": q(metric),
            "analyzer": q(analyzer_name(metric, c)),
            "value": metric_value(t, metric, c),
        }
        parts.append("SELECT " + ", ".join(f"{row[k]} AS {ident(k)}" for k in cols.split(",")))
    return union(parts)


def columns_of(t: str, kinds=(NUM, STR, OTHER)) -> list[str]:
    return [c for c, k in SCHEMAS[t] if k in kinds]


# ---- checks ---------------------------------------------------------------------------------


def constraint_row(t, check, constraint, column, value_sql, passed_sql, level="Error", check_seq=0):
    return {
        "table_name": q(t),
        "check_name": q(check),
        "check_seq": str(check_seq),
        "level": q(level),
        "constraint": q(constraint),
        "column": q(column) if column is not None else "CAST(NULL AS VARCHAR)",
        "metric_value": value_sql,
        "status": f"CASE WHEN coalesce({passed_sql}, false) THEN 'Success' ELSE 'Failure' END",
    }


def size_c(t, check, pred="value > 0", **kw):
    v = metric_value(t, "Size", None)
    return constraint_row(t, check, "SizeConstraint(Size())", None, v, pred.replace("value", v), **kw)


def complete_c(t, check, c, pred="value = 1.0", **kw):
    v = metric_value(t, "Completeness", c)
    return constraint_row(
        t, check, f"CompletenessConstraint(Completeness({c}))", c, v, pred.replace("value", v), **kw
    )


def unique_c(t, check, c, **kw):
    v = metric_value(t, "Uniqueness", c)
    return constraint_row(t, check, f"UniquenessConstraint(Uniqueness({c}))", c, v, f"{v} = 1.0", **kw)


def contained_c(t, check, c, values, **kw):
    label = f"{c} contained in {','.join(str(x) for x in values)}"
    lits = ", ".join(q(x) if isinstance(x, str) else repr(x) for x in values)
    v = (
        f"(SELECT CAST(count(*) FILTER (WHERE {ident(c)} IS NULL OR {ident(c)} IN ({lits})) AS DOUBLE) "
        f"/ NULLIF(count(*), 0) FROM {src(t)})"
    )
    return constraint_row(t, check, f"ComplianceConstraint(Compliance({label}))", c, v, f"{v} = 1.0", **kw)


def satisfies_c(t, check, pred, name, **kw):
    v = f"(SELECT CAST(count(*) FILTER (WHERE {pred}) AS DOUBLE) / NULLIF(count(*), 0) FROM {src(t)})"
    return constraint_row(t, check, f"ComplianceConstraint(Compliance({name}))", None, v, f"{v} = 1.0", **kw)


def rows_sql(rows: list[dict], cols: list[str]) -> str:
    return union(["SELECT " + ", ".join(f"{r[k]} AS {ident(k)}" for k in cols) for r in rows])


CONSTRAINT_COLS = ["table_name", "constraint", "column", "status", "metric_value"]


def rollup_sql(rows: list[dict]) -> tuple[str, str]:
    """(checks, status) SQL over constraint rows."""
    base = rows_sql(rows, ["table_name", "check_seq", "check_name", "level", "status"])
    checks = (
        f"SELECT table_name, check_seq, check_name, CASE WHEN bool_and(status = 'Success') THEN 'Success' "
        f"ELSE any_value(level) END AS status FROM ({base}) GROUP BY table_name, check_seq, check_name"
    )
    status = (
        f"SELECT table_name, CASE max(CASE status WHEN 'Error' THEN 2 WHEN 'Warning' THEN 1 ELSE 0 END) "
        f"WHEN 2 THEN 'Error' WHEN 1 THEN 'Warning' ELSE 'Success' END AS overall_status FROM ({checks}) "
        f"GROUP BY table_name"
    )
    return checks, status


# ---- expectations ---------------------------------------------------------------------------


def _bounds(x: str, lo, hi) -> str:
    cond = []
    if lo is not None:
        cond.append(f"{x} >= {lo!r}")
    if hi is not None:
        cond.append(f"{x} <= {hi!r}")
    return " AND ".join(cond) if cond else "true"


def expectation_counts(t: str, seq: int, kind: str, c: str, mostly=None, **p) -> str:
    """Result row (table_name, seq, column, success, element_count, missing_count,
    unexpected_count, unexpected_percent) of one column rule."""
    e = ident(c)
    if kind == "unique":
        unexpected = f"(SELECT CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) FROM {freq(t, c)})"
    elif kind == "not_null":
        unexpected = f"(SELECT count(*) FILTER (WHERE {e} IS NULL) FROM {src(t)})"
    elif kind == "in_set":
        lits = ", ".join(q(x) if isinstance(x, str) else repr(x) for x in p["values"] if x is not None)
        bad = f"NOT ({e} IN ({lits}))" if lits else "true"
        unexpected = f"(SELECT count(*) FILTER (WHERE {e} IS NOT NULL AND {bad}) FROM {src(t)})"
    elif kind == "between":
        unexpected = f"(SELECT count(*) FILTER (WHERE {e} IS NOT NULL AND NOT ({_bounds(e, p.get('lo'), p.get('hi'))})) FROM {src(t)})"
    elif kind == "lengths":
        x = f"length({e})"
        unexpected = f"(SELECT count(*) FILTER (WHERE {e} IS NOT NULL AND NOT ({_bounds(x, p.get('lo'), p.get('hi'))})) FROM {src(t)})"
    else:
        raise ValueError(kind)
    rows = f"(SELECT count(*) FROM {src(t)})"
    missing = f"(SELECT count(*) FILTER (WHERE {e} IS NULL) FROM {src(t)})"
    considered = rows if kind == "not_null" else f"({rows} - {missing})"
    m = 1.0 if mostly is None else float(mostly)
    return (
        f"SELECT {q(t)} AS table_name, {seq} AS seq, {q(c)} AS \"column\", "
        f"({considered} = 0 OR CAST({considered} - {unexpected} AS DOUBLE) / {considered} >= {m!r}) AS success, "
        f"{rows} AS element_count, {missing} AS missing_count, {unexpected} AS unexpected_count, "
        f"round(100.0 * {unexpected} / NULLIF({considered}, 0), 6) AS unexpected_percent"
    )


def unexpected_sample(t: str, seq: int, etype: str, kind: str, c: str, numeric: bool, **p) -> str:
    """(table_name, seq, expectation_type, unexpected_count, sample_size, sample) of one rule."""
    e = ident(c)
    key = f"CAST({e} AS DOUBLE)" if numeric else f"CAST({e} AS VARCHAR)"
    if kind == "not_null":
        cnt = f"(SELECT count(*) FILTER (WHERE {e} IS NULL) FROM {src(t)})"
        k = f"least({cnt}, 20)"
        return (
            f"SELECT {q(t)} AS table_name, {seq} AS seq, {q(etype)} AS expectation_type, {cnt} AS unexpected_count, "
            f"CAST({k} AS INTEGER) AS sample_size, rtrim(repeat('null|', CAST({k} AS INTEGER)), '|') AS sample"
        )
    if kind == "unique":
        cnt = f"(SELECT CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) FROM {freq(t, c)})"
        ordered = (
            f"SELECT CAST(v AS VARCHAR) AS s, {key.replace(e, 'v')} AS k, unnest(range(least(n, 20))) AS r "
            f"FROM (SELECT v, n FROM {freq(t, c)} WHERE n > 1 ORDER BY {key.replace(e, 'v')} LIMIT 20)"
        )
    else:
        if kind == "in_set":
            lits = ", ".join(q(x) if isinstance(x, str) else repr(x) for x in p["values"])
            bad = f"NOT ({e} IN ({lits}))"
        elif kind == "between":
            bad = f"NOT ({_bounds(e, p.get('lo'), p.get('hi'))})"
        else:
            bad = f"NOT ({_bounds(f'length({e})', p.get('lo'), p.get('hi'))})"
        cnt = f"(SELECT count(*) FILTER (WHERE {e} IS NOT NULL AND {bad}) FROM {src(t)})"
        ordered = f"SELECT CAST({e} AS VARCHAR) AS s, {key} AS k, 0 AS r FROM {src(t)} WHERE {e} IS NOT NULL AND {bad}"
    top = f"(SELECT s, k FROM ({ordered}) ORDER BY k LIMIT 20)"
    return (
        f"SELECT {q(t)} AS table_name, {seq} AS seq, {q(etype)} AS expectation_type, {cnt} AS unexpected_count, "
        f"CAST((SELECT count(*) FROM {top}) AS INTEGER) AS sample_size, "
        f"coalesce((SELECT string_agg(s, '|' ORDER BY k) FROM {top}), '') AS sample"
    )


# ---- suite generation -------------------------------------------------------------------------


def generated_rules(t: str) -> str:
    """All generated rules of a table: (table_name, seq, expectation_type, column, min_value,
    max_value, mostly, column_list), numbered after dropping rules whose condition fails."""
    cand = []  # (grp, ord, etype, column, lo, hi, mostly, column_list, keep)
    plist = profile_list(t)
    null = "CAST(NULL AS DOUBLE)"
    for seq, (metric, c) in enumerate(plist):
        v = metric_value(t, metric, c)
        if metric == "Size":
            n = f"CAST({v} AS BIGINT)"
            lo = f"CAST(greatest(0, floor({n} * CAST(0.9 AS DOUBLE))) AS DOUBLE)"
            hi = f"CAST(floor({n} * CAST(1.1 AS DOUBLE)) AS DOUBLE)"
            cand.append((0, seq, "expect_table_row_count_to_be_between", None, lo, hi, null, None, f"{v} IS NOT NULL"))
        elif metric == "Completeness" and c != "*":
            mostly = f"CASE WHEN {v} < 0.95 THEN {v} * CAST(0.9 AS DOUBLE) END"
            cand.append((0, seq, "expect_column_values_to_not_be_null", c, null, null, mostly, None, f"{v} >= 0.5"))
        elif metric == "Uniqueness":
            cand.append((0, seq, "expect_column_values_to_be_unique", c, null, null, null, None, f"{v} >= 0.99"))
        elif metric == "MinLength":
            cand.append((0, seq, "expect_column_value_lengths_to_be_between", c, v, null, null, None, f"{v} > 0"))
    for seq, (metric, c) in enumerate(plist):
        if metric == "Minimum":
            lo, hi = metric_value(t, "Minimum", c), metric_value(t, "Maximum", c)
            cand.append(
                (1, seq, "expect_column_values_to_be_between", c, lo, hi, null, None, f"{lo} IS NOT NULL AND {hi} IS NOT NULL")
            )
    cols = json.dumps([c for c, _ in SCHEMAS[t]], separators=(",", ":"))
    cand.append((2, 0, "expect_table_columns_to_match_ordered_list", None, null, null, null, cols, "true"))
    parts = [
        f"SELECT {q(t)} AS table_name, {g} AS grp, {o} AS ord, {q(et)} AS expectation_type, "
        f"{q(c) if c else 'CAST(NULL AS VARCHAR)'} AS \"column\", CAST({lo} AS DOUBLE) AS min_value, "
        f"CAST({hi} AS DOUBLE) AS max_value, CAST({m} AS DOUBLE) AS mostly, "
        f"{q(cl) if cl else 'CAST(NULL AS VARCHAR)'} AS column_list WHERE {keep}"
        for g, o, et, c, lo, hi, m, cl, keep in cand
    ]
    return (
        "SELECT table_name, CAST(row_number() OVER (PARTITION BY table_name ORDER BY grp, ord) - 1 AS INTEGER) AS seq, "
        f"expectation_type, \"column\", min_value, max_value, mostly, column_list FROM ({union(parts)})"
    )


def generated_results(t: str) -> str:
    """Validation of a table's generated rules on the same table: (table_name, seq,
    expectation_type, column, success, element_count, missing_count, unexpected_count)."""
    rules = generated_rules(t)
    s = src(t)
    pieces = []
    for c, kind in SCHEMAS[t]:
        e = ident(c)
        if kind == NUM:
            lo, hi = metric_value(t, "Minimum", c), metric_value(t, "Maximum", c)
            outside = f"count(*) FILTER (WHERE {e} IS NOT NULL AND NOT ({e} BETWEEN {lo} AND {hi}))"
        else:
            outside = "CAST(0 AS BIGINT)"
        if kind == STR:
            short = f"count(*) FILTER (WHERE {e} IS NOT NULL AND length({e}) < (SELECT min(length({e})) FROM {s}))"
        else:
            short = "CAST(0 AS BIGINT)"
        pieces.append(
            f"SELECT {q(c)} AS \"column\", count(*) AS element_count, count(*) FILTER (WHERE {e} IS NULL) AS missing_count, "
            f"(SELECT CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) FROM {freq(t, c)}) AS dups, "
            f"{outside} AS outside, {short} AS short FROM {s}"
        )
    stats = union(pieces)
    rows = f"(SELECT count(*) FROM {s})"
    return f"""
WITH r AS ({rules}),
st AS ({stats}),
u AS (
  SELECT r.*, st.element_count, st.missing_count,
    CASE r.expectation_type
      WHEN 'expect_column_values_to_not_be_null' THEN st.missing_count
      WHEN 'expect_column_values_to_be_unique' THEN st.dups
      WHEN 'expect_column_values_to_be_between' THEN st.outside
      WHEN 'expect_column_value_lengths_to_be_between' THEN st.short
    END AS unexpected_count,
    CASE WHEN r.expectation_type = 'expect_column_values_to_not_be_null' THEN st.element_count
         ELSE st.element_count - st.missing_count END AS considered
  FROM r LEFT JOIN st ON r."column" = st."column"
)
SELECT table_name, seq, expectation_type, "column",
  CASE expectation_type
    WHEN 'expect_table_row_count_to_be_between' THEN {rows} BETWEEN min_value AND max_value
    WHEN 'expect_table_columns_to_match_ordered_list' THEN true
    ELSE considered = 0 OR CAST(considered - unexpected_count AS DOUBLE) / considered >= coalesce(mostly, 1.0)
  END AS success,
  element_count, missing_count, unexpected_count
FROM u"""


# ---- one SQL statement per registered query ---------------------------------------------------

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _profile_size():
    return metric_rows([(t, "Size", None) for t in TABLES], "table_name,analyzer,value")


def _profile_completeness():
    pairs = [(t, "Completeness", c) for t in ("events_nulled", "documents_labels") for c in columns_of(t)]
    return metric_rows(pairs, "table_name,instance,value")


def _profile_completeness_all():
    return metric_rows(
        [(t, "Completeness", "*") for t in ("events_nulled", "documents_labels", "orders")], "table_name,value"
    )


def _profile_distinctness():
    pairs = [(t, "Distinctness", c) for t in ("orders", "part", "documents", "embeddings") for c in columns_of(t)]
    return metric_rows(pairs, "table_name,instance,value")


def _profile_uniqueness():
    pairs = [(t, "Uniqueness", c) for t in ("orders", "part", "documents", "pages") for c in columns_of(t)]
    return metric_rows(pairs, "table_name,instance,value")


def _profile_text_hashed():
    cols = {
        "documents": ["text", "lang", "source"],
        "pages": ["url", "html"],
        "conversations": ["role", "text"],
        "benchmark": ["text"],
    }
    pairs = [(t, m, c) for t, cs in cols.items() for c in cs for m in ("Distinctness", "Uniqueness")]
    return metric_rows(pairs, "table_name,instance,metric,value")


def _profile_numeric():
    pairs = [
        (t, m, c)
        for t in ("lineitem", "customer")
        for c in columns_of(t, (NUM,))
        for m in ("Minimum", "Maximum", "Mean", "StandardDeviation")
    ]
    return metric_rows(pairs, "table_name,instance,metric,value")


def _profile_string_length():
    pairs = [
        (t, m, c)
        for t in ("documents", "customer", "pages", "conversations")
        for c in columns_of(t, (STR,))
        for m in ("MinLength", "MaxLength")
    ]
    return metric_rows(pairs, "table_name,instance,metric,value")


def _check_has_size():
    rows = [size_c(t, f"{t}_size", "value >= 1000") for t in TABLES]
    return rows_sql(rows, ["table_name", "check_name", "constraint", "status", "metric_value"])


def _check_is_complete():
    rows = [
        complete_c("events_nulled", "events_complete", "value"),
        complete_c("events_nulled", "events_complete", "event_id"),
        complete_c("documents_labels", "documents_labels_complete", "quality"),
        complete_c("documents_labels", "documents_labels_complete", "text"),
        complete_c("orders", "orders_complete", "o_orderkey"),
    ]
    return rows_sql(rows, CONSTRAINT_COLS)


def _check_is_unique():
    rows = [
        unique_c("orders", "orders_unique", "o_orderkey"),
        unique_c("orders", "orders_unique", "o_custkey"),
        unique_c("documents", "documents_unique", "text"),
        unique_c("documents", "documents_unique", "doc_id"),
        unique_c("part", "part_unique", "p_name"),
        unique_c("pages", "pages_unique", "url"),
        unique_c("benchmark", "benchmark_unique", "text"),
        unique_c("customer", "customer_unique", "c_name"),
    ]
    return rows_sql(rows, CONSTRAINT_COLS)


def _check_contained_in():
    rows = [
        contained_c("customer", "customer_domain", "c_mktsegment", SEGMENTS),
        contained_c("orders", "orders_domain", "o_orderstatus", ["O", "F"]),
        contained_c("conversations", "conversations_domain", "role", ["system", "user", "assistant"]),
        contained_c("lineitem", "lineitem_domain", "l_returnflag", ["A", "N", "R"]),
        contained_c("events_nulled", "events_domain", "value", [1.0, 2.0]),
    ]
    return rows_sql(rows, CONSTRAINT_COLS)


def _check_satisfies():
    rows = [
        satisfies_c("customer", "customer_rules", "c_acctbal >= 0", "balance not negative"),
        satisfies_c("customer", "customer_rules", "regexp_matches(c_name, '^Customer#[0-9]{9}$')", "name"),
        satisfies_c("customer", "customer_rules", "regexp_matches(c_name, '^Customer#0{6}[0-9]{3}$')", "name"),
        satisfies_c("lineitem", "lineitem_rules", "l_quantity > 0", "quantity positive"),
        satisfies_c("lineitem", "lineitem_rules", "l_discount <= l_tax + 0.05", "discount bounded by tax"),
        satisfies_c("orders", "orders_rules", "o_totalprice > 0", "price positive"),
        satisfies_c("events_nulled", "events_rules", "value >= 0", "value not negative"),
    ]
    return rows_sql(rows, CONSTRAINT_COLS)


def _check_isolation():
    fixed = [
        ("ComplianceConstraint(Compliance(missing column))", "UNRESOLVED_COLUMN"),
        ("ComplianceConstraint(Compliance(division by zero))", "DIVIDE_BY_ZERO"),
        ("CompletenessConstraint(Completeness(no_such_column))", "Input data does not include column no_such_column!"),
        ("Minimum(c_name)", "Expected type of column c_name to be NumericType, but found string"),
    ]
    parts = [
        f"SELECT 'customer' AS table_name, {q(rule)} AS \"rule\", 'Failure' AS status, {q(message)} AS message"
        for rule, message in fixed
    ]
    complete = metric_value("customer", "Completeness", "c_name")
    parts.append(
        "SELECT 'customer', 'CompletenessConstraint(Completeness(c_name))', "
        f"CASE WHEN {complete} = 1 THEN 'Success' ELSE 'Failure' END, "
        f"CASE WHEN {complete} = 1 THEN '' ELSE 'Value: ' || {complete} || ' does not meet the constraint requirement!' END"
    )
    for rule in ("values_to_be_between", "value_lengths_to_be_between", "values_to_be_in_set"):
        parts.append(f"SELECT 'customer', 'expect_column_{rule}', 'Failure', ''")
    unique = "SELECT count(*) FROM (SELECT c_custkey FROM customer WHERE c_custkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"
    parts.append(f"SELECT 'customer', 'expect_column_values_to_be_unique', CASE WHEN ({unique}) = 0 THEN 'Success' ELSE 'Failure' END, ''")
    return union(parts)


def _profile_sampled():
    kept = "substr(md5(CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR)), 1, 8) < '19999999'"
    SOURCES["lineitem_sample"] = f"(SELECT * FROM lineitem WHERE {kept})"
    SCHEMAS["lineitem_sample"] = SCHEMAS["lineitem"]
    return f"SELECT 'lineitem' AS table_name, instance, metric, value FROM ({profile_rows('lineitem_sample')})"


def _profile_merged():
    return union([profile_rows(t) for t in ("orders", "documents")])


def _profile_value_sampled():
    f, v = 0.2, 1.959964**2 * (1 - 0.2)
    below = f"{int(f * 2**32):08x}"
    SCHEMAS["orders_keys"] = [x for x in SCHEMAS["orders"] if x[0] in ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")]
    SOURCES["orders_keys"] = "(SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders)"
    parts = []
    for t, name in (("documents", "documents"), ("orders_keys", "orders")):
        for metric, c in profile_list(t):
            if metric in ("Mean", "StandardDeviation"):
                continue
            head = f"SELECT {q(name)} AS table_name, {q(c or '*')} AS instance, {q(metric)} AS metric"
            if metric not in ("Distinctness", "Uniqueness"):
                x = metric_value(t, metric, c)
                parts.append(f"{head}, 'DoubleMetric' AS metric_type, round({x}, 9) AS value, round({x}, 9) AS lower, round({x}, 9) AS upper")
                continue
            k = "count(*)" if metric == "Distinctness" else "count(*) FILTER (WHERE n = 1)"
            s = f"SELECT {ident(c)} AS v, count(*) AS n FROM {src(t)} WHERE {ident(c)} IS NOT NULL AND substr(sha256(CAST({ident(c)} AS VARCHAR)), 1, 8) < {q(below)} GROUP BY 1"
            base = f"(SELECT CAST({k} AS DOUBLE) AS k, (SELECT CAST(count({ident(c)}) AS DOUBLE) FROM {src(t)}) AS rows FROM ({s}))"
            root = f"sqrt({v!r} * k + {v!r} * {v!r} / 4)"
            parts.append(
                f"{head}, 'ValueSampledMetric' AS metric_type, round(least(1.0, k / {f!r} / rows), 9) AS value, "
                f"round(least(1.0, greatest(k / rows, (k + {v!r} / 2 - {root}) / {f!r} / rows)), 9) AS lower, "
                f"round(least(1.0, (k + {v!r} / 2 + {root}) / {f!r} / rows), 9) AS upper FROM {base}"
            )
    return union(parts)


def _profile_sketched():
    return union([
        f"SELECT {q(t)} AS table_name, {q(c)} AS instance, (SELECT CAST(count(DISTINCT {ident(c)}) AS DOUBLE) FROM {t}) AS exact, true AS within_error"
        for t in ("orders", "documents", "lineitem") for c in columns_of(t)
    ])


def _metric_history():
    e = SOURCES["events_nulled"]
    distinct = "CAST(count(DISTINCT user_id) AS DOUBLE) / NULLIF(count(user_id), 0)"
    day = f"""day AS (
  SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS run, CAST(count(*) AS DOUBLE) AS size, CAST(count(value) AS DOUBLE) / count(*) AS complete,
         min(value) AS lo, max(value) AS hi, round(avg(value), 6) AS mean, {distinct} AS users
  FROM {e} GROUP BY 1
), single AS (
  SELECT run, CAST(count(*) FILTER (WHERE n = 1) AS DOUBLE) / sum(n) AS u
  FROM (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS run, event_type, count(*) AS n FROM {e} GROUP BY 1, 2) GROUP BY run
), h AS (
  SELECT run, unnest([
    {{'metric': 'Size', 'instance': '*', 'value': size}}, {{'metric': 'Completeness', 'instance': 'value', 'value': complete}},
    {{'metric': 'Minimum', 'instance': 'value', 'value': lo}}, {{'metric': 'Maximum', 'instance': 'value', 'value': hi}},
    {{'metric': 'Mean', 'instance': 'value', 'value': mean}}, {{'metric': 'Distinctness', 'instance': 'user_id', 'value': users}},
    {{'metric': 'Uniqueness', 'instance': 'event_type', 'value': u}}], recursive := true)
  FROM day JOIN single USING (run)
)"""
    views = []
    for name, size, least, phase in (("trend", 14, 7, "0"), ("weekday", 4, 2, "isodow(CAST(run AS DATE))")):
        views.append(f"""
SELECT {q(name)} AS view, {least} AS least, metric, instance, run, value, past, list_aggregate(past, 'median') AS expected FROM (
  SELECT *, list(value) OVER (PARTITION BY metric, instance, {phase} ORDER BY run ROWS BETWEEN {size} PRECEDING AND 1 PRECEDING) AS past FROM h)""")
    return f"""
WITH {day}, p AS ({union(views)}),
s AS (
  SELECT *, greatest(1.4826 * list_aggregate(list_transform(past, lambda x: abs(x - expected)), 'median'), 0.001 * abs(expected)) AS spread FROM p
), z AS (
  SELECT *, CASE WHEN value = expected THEN 0.0 WHEN spread > 0 THEN abs(value - expected) / spread
            WHEN value IS NOT NULL AND expected IS NOT NULL THEN CAST('Infinity' AS DOUBLE) END AS score FROM s
)
SELECT view, metric, instance, run, value, CAST(coalesce(len(past), 0) AS INTEGER) AS earlier, round(expected, 6) AS expected,
       round(spread, 6) AS spread, round(score, 6) AS score,
       CASE WHEN value IS NULL THEN 'missing' WHEN coalesce(len(past), 0) < least THEN 'new' WHEN score > 3.0 THEN 'anomaly' ELSE 'ok' END AS status
FROM z"""


def _quarantine_orders():
    rules = [
        "o_custkey IN (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) > 1)",
        "o_orderstatus NOT IN ('O', 'F')",
        "NOT (o_totalprice >= 1000 AND o_totalprice <= 400000)",
        "o_orderpriority IS NULL",
        "NOT (length(o_orderpriority) >= 5 AND length(o_orderpriority) <= 8)",
        "NOT coalesce(o_orderdate >= DATE '1993-01-01', false)",
    ]
    names = [
        "expect_column_values_to_be_unique(o_custkey)", "expect_column_values_to_be_in_set(o_orderstatus)",
        "expect_column_values_to_be_between(o_totalprice)", "expect_column_values_to_not_be_null(o_orderpriority)",
        "expect_column_value_lengths_to_be_between(o_orderpriority)", "dated after 1993",
    ]
    flags = ", ".join(f"CASE WHEN {r} THEN '{i}' END" for i, r in enumerate(rules))
    counts = [
        f"SELECT CAST(NULL AS BIGINT) AS o_orderkey, {q(n)} AS part, '{i}' AS rules, (SELECT count(*) FROM orders WHERE {r}) AS n"
        for i, (n, r) in enumerate(zip(names, rules, strict=True))
    ]
    counts.append("SELECT CAST(NULL AS BIGINT) AS o_orderkey, 'not a column' AS part, '6' AS rules, CAST(NULL AS BIGINT) AS n")
    rows = f"SELECT o_orderkey, concat_ws(',', {flags}) AS r FROM orders"
    return union([
        f"SELECT o_orderkey, CASE WHEN r = '' THEN 'passed' ELSE 'quarantined' END AS part, NULLIF(r, '') AS rules, CAST(1 AS BIGINT) AS n FROM ({rows})",
        *counts,
    ])


def _rollup_rows():
    return [
        size_c("orders", "orders_keys"),
        complete_c("orders", "orders_keys", "o_orderkey"),
        unique_c("orders", "orders_keys", "o_orderkey"),
        contained_c("orders", "orders_status", "o_orderstatus", ["O", "F"], level="Warning", check_seq=1),
        unique_c("customer", "customer_keys", "c_custkey"),
        satisfies_c(
            "customer", "customer_balance", "c_acctbal >= 0", "balance not negative", level="Warning", check_seq=1
        ),
        complete_c("lineitem", "lineitem_keys", "l_orderkey"),
        satisfies_c("lineitem", "lineitem_qty", "l_quantity <= 50", "qty", check_seq=1),
        complete_c("events_nulled", "events_values", "value", "value >= 0.75", level="Warning"),
        complete_c("events_nulled", "events_strict", "value", check_seq=1),
        unique_c("region", "region_keys", "r_regionkey"),
        unique_c("region", "region_keys", "r_name"),
    ]


def _check_status_rollup():
    checks, status = rollup_sql(_rollup_rows())
    return (
        f"SELECT c.table_name, c.check_name, c.status, s.overall_status FROM ({checks}) c "
        f"JOIN ({status}) s ON c.table_name = s.table_name"
    )


def _check_default():
    rows = [size_c(t, "default_checks") for t in TABLES]
    cons = rows_sql(rows, ["table_name", "check_name", "check_seq", "level", "constraint", "status"])
    _, status = rollup_sql(rows)
    return (
        f"SELECT c.table_name, c.check_name, c.constraint, c.status, s.overall_status FROM ({cons}) c "
        f"JOIN ({status}) s ON c.table_name = s.table_name"
    )


def _expect_unique():
    return union(
        [
            expectation_counts("orders", 0, "unique", "o_orderkey"),
            expectation_counts("orders", 1, "unique", "o_custkey"),
            expectation_counts("documents", 0, "unique", "text"),
            expectation_counts("part", 0, "unique", "p_type", mostly=0.001),
            expectation_counts("pages", 0, "unique", "url"),
            expectation_counts("documents_labels", 0, "unique", "quality"),
        ]
    )


def _expect_not_null():
    return union(
        [
            expectation_counts("events_nulled", 0, "not_null", "value"),
            expectation_counts("events_nulled", 1, "not_null", "ts"),
            expectation_counts("orders", 0, "not_null", "o_custkey"),
            expectation_counts("documents_labels", 0, "not_null", "quality"),
        ]
    )


def _expect_not_null_mostly():
    return union(
        [
            expectation_counts("events_nulled", 0, "not_null", "value", mostly=0.75),
            expectation_counts("events_nulled", 1, "not_null", "value", mostly=0.85),
            expectation_counts("documents_labels", 0, "not_null", "quality", mostly=0.3),
            expectation_counts("documents_labels", 1, "not_null", "toxic", mostly=0.5),
        ]
    )


def _expect_in_set():
    return union(
        [
            expectation_counts("orders", 0, "in_set", "o_orderstatus", values=["O", "F"]),
            expectation_counts("orders", 1, "in_set", "o_orderstatus", values=["O", None]),
            expectation_counts("part", 0, "in_set", "p_name", values=[]),
            expectation_counts("events_nulled", 0, "in_set", "value", values=[None]),
            expectation_counts("conversations", 0, "in_set", "role", values=["system", "user", "assistant"]),
            expectation_counts("customer", 0, "in_set", "c_mktsegment", mostly=0.5, values=SEGMENTS[:3]),
            expectation_counts("lineitem", 0, "in_set", "l_linestatus", values=["O"]),
            expectation_counts("documents_labels", 0, "in_set", "quality", values=[1]),
        ]
    )


def _expect_between():
    return union(
        [
            expectation_counts("lineitem", 0, "between", "l_quantity", lo=1, hi=50),
            expectation_counts("lineitem", 1, "between", "l_discount", lo=0, hi=0.05),
            expectation_counts("orders", 0, "between", "o_totalprice", hi=400000),
            expectation_counts("customer", 0, "between", "c_acctbal", mostly=0.9, lo=0),
            expectation_counts("part", 0, "between", "p_size", lo=1, hi=40),
            expectation_counts("events_nulled", 0, "between", "value", lo=100, hi=400),
        ]
    )


def _expect_length_between():
    return union(
        [
            expectation_counts("part", 0, "lengths", "p_name", lo=8, hi=11),
            expectation_counts("customer", 0, "lengths", "c_name", hi=18),
            expectation_counts("conversations", 0, "lengths", "text", lo=30, hi=1500),
            expectation_counts("documents", 0, "lengths", "text", lo=100),
            expectation_counts("pages", 0, "lengths", "url", lo=40, hi=50),
        ]
    )


def _expect_row_count_between():
    return union(
        [
            f"SELECT {q(t)} AS table_name, (SELECT count(*) BETWEEN 100 AND 20000 FROM {t}) AS success, "
            f"(SELECT CAST(count(*) AS VARCHAR) FROM {t}) AS observed_value"
            for t in TABLES
        ]
    )


def _expect_columns_ordered():
    cases = {
        "region": ["r_regionkey", "r_name"],
        "nation": ["n_regionkey", "n_name", "n_nationkey"],
        "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
        "labels": ["doc_id", "quality"],
    }
    parts = []
    for t, expected in cases.items():
        actual = columns_of(t)
        parts.append(
            f"SELECT {q(t)} AS table_name, {'true' if actual == expected else 'false'} AS success, "
            f"{q(json.dumps(actual))} AS observed_value"
        )
    return union(parts)


def _expect_unexpected_sample():
    return union(
        [
            unexpected_sample("orders", 0, "expect_column_values_to_be_in_set", "in_set", "o_orderstatus", False, values=["O", "F"]),
            unexpected_sample("orders", 1, "expect_column_values_to_be_unique", "unique", "o_custkey", True),
            unexpected_sample("lineitem", 0, "expect_column_values_to_be_in_set", "in_set", "l_returnflag", False, values=["A", "N"]),
            unexpected_sample("lineitem", 1, "expect_column_values_to_be_between", "between", "l_linenumber", True, lo=2, hi=6),
            unexpected_sample("part", 0, "expect_column_value_lengths_to_be_between", "lengths", "p_name", False, lo=8, hi=11),
            unexpected_sample("conversations", 0, "expect_column_values_to_be_unique", "unique", "conv_id", True),
            unexpected_sample("events_nulled", 0, "expect_column_values_to_not_be_null", "not_null", "value", True),
        ]
    )


def _rules_of(tables, where: str, cols: str) -> str:
    return union([f"SELECT {cols} FROM ({generated_rules(t)}) WHERE {where}" for t in tables])


def _generate_suite():
    return union(
        [
            f"SELECT table_name, seq, expectation_type, \"column\", min_value, max_value, mostly, column_list "
            f"FROM ({generated_rules(t)})"
            for t in ("orders", "events_nulled")
        ]
    )


COMBINED_TABLES = ["orders", "customer", "part", "events_nulled", "documents"]


def _combined_validation():
    return union([f"SELECT * FROM ({generated_results(t)})" for t in COMBINED_TABLES])


def _combined_summary():
    return (
        "SELECT table_name, bool_and(success) AS validation_success, count(*) AS total_expectations, "
        "count(*) FILTER (WHERE success) AS successful_expectations, "
        "count(*) FILTER (WHERE NOT success) AS failed_expectations "
        f"FROM ({_combined_validation()}) GROUP BY table_name"
    )


def _rule_agreement():
    cons = [
        ("orders", "row_count", "", size_c("orders", "c")),
        ("orders", "not_null", "o_orderkey", complete_c("orders", "c", "o_orderkey")),
        ("orders", "unique", "o_orderkey", unique_c("orders", "c", "o_orderkey")),
        ("orders", "in_set", "o_orderstatus", contained_c("orders", "c", "o_orderstatus", ["O", "F"])),
        ("customer", "unique", "c_name", unique_c("customer", "c", "c_name")),
        ("customer", "custom", "", satisfies_c("customer", "c", "c_acctbal >= 0", "balance not negative")),
        ("events_nulled", "not_null", "value", complete_c("events_nulled", "c", "value")),
        ("events_nulled", "not_null", "event_id", complete_c("events_nulled", "c", "event_id")),
    ]
    c_sql = union(
        [f"SELECT {q(t)} AS table_name, {q(k)} AS rule_kind, {q(col)} AS \"column\", {r['status']} = 'Success' AS ok"
         for t, k, col, r in cons]
    )
    exp = [
        ("orders", "row_count", "", f"(SELECT count(*) >= 1 FROM orders)"),
        ("orders", "not_null", "o_orderkey", "(SELECT count(*) FILTER (WHERE o_orderkey IS NULL) = 0 FROM orders)"),
        ("orders", "unique", "o_orderkey", f"(SELECT coalesce(sum(n) FILTER (WHERE n > 1), 0) = 0 FROM {freq('orders', 'o_orderkey')})"),
        ("orders", "in_set", "o_orderstatus", "(SELECT count(*) FILTER (WHERE o_orderstatus NOT IN ('O', 'F', 'P')) = 0 FROM orders)"),
        ("customer", "unique", "c_name", f"(SELECT coalesce(sum(n) FILTER (WHERE n > 1), 0) = 0 FROM {freq('customer', 'c_name')})"),
        ("customer", "range", "c_acctbal", "(SELECT count(*) FILTER (WHERE c_acctbal < 0) = 0 FROM customer)"),
        ("events_nulled", "not_null", "value",
         f"(SELECT CAST(count(value) AS DOUBLE) / count(*) >= 0.7 FROM {src('events_nulled')})"),
        ("events_nulled", "not_null", "event_id", f"(SELECT count(*) FILTER (WHERE event_id IS NULL) = 0 FROM {src('events_nulled')})"),
    ]
    e_sql = union(
        [f"SELECT {q(t)} AS table_name, {q(k)} AS rule_kind, {q(col)} AS \"column\", {ok} AS ok" for t, k, col, ok in exp]
    )
    return f"""
WITH c AS (SELECT table_name, rule_kind, "column", bool_and(ok) AS check_passed FROM ({c_sql}) GROUP BY ALL),
e AS (SELECT table_name, rule_kind, "column", bool_and(ok) AS expectation_passed FROM ({e_sql}) GROUP BY ALL)
SELECT coalesce(c.table_name, e.table_name) AS table_name, coalesce(c.rule_kind, e.rule_kind) AS rule_kind,
  coalesce(c."column", e."column") AS "column", c.check_passed, e.expectation_passed,
  CASE WHEN c.check_passed IS NULL THEN 'expectation_only' WHEN e.expectation_passed IS NULL THEN 'check_only'
       WHEN c.check_passed = e.expectation_passed THEN 'agree' ELSE 'disagree' END AS agreement
FROM c FULL OUTER JOIN e ON c.table_name = e.table_name AND c.rule_kind = e.rule_kind AND c."column" = e."column"
"""


def _flow_checks():
    rows = [size_c(t, "default_checks") for t in TABLES if t not in ("orders", "customer")]
    rows += [
        size_c("orders", "orders_keys"),
        complete_c("orders", "orders_keys", "o_orderkey"),
        unique_c("orders", "orders_keys", "o_orderkey"),
        contained_c("orders", "orders_status", "o_orderstatus", ["O", "F"], level="Warning", check_seq=1),
        satisfies_c("customer", "customer_rules", "c_acctbal >= 0", "balance not negative"),
    ]
    cols = ["table_name", "check_seq", "check_name", "level", "constraint", "metric_value", "status"]
    return (
        "WITH c AS (" + rows_sql(rows, cols) + "), k AS ("
        "SELECT table_name, check_seq, CASE WHEN bool_and(status = 'Success') THEN 'Success' ELSE any_value(level) END "
        "AS check_status FROM c GROUP BY 1, 2), o AS (SELECT table_name, CASE max(CASE check_status WHEN 'Error' THEN 2 "
        "WHEN 'Warning' THEN 1 ELSE 0 END) WHEN 2 THEN 'Error' WHEN 1 THEN 'Warning' ELSE 'Success' END AS overall_status "
        "FROM k GROUP BY 1) "
        "SELECT table_name, overall_status, check_name, check_status, \"constraint\", status, "
        "CASE WHEN status = 'Success' THEN '' ELSE 'Value: ' || CAST(metric_value AS VARCHAR) || "
        "' does not meet the constraint requirement!' END AS message "
        "FROM c JOIN k USING (table_name, check_seq) JOIN o USING (table_name)"
    )


def _flow_suites():
    unique = metric_value("customer", "Uniqueness", "c_custkey")
    return (
        f"SELECT 'orders' AS table_name, (SELECT count(*) FROM orders) AS \"rows\", "
        f"CAST({len(SCHEMAS['orders'])} AS BIGINT) AS columns, false AS validation_success, CAST(1 AS BIGINT) AS rules "
        f"UNION ALL SELECT 'customer', (SELECT count(*) FROM customer), {len(SCHEMAS['customer'])}, "
        f"{unique} = 1 AND (SELECT count(*) FROM customer WHERE c_acctbal < 0) = 0, 2"
    )


def _flow_generated():
    results = union([f"SELECT * FROM ({generated_results(t)})" for t in TABLES])
    return (
        f"SELECT CAST({len(TABLES)} AS BIGINT) AS total_tables_processed, table_name, "
        "bool_and(success) AS validation_success, count(*) AS total_expectations, "
        "count(*) FILTER (WHERE success) AS successful_expectations, "
        f"count(*) FILTER (WHERE NOT success) AS failed_expectations FROM ({results}) GROUP BY table_name"
    )


def _flow_combined_document():
    parts = []
    for t in TABLES:
        r = f"({generated_results(t)})"
        parts.append(
            f"SELECT r.table_name, 'combined_metrics_to_expectations' AS pipeline_type, true AS expectations_from_metrics, "
            f"(SELECT count(*) FROM {src(t)}) AS n_rows, CAST({len(SCHEMAS[t])} AS BIGINT) AS n_columns, "
            "(SELECT bool_and(success) FROM " + r + ") AS validation_success, seq, expectation_type, \"column\", success, "
            "CASE WHEN \"column\" IS NOT NULL THEN element_count END AS element_count, unexpected_count FROM " + r + " r"
        )
    return union(parts)


def _io_csv_scan():
    kinds = {"o_orderkey": "int", "o_custkey": "int", "o_orderstatus": "string", "o_totalprice": "double", "o_orderdate": "timestamp", "o_orderpriority": "string"}
    short, wrong = "(SELECT count(*) FROM orders WHERE o_orderkey % 500 = 0)", "(SELECT count(*) FROM orders WHERE o_orderkey % 700 = 1)"
    n = f"((SELECT count(*) FROM orders) + {short} + {wrong})"
    parts = []
    for c, kind in kinds.items():
        bad = {"o_custkey": short, "o_totalprice": wrong, "o_orderdate": wrong if kind == "x" else "0"}.get(c, "0")
        lost = "0" if c == "o_orderkey" else short
        filled = f"((SELECT count({c}) FROM orders) + {short} + {wrong} - {lost}{' - ' + wrong if c == 'o_totalprice' else ''})"
        parts.append(f"SELECT {q(c)} AS \"column\", {q(kind)} AS type, CAST({bad} AS BIGINT) AS n_bad, round(CAST({filled} AS DOUBLE) / {n}, 9) AS value")
    parts.append(f"SELECT 'lines' AS \"column\", 'malformed' AS type, CAST({short} AS BIGINT) AS n_bad, CAST({n} AS DOUBLE) AS value")
    return union(parts)


def _discover_domains():
    tables = {
        "orders": [c for c in columns_of("orders") if c != "o_totalprice"], "events": ["event_type", "user_id"], "conversations": ["role", "turn"],
        "documents": ["lang", "source", "text"], "customer": ["c_mktsegment", "c_nationkey"],
    }
    parts = [
        f"SELECT {q(t)} AS table_name, {q(c)} AS \"column\", CAST(v AS VARCHAR) AS value, n, sum(n) OVER () AS total FROM {freq(t, c)}"
        for t, cs in tables.items() for c in cs
    ]
    return f"""
WITH f AS ({union(parts)}),
g AS (SELECT * FROM f WHERE n >= 0.01 * total),
c AS (SELECT table_name, "column", CAST(sum(n) AS DOUBLE) / max(total) AS coverage, CAST(count(*) AS INTEGER) AS k FROM g GROUP BY ALL)
SELECT table_name, "column", CAST(row_number() OVER (PARTITION BY table_name, "column" ORDER BY n DESC, value) AS INTEGER) AS rank, value, n,
       round(CAST(n AS DOUBLE) / total, 9) AS share, round(coverage, 9) AS coverage, k AS values, k <= 20 AND coverage >= 0.95 AS proposed,
       CASE WHEN k <= 20 AND coverage >= 0.95 AND coverage < 1 THEN floor(coverage * 10000) / 10000 END AS mostly
FROM g JOIN c USING (table_name, "column")"""


def _generate_bad_metric():
    return (
        "SELECT table_name, table_name || '_auto_generated_suite' AS suite_name, expectation_type, \"column\" "
        f"FROM ({generated_rules('customer')}) "
        "WHERE NOT (expectation_type = 'expect_column_value_lengths_to_be_between' AND \"column\" = 'c_name')"
    )


def _threshold_monitor():
    th = [
        ("events_nulled", "Completeness", "value", 0.9, None),
        ("events_nulled", "Size", None, 1.0, None),
        ("events_nulled", "Maximum", "value", None, 400.0),
        ("orders", "Distinctness", "o_orderkey", 1.0, 1.0),
        ("orders", "Uniqueness", "o_orderstatus", 0.5, None),
        ("orders", "Mean", "o_totalprice", 100000.0, 300000.0),
        ("orders", "Minimum", "o_missing", 0.0, None),
    ]
    parts = []
    for t, m, c, lo, hi in th:
        known = c is None or c in columns_of(t)
        v = metric_value(t, m, c) if known else "CAST(NULL AS DOUBLE)"
        los = "CAST(NULL AS DOUBLE)" if lo is None else f"CAST({lo!r} AS DOUBLE)"
        his = "CAST(NULL AS DOUBLE)" if hi is None else f"CAST({hi!r} AS DOUBLE)"
        parts.append(
            f"SELECT {q(t)} AS table_name, {q(m)} AS metric, {q(c or '*')} AS instance, {v} AS value, "
            f"{los} AS min_value, {his} AS max_value"
        )
    return (
        "SELECT table_name, metric, instance, value, min_value, max_value, CASE WHEN value IS NULL THEN 'missing' "
        "WHEN (min_value IS NULL OR value >= min_value) AND (max_value IS NULL OR value <= max_value) THEN 'ok' "
        f"ELSE 'breach' END AS status FROM ({union(parts)})"
    )


def oracle_sql() -> dict[str, str]:
    return {
        "profile_size": _profile_size(),
        "profile_completeness": _profile_completeness(),
        "profile_completeness_all": _profile_completeness_all(),
        "profile_distinctness": _profile_distinctness(),
        "profile_uniqueness": _profile_uniqueness(),
        "profile_numeric": _profile_numeric(),
        "profile_text_hashed": _profile_text_hashed(),
        "profile_string_length": _profile_string_length(),
        "profile_table": union([profile_rows(t) for t in ("orders", "events_nulled")]),
        "profile_all_tables": union([profile_rows(t) for t in TABLES]),
        "check_has_size": _check_has_size(),
        "check_is_complete": _check_is_complete(),
        "check_is_unique": _check_is_unique(),
        "check_contained_in": _check_contained_in(),
        "check_satisfies": _check_satisfies(),
        "profile_sampled": _profile_sampled(),
        "profile_value_sampled": _profile_value_sampled(),
        "profile_merged": _profile_merged(),
        "profile_sketched": _profile_sketched(),
        "metric_history": _metric_history(),
        "quarantine_orders": _quarantine_orders(),
        "flow_checks": _flow_checks(),
        "flow_suites": _flow_suites(),
        "flow_generated": _flow_generated(),
        "flow_combined_document": _flow_combined_document(),
        "io_csv_scan": _io_csv_scan(),
        "discover_domains": _discover_domains(),
        "generate_bad_metric": _generate_bad_metric(),
        "check_isolation": _check_isolation(),
        "check_status_rollup": _check_status_rollup(),
        "check_default": _check_default(),
        "expect_unique": _expect_unique(),
        "expect_not_null": _expect_not_null(),
        "expect_not_null_mostly": _expect_not_null_mostly(),
        "expect_in_set": _expect_in_set(),
        "expect_between": _expect_between(),
        "expect_length_between": _expect_length_between(),
        "expect_row_count_between": _expect_row_count_between(),
        "expect_columns_ordered": _expect_columns_ordered(),
        "expect_unexpected_sample": _expect_unexpected_sample(),
        "generate_row_count": _rules_of(
            TABLES, "expectation_type = 'expect_table_row_count_to_be_between'", "table_name, min_value, max_value"
        ),
        "generate_completeness_bands": _rules_of(
            ["events_nulled", "documents_labels", "orders"],
            "expectation_type = 'expect_column_values_to_not_be_null'",
            "table_name, \"column\", mostly",
        ),
        "generate_uniqueness": _rules_of(
            ["orders", "part", "documents", "pages", "benchmark", "customer"],
            "expectation_type = 'expect_column_values_to_be_unique'",
            "table_name, \"column\"",
        ),
        "generate_ranges": _rules_of(
            ["lineitem", "orders", "customer"],
            "expectation_type = 'expect_column_values_to_be_between'",
            "table_name, \"column\", min_value, max_value",
        ),
        "generate_min_length": _rules_of(
            ["documents", "customer", "part", "conversations"],
            "expectation_type = 'expect_column_value_lengths_to_be_between'",
            "table_name, \"column\", min_value",
        ),
        "generate_suite": _generate_suite(),
        "combined_validation": _combined_validation(),
        "combined_summary": _combined_summary(),
        "rule_agreement": _rule_agreement(),
        "threshold_monitor": _threshold_monitor(),
    }
