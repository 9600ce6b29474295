"""Mutated samples: every rule kind must fail where it should, and only there."""

import os

import pytest

from assay.operators import expectations as X
from assay.operators.analyzers import Completeness, Minimum, MinLength, Uniqueness, run_analyzers
from assay.operators.checks import Check, verify
from assay.operators.generate import generate_rules
from assay.operators.profile import profile
from assay.plans.flows import generate_and_validate
from assay.plans.registry import DEFAULT_CHECKS, checks_for, suite_for
from assay.sources.tables import read_table
from fixtures import SAMPLES, mutate, write_csv


def load_text(spark, tmp_dir, name, text, **kw):
    return read_table(spark, write_csv(tmp_dir, name, text), **kw)


def statuses(v):
    return {r.constraint: r.status for r in v.constraints.collect()}


def results(df, table):
    return {(r.expectation_type, r.column): r for r in X.validate(df, suite_for(table), table).collect()}


def test_null_key(spark, tmp_dir):
    df = load_text(spark, tmp_dir, "employees", mutate("employees", "10003,1959", ",1959"))
    st = statuses(verify(df, checks_for("employees"), "employees"))
    assert st["CompletenessConstraint(Completeness(emp_no))"] == "Failure"
    assert st["UniquenessConstraint(Uniqueness(emp_no))"] == "Success"  # nulls excluded
    r = results(df, "employees")
    assert not r[(X.NOT_NULL, "emp_no")].success
    assert r[(X.NOT_NULL, "emp_no")].unexpected_count == 1
    assert r[(X.NOT_NULL, "emp_no")].partial_unexpected_list == [None]
    assert r[(X.UNIQUE, "emp_no")].success


def test_duplicate_key(spark, tmp_dir):
    df = load_text(spark, tmp_dir, "employees", mutate("employees", "10002,1964", "10001,1964"))
    st = statuses(verify(df, checks_for("employees"), "employees"))
    assert st["UniquenessConstraint(Uniqueness(emp_no))"] == "Failure"
    r = results(df, "employees")[(X.UNIQUE, "emp_no")]
    assert not r.success
    assert r.unexpected_count == 2
    assert r.partial_unexpected_list == ["10001", "10001"]


def test_gender_outside_set_and_null(spark, tmp_dir):
    df = load_text(spark, tmp_dir, "employees", mutate("employees", "Facello,M", "Facello,X"))
    st = statuses(verify(df, checks_for("employees"), "employees"))
    assert st["ComplianceConstraint(Compliance(gender contained in M,F))"] == "Failure"
    r = results(df, "employees")[(X.IN_SET, "gender")]
    assert (r.success, r.unexpected_count, r.partial_unexpected_list) == (False, 1, ["X"])

    df = load_text(spark, tmp_dir, "employees", mutate("employees", "Facello,M", "Facello,"))
    st = statuses(verify(df, checks_for("employees"), "employees"))
    assert st["ComplianceConstraint(Compliance(gender contained in M,F))"] == "Success"
    assert results(df, "employees")[(X.IN_SET, "gender")].success


def test_emp_no_range(spark, tmp_dir):
    text = mutate("employees", "10001,1953", "10000,1953").replace("10010,1963", "1000000,1963")
    df = load_text(spark, tmp_dir, "employees", text)
    r = results(df, "employees")[(X.BETWEEN, "emp_no")]
    assert (r.success, r.unexpected_count) == (False, 2)
    assert r.partial_unexpected_list == ["10000", "1000000"]


def test_reordered_columns(spark, tmp_dir):
    text = SAMPLES["titles"].replace("emp_no,title,", "title,emp_no,")
    text = "\n".join(
        (",".join([p[1], p[0]] + p[2:]) if i else line)
        for i, line in enumerate(text.splitlines())
        for p in [line.split(",")]
    ) + "\n"
    df = load_text(spark, tmp_dir, "titles", text)
    r = results(df, "titles")
    assert not r[(X.TABLE_COLUMNS, None)].success
    assert all(v.success for k, v in r.items() if k[0] != X.TABLE_COLUMNS)


def test_salary_zero_and_null(spark, tmp_dir):
    df = load_text(spark, tmp_dir, "salaries", mutate("salaries", "10001,60117", "10001,0"))
    st = statuses(verify(df, checks_for("salaries"), "salaries"))
    assert st["ComplianceConstraint(Compliance(Salary should be positive))"] == "Failure"
    assert st["CompletenessConstraint(Completeness(salary))"] == "Success"
    r = results(df, "salaries")
    assert not r[(X.BETWEEN, "salary")].success and r[(X.NOT_NULL, "salary")].success

    df = load_text(spark, tmp_dir, "salaries", mutate("salaries", "10001,60117", "10001,"))
    v = verify(df, checks_for("salaries"), "salaries")
    st = statuses(v)
    assert st["ComplianceConstraint(Compliance(Salary should be positive))"] == "Failure"  # null is not compliant
    assert st["CompletenessConstraint(Completeness(salary))"] == "Failure"
    assert v.status.collect()[0].overall_status == "Error"
    r = results(df, "salaries")
    assert r[(X.BETWEEN, "salary")].success  # nulls are skipped by range rules
    assert not r[(X.NOT_NULL, "salary")].success


def test_salary_bounds_inclusive(spark, tmp_dir):
    text = SAMPLES["salaries"]
    for old, new in [("60117", "29999"), ("62102", "30000"), ("66074", "200000"), ("65828", "200001")]:
        text = text.replace(old, new, 1)
    df = load_text(spark, tmp_dir, "salaries", text)
    r = results(df, "salaries")[(X.BETWEEN, "salary")]
    assert r.unexpected_count == 2
    assert r.partial_unexpected_list == ["29999", "200001"]
    assert r.unexpected_percent == pytest.approx(20.0)


def test_department_duplicate_name(spark, tmp_dir):
    df = load_text(spark, tmp_dir, "departments", mutate("departments", "d002,Finance", "d002,Marketing"))
    st = statuses(verify(df, checks_for("departments"), "departments"))
    assert st["UniquenessConstraint(Uniqueness(dept_name))"] == "Failure"
    assert st["UniquenessConstraint(Uniqueness(dept_no))"] == "Success"
    r = results(df, "departments")[(X.UNIQUE, "dept_name")]
    assert (r.success, r.unexpected_count) == (False, 2)


def test_empty_table(spark, tmp_dir):
    df = load_text(spark, tmp_dir, "employees", SAMPLES["employees"].splitlines()[0] + "\n")
    m = {(r.metric, r.instance): r for r in profile(df, "employees").collect()}
    assert m[("Size", "*")].value == 0.0 and m[("Size", "*")].status == "Success"
    failed = [r for r in m.values() if r.status == "Failure"]
    assert failed and all(r.value is None and r.message for r in failed)
    v = verify(df, checks_for("employees"), "employees")
    st = statuses(v)
    assert st["SizeConstraint(Size())"] == "Failure"
    assert all(s == "Failure" for s in st.values())
    # suite generation skips metrics without a value; the row-count rule is [0, 0]
    rules, res = generate_and_validate(df, "employees")
    rows = rules.collect()
    assert {r.expectation_type for r in rows} == {X.TABLE_ROWS, X.TABLE_COLUMNS}
    assert all(r.success for r in res.collect())


def test_unknown_table_uses_default_checks(spark, tmp_dir):
    df = load_text(spark, tmp_dir, "projects", "id,name\n1,a\n2,b\n")
    checks = checks_for("projects")
    assert checks == DEFAULT_CHECKS
    v = verify(df, checks, "projects")
    rows = v.constraints.collect()
    assert [(r.check_name, r.constraint, r.status) for r in rows] == [
        ("default_checks", "SizeConstraint(Size())", "Success")
    ]
    assert suite_for("projects") is None


def test_null_tokens(spark, tmp_dir):
    text = "id,name\n1,NA\n2,null\n3,\n4,x\n"
    path = write_csv(tmp_dir, "tokens", text)
    plain = read_table(spark, path)
    assert [r.name for r in plain.orderBy("id").collect()] == ["NA", "null", None, "x"]
    cleaned = read_table(spark, path, null_tokens=("", "NA", "null"))
    assert [r.name for r in cleaned.orderBy("id").collect()] == [None, None, None, "x"]


def test_completeness_bands(spark):
    """Suite-generation thresholds at their boundaries (completeness and uniqueness)."""
    n = 10000
    base = spark.range(n).selectExpr(
        "id",
        f"CASE WHEN id < {n * 0.4999} THEN id END AS c4999",
        f"CASE WHEN id < {n * 0.5} THEN id END AS c5000",
        f"CASE WHEN id < {n * 0.9499} THEN id END AS c9499",
        f"CASE WHEN id < {n * 0.95} THEN id END AS c9500",
        "CAST(id AS STRING) AS u100",
        f"CASE WHEN id < {n * 0.989} THEN CAST(id AS STRING) ELSE 'dup' END AS u989",
        f"CASE WHEN id < {n * 0.99} THEN CAST(id AS STRING) ELSE CAST(id - 100 AS STRING) END AS u99",
    )
    m = profile(base, "bands")
    comp = {r.instance: r.value for r in m.where("metric = 'Completeness'").collect()}
    assert comp["c4999"] == 0.4999 and comp["c5000"] == 0.5 and comp["c9500"] == 0.95
    rules = {
        (r.expectation_type, r.column): r for r in generate_rules(m, {"bands": base.columns}).collect()
    }
    assert (X.NOT_NULL, "c4999") not in rules
    assert rules[(X.NOT_NULL, "c5000")].mostly == pytest.approx(0.45)
    assert rules[(X.NOT_NULL, "c9499")].mostly == pytest.approx(0.9499 * 0.9)
    assert rules[(X.NOT_NULL, "c9500")].mostly is None
    assert (X.UNIQUE, "u100") in rules
    assert (X.UNIQUE, "u989") not in rules
    uniq = {r.instance: r.value for r in m.where("metric = 'Uniqueness'").collect()}
    assert uniq["u99"] == pytest.approx(0.98)  # 100 values moved onto 100 others
    # a nearly complete column yields a strict rule that fails on its own data
    _, res = generate_and_validate(base, "bands")
    failing = {(r.expectation_type, r.column) for r in res.collect() if not r.success}
    assert failing == {(X.NOT_NULL, "c9500")}


def test_bounds_scoped_per_table(spark):
    a = spark.createDataFrame([(1, 5), (2, 6)], "x int, only_a int")
    b = spark.createDataFrame([(10,), (20,)], "x int")
    m = profile(a, "a").unionByName(profile(b, "b"))
    rules = generate_rules(m, {"a": a.columns, "b": b.columns}).collect()
    ranges = {(r.table_name, r.column): (r.min_value, r.max_value) for r in rules if r.expectation_type == X.BETWEEN}
    assert ranges == {("a", "x"): (1.0, 2.0), ("a", "only_a"): (5.0, 6.0), ("b", "x"): (10.0, 20.0)}


def test_uniqueness_not_above_distinctness_and_partition_invariance(spark):
    df = spark.range(5000).selectExpr("id % 97 AS k", "CAST(id % 13 AS STRING) AS s", "id")
    a = [Completeness("k"), Uniqueness("k"), Uniqueness("s"), Uniqueness("id")]
    from assay.operators.analyzers import Distinctness

    a += [Distinctness("k"), Distinctness("s"), Distinctness("id")]
    one = {(r.metric, r.instance): r.value for r in run_analyzers(df, a).collect()}
    many = {(r.metric, r.instance): r.value for r in run_analyzers(df.repartition(13), a).collect()}
    assert one == many
    for c in ("k", "s", "id"):
        assert one[("Uniqueness", c)] <= one[("Distinctness", c)]


def test_custom_assertions_and_warning_level(spark):
    df = spark.range(100).selectExpr("id", "CASE WHEN id % 10 = 0 THEN NULL ELSE id END AS v")
    checks = [
        Check("sizes", level="Warning").has_size("value BETWEEN 50 AND 150").has_completeness("v", "value >= 0.95"),
        Check("callables").has_size(lambda v: v == 100).has_completeness("v", lambda v: v >= 0.9),
    ]
    v = verify(df, checks, "t")
    st = {r.check_name: r.status for r in v.checks.collect()}
    assert st == {"sizes": "Warning", "callables": "Success"}
    assert v.status.collect()[0].overall_status == "Warning"
    msg = [r.message for r in v.constraints.collect() if r.status == "Failure"]
    assert msg == ["Value: 0.9 does not meet the constraint requirement!"]


def test_missing_column_fails_only_its_rules(spark):
    df = spark.range(10).selectExpr("id", "CAST(id AS STRING) AS s")
    v = verify(df, [Check("c").has_size().is_complete("nope").is_unique("nada")], "t")
    rows = {r.constraint: r for r in v.constraints.collect()}
    assert rows["SizeConstraint(Size())"].status == "Success"
    assert rows["CompletenessConstraint(Completeness(nope))"].message == "Input data does not include column nope!"
    assert rows["UniquenessConstraint(Uniqueness(nada))"].status == "Failure"
    res = X.validate(
        df,
        [
            X.expect_column_values_to_not_be_null("nope"),
            X.expect_column_values_to_be_in_set("nope", ["a"]),
            X.expect_column_values_to_be_unique("nope"),
            X.expect_column_values_to_be_unique("s"),
        ],
        "t",
    ).collect()
    assert [r.success for r in sorted(res, key=lambda r: r.seq)] == [False, False, False, True]


def test_wide_table_is_split_into_bounded_plans(spark):
    from assay.operators.analyzers import analyzer_plans
    from assay.operators.profile import profile_analyzers
    from assay.plans.parallel import materialized_union

    df = spark.range(50).selectExpr("id", *[f"id * {k} AS c{k}" for k in range(70)])
    analyzers = profile_analyzers(df.schema)
    plans = analyzer_plans(df, analyzers, "wide", max_columns=16)
    assert len(plans) == 5  # 71 frequency columns in chunks of 16; scan aggregates split alike
    split = {(r.metric, r.instance): r.value for r in materialized_union(plans).collect()}
    whole = {(r.metric, r.instance): r.value for r in run_analyzers(df, analyzers, "wide").collect()}
    assert split == whole and len(whole) == len(analyzers)


def test_digest_grouping_is_exact(spark):
    """Columns grouped by digest give the statistics of grouping by value; no wide value is a shuffle key."""
    from assay.operators.analyzers import Distinctness, DuplicateRows

    one = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    df = one.unionByName(one.limit(37)).selectExpr(
        "*", "array(CAST(doc_id % 7 AS DOUBLE) * -0.0, doc_id % 7) AS vec", "CAST(lang AS BINARY) AS raw",
        "IF(doc_id % 3 = 0, array(lang, NULL), array(lang, 'null')) AS tags",
    )
    for c in ("text", "lang", "vec", "raw", "tags"):
        n = [r["count"] for r in df.where(f"{c} IS NOT NULL").groupBy(c).count().collect()]
        analyzers = [Distinctness(c), Uniqueness(c), DuplicateRows(c)]
        got = {r.metric: r.value for r in run_analyzers(df, analyzers).collect()}
        assert got["Distinctness"] == len(n) / sum(n)
        assert got["Uniqueness"] == sum(x == 1 for x in n) / sum(n)
        assert got["DuplicateRows"] == sum(x for x in n if x > 1)
    plan = run_analyzers(df, [Distinctness("text"), Distinctness("vec")])._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert exchanges and not any("hashpartitioning(text" in x or "hashpartitioning(vec" in x for x in exchanges)


def test_braces_in_user_text(spark):
    """Regex quantifiers, braces in values and in column names reach Spark unchanged."""
    df = spark.createDataFrame([("M", 1), ("{}", 2), ("ab", 3)], "g string, `x{1}` int")
    v = verify(df, [Check("c").satisfies("g rlike '^[A-Z]{1}$'", "one letter").is_contained_in("g", ["{}", "M"]).is_unique("x{1}")], "t")
    assert [r.metric_value for r in v.constraints.orderBy("seq").collect()] == [pytest.approx(1 / 3), pytest.approx(2 / 3), 1.0]
    res = X.validate(df, [X.expect_column_values_to_be_in_set("g", ["{}"]), X.expect_column_values_to_be_unique("x{1}")], "t")
    assert [r.unexpected_count for r in res.orderBy("seq").collect()] == [2, 0]


def test_sets_with_null_and_empty_sets(spark):
    df = spark.createDataFrame([("M",), ("X",), (None,), ("F",)], "g string")
    rules = [X.expect_column_values_to_be_in_set("g", v) for v in (["M", "F", None], [], [None])]
    got = X.validate(df, rules, "t").orderBy("seq").collect()
    assert [(r.unexpected_count, r.success) for r in got] == [(1, False), (3, False), (3, False)]
    checks = [Check("c").is_contained_in("g", ["M", "F", None]).is_contained_in("g", [])]
    assert [r.metric_value for r in verify(df, checks, "t").constraints.orderBy("seq").collect()] == [0.75, 0.25]


def test_rules_of_one_name_stay_apart(spark):
    df = spark.range(4)
    checks = [Check("c").satisfies("id > 1", "rule").satisfies("id > 0", "rule")
              .is_contained_in("id", ["0,1"]).is_contained_in("id", ["0", "1"])]
    rows = verify(df, checks, "t").constraints.orderBy("seq").collect()
    assert [r.metric_value for r in rows][:2] == [0.5, 0.75] and len(rows) == 4


def test_bad_rules_fail_alone(spark):
    """Missing columns, wrong types, unresolvable and failing predicates: a failed row each, the others keep theirs."""
    df = spark.createDataFrame([("a", 1), ("b", 2)], "s string, n int")
    checks = [Check("c").satisfies("zz > 0", "gone").satisfies("1 / (n - n) > 0", "zero").is_complete("s").satisfies("n >", "syntax")]
    got = {r.constraint: (r.status, r.message) for r in verify(df, checks, "t").constraints.collect()}
    assert got["CompletenessConstraint(Completeness(s))"] == ("Success", "")
    assert sorted(s for s, _ in got.values()) == ["Failure"] * 3 + ["Success"]
    assert all(m for s, m in got.values() if s == "Failure")
    rows = {r.analyzer: r for r in run_analyzers(df, [Minimum("s"), MinLength("n"), Minimum("n")]).collect()}
    assert rows["Minimum(n)"].value == 1.0
    assert "Expected type" in rows["Minimum(s)"].message and "Expected type" in rows["MinLength(n)"].message


def test_null_samples_obey_the_sample_size(spark):
    df = spark.range(100).selectExpr("IF(id < 60, NULL, id) AS x", "CAST(id % 30 AS STRING) AS t")
    rules = [X.expect_column_values_to_not_be_null("x"), X.expect_column_values_to_be_between("x", 0, 1), X.expect_column_values_to_be_unique("t")]
    for size in (5, 50):
        got = X.validate(df, rules, "t", sample_size=size).orderBy("seq").collect()
        assert [len(r.partial_unexpected_list) for r in got] == [size, min(size, 40), size]


def test_sample_does_not_depend_on_layout(spark):
    from assay.operators.generate import generate_rules
    from assay.operators.profile import SAMPLED, profile

    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    key = ["l_orderkey", "l_linenumber"]
    one, two = (
        sorted(map(tuple, profile(x, "l", sample_fraction=0.1, sample_key=key).select("analyzer", "value").collect()))
        for x in (df, df.repartition(13))
    )
    assert [a for a, _ in one] == [a for a, _ in two]
    assert all(x == pytest.approx(y) for (_, x), (_, y) in zip(one, two, strict=True))
    m = profile(df, "l", sample_fraction=0.1, sample_key=key)
    assert {r.metric_type for r in m.collect()} == {SAMPLED}
    kinds = {r.expectation_type for r in generate_rules(m, {"l": df.columns}).collect()}
    assert not kinds & {X.TABLE_ROWS, X.BETWEEN, X.LENGTHS}


def test_samples_with_precomputed_metrics_match(spark):
    """With metrics given, only rules with unexpected values are sampled; results are unchanged."""
    from assay.plans.parallel import compute_metrics

    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    rules = [
        X.expect_column_values_to_be_in_set("o_orderstatus", ["O", "F"]),
        X.expect_column_values_to_be_in_set("o_orderstatus", ["O", "F", "P"]),
        X.expect_column_values_to_be_unique("o_custkey"),
        X.expect_column_values_to_be_unique("o_orderkey"),
        X.expect_column_values_to_not_be_null("o_custkey"),
    ]
    lazy = [tuple(r) for r in X.validate(df, rules, "o").orderBy("seq").collect()]
    metrics = compute_metrics({"o": (df, X.rule_analyzers(rules))})
    eager = [tuple(r) for r in X.validate(df, rules, "o", metrics=metrics).orderBy("seq").collect()]
    assert lazy == eager
    assert [len(r[-1]) for r in eager] == [20, 0, 20, 0, 0]


def test_values_with_quotes_and_backslashes(spark):
    """Rule values are embedded as SQL literals; quoting must keep them exact."""
    vals = ["O'Brien", "back\\slash", 'dq"x', "日本", "plain"]
    df = spark.createDataFrame([(v,) for v in vals + ["other"]], "name string")
    v = verify(df, [Check("c").is_contained_in("name", vals)], "t")
    row = v.constraints.collect()[0]
    assert row.metric_value == pytest.approx(5 / 6)
    res = X.validate(df, [X.expect_column_values_to_be_in_set("name", vals)], "t").collect()[0]
    assert (res.unexpected_count, res.partial_unexpected_list) == (1, ["other"])
    res = X.validate(df, [X.expect_column_values_to_be_in_set("name", ["other"])], "t").collect()[0]
    assert sorted(res.partial_unexpected_list) == sorted(vals)
