"""Directory flows: listing, reading, per-table isolation, sinks and the summary."""

import json
import os
import sys
import tempfile

import pytest

from assay.plans import flows
from assay.sources import results as R
from assay.sources.tables import list_tables, table_name_of
from fixtures import write_csv, write_samples

TABLES = ["departments", "dept_emp", "dept_manager", "employees", "salaries", "titles"]


@pytest.fixture(scope="module")
def dataset():
    d = write_samples(tempfile.mkdtemp(prefix="assay-flow-"))
    write_csv(d, "Projects", "id,name\n1,a\n2,b\n3,c\n")  # unknown table, upper-case file name
    with open(os.path.join(d, "broken.csv"), "wb") as f:  # not parseable as the header promises
        f.write(b"a,b\n1,2,3,4\n\x00\x01\x02\n")
    with open(os.path.join(d, "notes.txt"), "w") as f:
        f.write("ignored")
    return d


@pytest.fixture(scope="module")
def output():
    return tempfile.mkdtemp(prefix="assay-out-")


def test_table_names():
    assert table_name_of("/x/y/Employees.csv") == "employees"
    assert table_name_of("file:/x/dept_emp.csv") == "dept_emp"


def test_list_tables(spark, dataset):
    names = [n for n, _ in list_tables(spark, dataset)]
    assert names == sorted(names)
    assert set(names) == set(TABLES) | {"projects", "broken"}
    assert list_tables(spark, tempfile.mkdtemp(prefix="assay-empty-")) == []
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        list_tables(spark, os.path.join(dataset, "missing"))


def test_malformed_lines_are_counted(spark):
    d, out = tempfile.mkdtemp(prefix="assay-bad-"), tempfile.mkdtemp(prefix="assay-out-")
    write_csv(d, "t", "id,name\n1,a\n2,y,EXTRA,MORE\n3\n4,NA\n")
    res = flows.profile_and_check(spark, d, out, options={"t": {"schema": "id int, name string", "null_tokens": ["NA"]}})
    assert [(r.status, r.malformed) for r in res.runs] == [("ok", 2)]
    size = {r.analyzer: r.value for r in res.outputs["metrics"].collect()}
    assert size["Size()"] == 4.0 and size["Completeness(name)"] == 0.5
    from assay.session import ensure_checkpoint_dir

    left = os.path.join(ensure_checkpoint_dir(spark).removeprefix("file:"), "assay-staged")
    assert not [x for x in (os.listdir(left) if os.path.isdir(left) else []) if x.startswith("t-")]


@pytest.fixture(scope="module")
def checked(spark, dataset, output):
    return flows.profile_and_check(spark, dataset, output, max_parallel=3)


def test_profile_and_check(spark, checked, output):
    ok = set(checked.by_status("ok"))
    assert set(TABLES) | {"projects"} <= ok
    metrics = spark.read.json(os.path.join(output, R.METRICS))
    counts = {r["table_name"]: r["count"] for r in metrics.groupBy("table_name").count().collect()}
    assert counts["employees"] == 27 and counts["departments"] == 12
    ver = {r.table_name: r.overall_status for r in spark.read.json(os.path.join(output, R.VERIFICATION)).collect()}
    assert all(ver[t] == "Success" for t in TABLES + ["projects"])
    cons = spark.read.json(os.path.join(output, R.CONSTRAINTS))
    assert cons.where("table_name = 'projects'").select("check_name").distinct().collect()[0][0] == "default_checks"
    report = spark.read.json(os.path.join(output, R.REPORTS, "metrics")).where("table_name = 'employees'").collect()[0]
    assert len(report.metrics) == 27 and report.metrics[0].analyzer == "Size()"


def test_broken_file_is_isolated(checked):
    status = {r.table_name: r.status for r in checked.runs}
    # the broken table either fails alone or is read permissively; it never stops the others
    assert all(status[t] == "ok" for t in TABLES)


def test_static_validation(spark, dataset, output):
    res = flows.validate_static(spark, dataset, output, max_parallel=3)
    assert set(res.by_status("skipped")) == {"projects", "broken"}
    outcome = {r.table_name: r for r in res.outputs["outcome"].collect()}
    assert outcome["employees"].total_expectations == 7 and outcome["employees"].validation_success
    assert (outcome["employees"].rows, outcome["employees"].columns) == (10, 6)
    doc = spark.read.json(os.path.join(output, R.REPORTS, R.EXPECTATIONS)).where("table_name = 'salaries'").collect()[0]
    assert doc.validation_success and doc.data_shape.rows == 10 and len(doc.results) == 4


def test_generated_validation_and_summary(spark, dataset, output, checked):
    res = flows.validate_generated(spark, dataset, output, max_parallel=3)
    ok = set(res.by_status("ok"))
    assert set(TABLES) <= ok
    summary = {r.table_name: r for r in res.outputs["summary"].collect()}
    assert summary["employees"].total_expectations == 14
    assert all(summary[t].validation_success and summary[t].failed_expectations == 0 for t in TABLES)
    assert {r.total_tables_processed for r in summary.values()} == {len(ok)}
    files = [f for f in os.listdir(os.path.join(output, R.SUMMARY)) if f.endswith(".json")]
    assert len(files) == 1
    rows = [json.loads(x) for x in open(os.path.join(output, R.SUMMARY, files[0]))]
    assert {r["pipeline_type"] for r in rows} == {flows.PIPELINE_TYPE}


def test_generated_skips_tables_without_metrics(spark, dataset):
    empty_out = tempfile.mkdtemp(prefix="assay-out-")
    res = flows.validate_generated(spark, dataset, empty_out)
    assert res.by_status("ok") == []
    assert set(res.by_status("skipped")) >= set(TABLES)


def test_metrics_scan(spark, output, checked):
    m = R.read_metrics(spark, output, "titles")
    assert m is not None and m.count() == 17
    assert R.read_metrics(spark, output, "no_such_table") is None
    assert R.read_metrics(spark, "/nonexistent/dir", "titles") is None


def test_command_line_all(samples_dir):
    import subprocess

    out = tempfile.mkdtemp(prefix="assay-cli-")
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    proc = subprocess.run(
        [sys.executable, "-m", "assay", "all", samples_dir, out, "--local", "2"],
        cwd=repo,
        capture_output=True,
        text=True,
        timeout=600,
    )
    assert proc.returncode == 0, proc.stderr[-2000:]
    lines = [json.loads(x) for x in proc.stdout.splitlines() if x.startswith("{")]
    assert [x["flow"] for x in lines] == ["checks", "suites", "generated"]
    assert all(sorted(x["ok"]) == sorted(TABLES) for x in lines)
    assert os.path.isdir(os.path.join(out, R.SUMMARY))


def test_failing_rule_is_isolated(spark, dataset):
    """A rule on a missing column fails alone; its table and the others are finished."""
    import shutil

    from assay.operators.checks import Check
    from assay.plans.registry import STATIC_CHECKS

    folder = tempfile.mkdtemp(prefix="assay-broken-")
    for name in os.listdir(dataset):
        shutil.copy(os.path.join(dataset, name), folder)
    out = tempfile.mkdtemp(prefix="assay-out-")
    checks = dict(STATIC_CHECKS)
    checks["titles"] = [Check("bad").satisfies("no_such_column > 0", "refers to a missing column").has_size()]
    res = flows.profile_and_check(spark, folder, out, checks=checks, max_parallel=3)
    status = {r.table_name: r.status for r in res.runs}
    assert all(status[t] == "ok" for t in TABLES)
    rows = [r for r in spark.read.json(os.path.join(out, R.CONSTRAINTS)).collect() if r.table_name == "titles"]
    assert sorted(r.status for r in rows) == ["Failure", "Success"]


def test_reports_are_one_file_per_table(output, checked):
    for name in ("metrics",):
        base = os.path.join(output, R.REPORTS, name)
        for part in os.listdir(base):
            if part.startswith("table_name="):
                files = [f for f in os.listdir(os.path.join(base, part)) if f.endswith(".json")]
                assert len(files) == 1, (part, files)
