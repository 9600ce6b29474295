"""CSV typed in one parse, value-set discovery, and one staging for all flows of a run."""

import collections
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from assay.__main__ import main
from assay.operators.domains import discover_domains, domains_to_expectations, heavy_buckets
from assay.operators.expectations import validate
from assay.plans import flows
from assay.session import ensure_checkpoint_dir
from assay.sources.tables import read_table
from assay.sources.typed import read_csv_typed


def put(path, text):
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return str(path)


CSV = (
    "id,big,price,day,at,flag,name,empty,mixed\r\n"
    "1,9999999999,1.5,2024-01-02,2024-01-02 03:04:05,true,x,,1\r\n"
    "2,-1,NaN,2024-02-30,2024-01-02T03:04:05.123Z,FALSE,\"a, b\",,x\r\n"
    "007,5,1e3,2024-12-31,2024-01-02 03:04,false,NA,,2\r\n"
    "4,6\r\n"
    "5,7,2,2024-01-01,2024-01-01 00:00:00,true,y,,3,extra\r\n"
)


def test_types_and_bad_cells(spark, tmp_dir):
    path = put(os.path.join(tmp_dir, "t.csv"), CSV)
    got = read_csv_typed(spark, path, null_tokens=("", "NA"), max_bad_share=0.34)
    assert got.types == {"id": "int", "big": "bigint", "price": "double", "day": "date", "at": "timestamp", "flag": "boolean", "name": "string", "empty": "string", "mixed": "int"}
    assert got.bad == {"id": 0, "big": 0, "price": 0, "day": 1, "at": 0, "flag": 0, "name": 0, "empty": 0, "mixed": 1}
    assert sorted(map(tuple, got.bad_cells.collect())) == [("day", "2024-02-30", 1), ("mixed", "x", 1)]
    assert got.malformed_lines == 2 and sorted(r["line"] for r in got.malformed.collect()) == ["4,6", "5,7,2,2024-01-01,2024-01-01 00:00:00,true,y,,3,extra"]
    rows = {r["id"]: r for r in got.table.collect()}
    assert set(rows) == {1, 2, 7, 4, 5} and rows[2]["name"] == "a, b" and rows[7]["name"] is None and rows[2]["day"] is None and rows[4]["price"] is None
    strict = read_csv_typed(spark, path)
    assert strict.types["day"] == "string" and strict.types["mixed"] == "string" and strict.bad_cells.count() == 0
    assert [r["day"] for r in strict.table.where("id = 2").collect()] == ["2024-02-30"]


def test_same_types_as_the_reader(spark, samples_dir):
    """On clean files both ways of reading give the same table."""
    for name in sorted(os.listdir(samples_dir)):
        path = os.path.join(samples_dir, name)
        one, two = read_table(spark, path, "csv"), read_csv_typed(spark, path).table
        assert one.dtypes == two.dtypes
        assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))


def test_one_parse(spark, tmp_dir):
    """Every use reads the columnar copy, not the text."""
    path = put(os.path.join(tmp_dir, "t.csv"), CSV)
    staged = []
    got = read_csv_typed(spark, path, staged=staged)
    os.remove(path)
    for _ in range(2):
        assert got.table.count() == 5 and got.malformed.count() == 2
    assert len(staged) == 1
    plan = got.table.select("id")._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "csv" not in plan.lower().replace("t.csv", "") and "ReadSchema: struct<id:string>" in plan
    empty = read_csv_typed(spark, put(os.path.join(tmp_dir, "e.csv"), "a,b\n"))
    assert empty.table.count() == 0 and set(empty.types.values()) == {"string"}


# ---- domains ---------------------------------------------------------------------------------


def brute_domains(values, least_share):
    total = sum(v is not None for v in values)
    count = collections.Counter(v for v in values if v is not None)
    return sorted(((v, n) for v, n in count.items() if n >= least_share * total), key=lambda x: (-x[1], x[0])), total


def test_domains_against_counts(spark):
    rng = random.Random(3)
    rows = [
        (rng.choice("abc") if rng.random() < 0.97 else f"rare{i}", rng.choice([1, 2, None]), f"unique {i}", "long " * 50 if i % 3 else None, rng.random() < 0.5, [i % 2])
        for i in range(3000)
    ]
    df = spark.createDataFrame(rows, "s string, i int, u string, l string, b boolean, a array<int>").withColumn("st", F.struct("s")).repartition(5)
    got = discover_domains(df, "t").collect()
    by = collections.defaultdict(list)
    for r in sorted(got, key=lambda r: r["rank"]):
        by[r["column"]].append((r["value"], r["n"]))
    for k, c in enumerate(("s", "i", "u", "l", "b")):
        shown = [str(r[k]).lower() if c == "b" else None if r[k] is None else str(r[k]) for r in rows]
        want, total = brute_domains(shown, 0.01)
        assert by.get(c, []) == want
        for r in got:
            if r["column"] == c:
                assert r["coverage"] == pytest.approx(sum(n for _, n in want) / total) and r["values"] == len(want)
    assert "u" not in by and "st" not in by and len(by["a"]) == 2
    proposed = {r["column"]: r["mostly"] for r in got if r["proposed"]}
    assert set(proposed) == {"s", "i", "l", "b", "a"} and 0.95 <= proposed["s"] < 1 and proposed["i"] is None
    rules = domains_to_expectations([r for r in got if r["column"] != "a"], df.schema)
    assert [r.column for r in rules] == ["s", "i", "l", "b"]
    assert all(r["success"] for r in validate(df.drop("a", "st"), rules).collect())
    assert [r["success"] for r in validate(df.withColumn("i", F.lit(9)).drop("a", "st"), rules).orderBy("seq").collect()] == [True, False, True, True]
    assert discover_domains(df.limit(0), "t").collect() == []


def test_summary_is_bounded_and_loses_no_frequent_value(spark):
    """A column of different values keeps no bucket; a frequent one keeps its bucket, however many others there are."""
    df = spark.range(200_000).selectExpr("if(id % 50 = 0, -1, id) AS v")
    heavy = heavy_buckets(df, ["v"], 0.01).collect()
    assert 1 <= len(heavy) <= 2
    assert [(r["value"], r["n"]) for r in discover_domains(df, "t").collect()] == [("-1", 4000)]


# ---- one staging ---------------------------------------------------------------------------------


def staged_folders(spark):
    left = os.path.join(ensure_checkpoint_dir(spark).removeprefix("file:"), "assay-staged")
    return set(os.listdir(left)) if os.path.isdir(left) else set()


def test_command_line_types_and_one_staging(spark, tmp_dir, monkeypatch, capsys):
    os.makedirs(os.path.join(tmp_dir, "in"))
    put(os.path.join(tmp_dir, "in", "codes.csv"), "code,name\n001,NA\n002,b\n")
    put(os.path.join(tmp_dir, "in", "other.csv"), "n\n1\n2\n")
    loads, real = [], flows.load
    monkeypatch.setattr(flows, "load", lambda *a, **k: (loads.append(k["name"]), real(*a, **k))[1])
    before = staged_folders(spark)
    out = os.path.join(tmp_dir, "out")
    assert main(["all", os.path.join(tmp_dir, "in"), out, "--schema", "Codes=code STRING, name STRING", "--null-token", "NA"]) == 0
    assert sorted(loads) == ["codes", "other"]  # once each, for all three flows
    assert staged_folders(spark) == before
    metrics = {(r["analyzer"]): r["value"] for r in spark.read.json(os.path.join(out, "metrics")).where("table_name = 'codes'").collect()}
    assert metrics["Completeness(name)"] == 0.5 and metrics["MinLength(code)"] == 3.0
    assert len([json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{\"flow")]) == 3
    with pytest.raises(SystemExit):
        main(["all", tmp_dir, out, "--schema", "no equals sign"])


def test_staged_copies_go_after_an_error(spark, tmp_dir, monkeypatch):
    put(os.path.join(tmp_dir, "a.csv"), "n\n1\n")
    before = staged_folders(spark)
    monkeypatch.setattr(flows.R, "write_result", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("disk full")))
    with pytest.raises(RuntimeError, match="disk full"):
        flows.profile_and_check(spark, tmp_dir, os.path.join(tmp_dir, "out"))
    assert staged_folders(spark) == before
