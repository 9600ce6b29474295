"""Sampled metrics with bounds, and the run history."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from assay.operators.expectations import UNIQUE
from assay.operators.generate import generate_rules
from assay.operators.history import append_history, deviations, read_history
from assay.operators.profile import profile
from assay.operators.sampling import VALUE_SAMPLED, row_sample_bounds, value_sampled_profile

SF = "/root/testdata/sf0.001"


def by_metric(df):
    return {(r["metric"], r["instance"]): r for r in df.collect()}


def test_repeated_values_stay_together(spark):
    """Every value twice: no row sample of four thousandths shows it, a sample of values does."""
    df = spark.range(400_000).selectExpr("CAST(id AS STRING) AS id", "CAST(id % 200000 AS STRING) AS twice")
    got = by_metric(value_sampled_profile(df, "t", 0.004))
    twice = got["Uniqueness", "twice"]
    assert twice["value"] == 0.0 and twice["lower"] == 0.0 and 0 < twice["upper"] < 0.01 and twice["metric_type"] == VALUE_SAMPLED
    assert got["Distinctness", "twice"]["lower"] <= 0.5 <= got["Distinctness", "twice"]["upper"] < 0.6
    assert got["Uniqueness", "id"]["lower"] <= 1.0 == got["Uniqueness", "id"]["upper"]
    rules = generate_rules(value_sampled_profile(df, "t", 0.004), {"t": df.columns})
    assert [r["column"] for r in rules.collect() if r["expectation_type"] == UNIQUE] == []  # 0.95 is not certain enough
    rules = generate_rules(value_sampled_profile(df, "t", 0.5), {"t": df.columns})
    assert [r["column"] for r in rules.collect() if r["expectation_type"] == UNIQUE] == ["id"]
    sampled = profile(df, "t", sample_fraction=0.004, sample_key=["id"])
    assert by_metric(sampled)["Uniqueness", "twice"]["value"] > 0.9
    assert UNIQUE not in {r["expectation_type"] for r in generate_rules(sampled, {"t": df.columns}).collect()}


def test_whole_and_empty_samples(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    want = by_metric(profile(df, "d"))
    got = by_metric(value_sampled_profile(df, "d", 1.0))
    assert got.keys() == want.keys()
    for k, r in got.items():
        assert (r["value"], r["seq"], r["status"]) == (want[k]["value"], want[k]["seq"], want[k]["status"]) and r["lower"] == r["upper"] == r["value"]
    none = by_metric(value_sampled_profile(df.limit(0), "d", 0.1))
    assert none.keys() == want.keys() and none["Uniqueness", "text"]["value"] is None and none["Uniqueness", "text"]["status"] == "Failure"
    nulls = by_metric(value_sampled_profile(df.withColumn("text", F.lit(None).cast("string")), "d", 0.1))
    assert nulls["Distinctness", "text"]["value"] is None and nulls["Distinctness", "doc_id"]["value"] is not None
    with pytest.raises(ValueError, match="fraction"):
        value_sampled_profile(df, "d", 0.0)


def test_bounds_cover(spark):
    """Over many columns with different frequencies, about nineteen of twenty intervals hold the true value."""
    rng = random.Random(8)
    columns = []
    for i in range(24):
        kinds = rng.choice([50, 400, 3000, 100_000])
        columns.append(f"concat('{i}-', CAST(pmod(xxhash64(id, {i}), {kinds}) AS STRING)) AS c{i}")
    df = spark.range(4000).selectExpr(*columns)
    true = by_metric(profile(df, "t"))
    got = by_metric(value_sampled_profile(df, "t", 0.1))
    held = total = 0
    for k, r in got.items():
        if r["metric_type"] == VALUE_SAMPLED:
            total += 1
            held += r["lower"] <= true[k]["value"] <= r["upper"]
            assert 0 <= r["lower"] <= r["upper"] <= 1
    assert total == 48 and held >= 0.85 * total


def test_row_sample_bounds(spark):
    df = spark.range(20_000).selectExpr("id", "if(id % 10 = 0, NULL, CAST(pmod(xxhash64(id), 1000) AS DOUBLE)) AS x", "repeat('s', CAST(1 + id % 7 AS INT)) AS s")
    true = by_metric(profile(df, "t"))
    got = by_metric(row_sample_bounds(profile(df, "t", sample_fraction=0.05, sample_key=["id"])))
    for k in (("Completeness", "x"), ("Mean", "x"), ("StandardDeviation", "x")):
        assert got[k]["lower"] < true[k]["value"] < got[k]["upper"] and got[k]["upper"] - got[k]["lower"] < 0.2 * true[k]["value"]
    assert got["Minimum", "x"]["lower"] is None and got["Minimum", "x"]["upper"] >= true["Minimum", "x"]["value"]
    assert got["MaxLength", "s"]["upper"] is None and got["MaxLength", "s"]["lower"] <= 7
    assert got["Uniqueness", "s"]["lower"] is None and got["Size", "*"]["upper"] is None
    exact = by_metric(row_sample_bounds(profile(df, "t")))
    assert all(r["lower"] == r["upper"] == r["value"] for r in exact.values())


def test_history_runs(spark, tmp_dir):
    """Runs add up, and a run that is repeated replaces itself alone."""
    metrics = profile(spark.range(3).selectExpr("CAST(id AS STRING) AS s"), "t")
    for run in ("2024-01-01", "2024-01-02", "2024-01-01"):
        append_history(metrics.withColumn("run", F.lit(run)), tmp_dir)
    history = read_history(spark, tmp_dir)
    assert {r["run"]: r["n"] for r in history.groupBy("run").agg(F.count("*").alias("n")).collect()} == {"2024-01-01": 7, "2024-01-02": 7}


def brute_deviations(series, window, limit, least, flat, phase):
    out, past = [], {}
    for run, v in series:
        seen = [x for x in past.get(phase(run), [])[-window:] if x is not None]
        mid = statistics.median(seen) if seen else None
        spread = max(1.4826 * statistics.median([abs(x - mid) for x in seen]), flat * abs(mid)) if seen else None
        score = None if v is None or mid is None else 0.0 if v == mid else abs(v - mid) / spread if spread else math.inf
        status = "missing" if v is None else "new" if len(seen) < least else "anomaly" if score > limit else "ok"
        out.append((run, v, len(seen), mid, spread, score, status))
        past.setdefault(phase(run), []).append(v)
    return out


@pytest.mark.parametrize(("phase", "of"), [("0", lambda r: 0), ("CAST(run AS INT) % 3", lambda r: int(r) % 3)])
def test_deviations(spark, phase, of):
    rng, rows, series = random.Random(4), [], {}
    for m in ("Size", "Mean"):
        for inst in ("a", "b", "flat"):
            s = []
            for i in range(40):
                v = 100.0 if inst == "flat" else rng.gauss(50, 3) + 20 * (i % 3)
                v = None if rng.random() < 0.1 else 1e6 if i in (20, 33) else v
                s.append((f"{i:03d}", v))
            series[m, inst] = s
            rows += [("t", m, inst, r, v) for r, v in s]
    df = spark.createDataFrame(rows, "table_name string, metric string, instance string, run string, value double").repartition(5)
    got = deviations(df, window=9, limit=4.0, least=4, phase=phase)
    for (m, inst), s in series.items():
        mine = sorted(tuple(r)[3:] for r in got.where((F.col("metric") == m) & (F.col("instance") == inst)).collect())
        want = brute_deviations(s, 9, 4.0, 4, 1e-3, of)
        for a, b in zip(mine, want, strict=True):
            assert (a[0], a[1], a[2], a[6]) == (b[0], b[1], b[2], b[6])
            assert all((x is None and y is None) or math.isclose(x, y, rel_tol=1e-9) or x == y for x, y in zip(a[3:6], b[3:6], strict=True))
        assert all(r[6] == "anomaly" for r in mine if r[1] == 1e6)
