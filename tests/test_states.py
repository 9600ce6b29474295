"""Mergeable metric states: any split of a table, merged in any order, gives the table's own metrics."""

import math
import os
import random

import pytest
from pyspark.sql import functions as F

from assay.operators.analyzers import (
    SKETCH_ERROR,
    ApproxCountDistinct,
    ApproxDistinctness,
    Completeness,
    Compliance,
    CountDistinct,
    Distinctness,
    DuplicateRows,
    Maximum,
    Mean,
    Minimum,
    MissingCount,
    Size,
    StandardDeviation,
    UnexpectedCount,
    Uniqueness,
    run_analyzers,
)
from assay.operators.profile import profile_analyzers
from assay.operators.states import StateStore, compute_states, merge_states, metrics_of

SF = "/root/testdata/sf0.001"


def values(metrics, *by):
    return {(*(r[b] for b in by), r["seq"], r["analyzer"]): (r["value"], r["status"], r["message"]) for r in metrics.collect()}


def same(got, want):
    assert got.keys() == want.keys()
    for k, (v, status, message) in want.items():
        assert got[k][1:] == (status, message), k
        assert (v is None and got[k][0] is None) or math.isclose(got[k][0], v, rel_tol=1e-9, abs_tol=1e-9) or (v != v and got[k][0] != got[k][0]), (k, got[k], v)


EVERYTHING = [
    Size(), Completeness("*"), Completeness("a"), Distinctness("a"), Uniqueness("s"), CountDistinct("b"), DuplicateRows("s"), Minimum("a"),
    Maximum("b"), Mean("b"), StandardDeviation("b"), Mean("a"), MissingCount("s"), UnexpectedCount("a", condition="a > 3"),
    Compliance.of("positive", "b > 0"), Minimum("s"), Completeness("no_such"), Distinctness("l"), Compliance.of("bad", "nothing = 1"),
]


@pytest.mark.parametrize("name", ["orders", "documents", "events", "embeddings"])
def test_halves_give_the_whole(spark, tmp_dir, name):
    df = spark.read.parquet(f"{SF}/{name}.parquet")
    key = df.columns[0]
    stores = [
        compute_states(df.where(f"pmod(xxhash64(`{key}`), 2) = {h}"), profile_analyzers(df.schema), os.path.join(tmp_dir, str(h))) for h in (0, 1)
    ]
    want = values(run_analyzers(df, profile_analyzers(df.schema), "t"))
    same(values(metrics_of(stores, df.schema, profile_analyzers(df.schema), "t")), want)
    merged = merge_states(stores, os.path.join(tmp_dir, "both"))
    same(values(metrics_of(merged, df.schema, profile_analyzers(df.schema), "t")), want)


def random_rows(rng, n):
    return [
        (rng.choice([None, 0, 1, 2, 3, 4, 9]), rng.choice([None, 0.0, -0.0, 1.5, -2.25, 1e9, float("nan")]) if rng.random() < 0.3 else rng.gauss(1e6, 1),
         rng.choice([None, "", "x", "y", "z" * 300, f"u{rng.random()}"]), rng.choice([None, [], [1.0], [1.0, None], [-0.0]]))
        for _ in range(n)
    ]


def test_any_split_any_order(spark, tmp_dir):
    """Uneven parts (some empty), merged as a list, as a chain and as a tree."""
    rng = random.Random(11)
    parts = [random_rows(rng, n) for n in (0, 1, 40, 7, 0, 150)]
    schema = "a int, b double, s string, l array<double>"
    frames = [spark.createDataFrame(p, schema) for p in parts]
    whole = spark.createDataFrame([r for p in parts for r in p], schema)
    want = values(run_analyzers(whole, EVERYTHING, "t"))
    stores = [compute_states(f, EVERYTHING, os.path.join(tmp_dir, f"p{i}")) for i, f in enumerate(frames)]
    rng.shuffle(stores)
    same(values(metrics_of(stores, whole.schema, EVERYTHING, "t")), want)
    chain = stores[0]
    for i, s in enumerate(stores[1:]):
        chain = merge_states([chain, s], os.path.join(tmp_dir, f"c{i}"))
    same(values(metrics_of(chain, whole.schema, EVERYTHING, "t")), want)
    tree = merge_states([merge_states(stores[:3], os.path.join(tmp_dir, "l")), merge_states(stores[3:], os.path.join(tmp_dir, "r"))], os.path.join(tmp_dir, "t"))
    same(values(metrics_of(tree, whole.schema, EVERYTHING, "t")), want)
    empty = compute_states(frames[0].limit(0), EVERYTHING, os.path.join(tmp_dir, "e"))
    same(values(metrics_of(empty, whole.schema, EVERYTHING, "t")), values(run_analyzers(whole.limit(0), EVERYTHING, "t")))


def test_deviation_without_cancellation(spark, tmp_dir):
    """Large means and tiny spread: sums of squares would lose every digit."""
    df = spark.range(2000).selectExpr("id", "1e12 + id % 2 AS x")
    stores = [compute_states(df.where(f"id % 5 = {i}"), [Mean("x"), StandardDeviation("x")], os.path.join(tmp_dir, str(i))) for i in range(5)]
    got = {r["metric"]: r["value"] for r in metrics_of(stores, df.schema, [Mean("x"), StandardDeviation("x")]).collect()}
    assert got["Mean"] == 1e12 + 0.5 and math.isclose(got["StandardDeviation"], 0.5, rel_tol=1e-4)


def test_segments(spark, tmp_dir):
    """One pass gives a state for each segment; any of them together give the metrics of their rows."""
    df = spark.read.parquet(f"{SF}/events.parquet").withColumn("day", F.expr("CAST(CAST(ts AS DATE) AS STRING)"))
    df = df.withColumn("value", F.expr("if(event_type = 'error', NULL, value)")).withColumn("never", F.expr("if(day > '2', CAST(NULL AS INT), 1)"))
    wanted = [Size(), Completeness("value"), Mean("value"), Minimum("value"), Uniqueness("event_type"), Distinctness("user_id"), Distinctness("never")]
    store = compute_states(df, wanted, os.path.join(tmp_dir, "s"), segment="day")
    got = values(metrics_of(store, df.schema, wanted, by_segment=True), "segment")
    days = [r["day"] for r in df.select("day").distinct().collect()]
    assert {k[0] for k in got} == set(days)
    for day in random.Random(1).sample(days, min(4, len(days))):
        want = values(run_analyzers(df.where(F.col("day") == day), wanted))
        same({k[1:]: v for k, v in got.items() if k[0] == day}, want)
    same(values(metrics_of(store, df.schema, wanted)), values(run_analyzers(df, wanted)))


def test_sketches(spark, tmp_dir):
    """Sketched distinct counts stay within their error, merge to what one pass gives, and shuffle no values."""
    df = spark.range(60_000).selectExpr("id", "CAST(id % 30011 AS STRING) AS s", "id % 5 AS few", "CAST(NULL AS STRING) AS none", "if(id % 4 = 0, NULL, id % 9973) AS n")
    wanted = [k(c) for c in df.columns for k in (ApproxCountDistinct, ApproxDistinctness)]
    true = {"id": 60_000, "s": 30_011, "few": 5, "none": 0, "n": 9973}
    direct = {(r["metric"], r["instance"]): r["value"] for r in run_analyzers(df, wanted).collect()}
    for c, n in true.items():
        assert abs(direct["ApproxCountDistinct", c] - n) <= SKETCH_ERROR * n
    assert direct["ApproxCountDistinct", "few"] == 5 and direct["ApproxDistinctness", "none"] is None and direct["ApproxDistinctness", "id"] <= 1
    plan = run_analyzers(df, wanted)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan
    stores = [compute_states(df.where(f"id % 3 = {i}"), wanted, os.path.join(tmp_dir, str(i))) for i in range(3)]
    merged = merge_states(stores, os.path.join(tmp_dir, "m"))
    for got in (metrics_of(stores, df.schema, wanted), metrics_of(merged, df.schema, wanted)):
        for k, v in {(r["metric"], r["instance"]): r["value"] for r in got.collect()}.items():
            assert (v is None and direct[k] is None) or abs(v - direct[k]) <= SKETCH_ERROR * max(abs(direct[k]), 1e-9)


def test_second_run_reads_only_what_is_new(spark, tmp_dir):
    df = spark.read.parquet(f"{SF}/orders.parquet")
    old_path, new_path = os.path.join(tmp_dir, "old"), os.path.join(tmp_dir, "new")
    df.where("o_orderkey % 3 > 0").write.parquet(old_path)
    df.where("o_orderkey % 3 = 0").write.parquet(new_path)
    old = compute_states(spark.read.parquet(old_path), profile_analyzers(df.schema), os.path.join(tmp_dir, "s-old"))
    new = compute_states(spark.read.parquet(new_path), profile_analyzers(df.schema), os.path.join(tmp_dir, "s-new"))
    metrics = metrics_of([old, new], df.schema, profile_analyzers(df.schema))
    plan = metrics._jdf.queryExecution().executedPlan().toString()
    assert old_path not in plan and new_path not in plan and "s-old" in plan and "s-new" in plan
    same(values(metrics), values(run_analyzers(df, profile_analyzers(df.schema))))
    # a column's frequencies alone are read for its metrics
    one = metrics_of([old, new], df.schema, [Uniqueness("o_orderstatus")])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(column), EqualTo(column,o_orderstatus)]" in one or "EqualTo(column,o_orderstatus)" in one or "In(column" in one
    old.remove()
    with pytest.raises(Exception):  # noqa: B017 - whatever Spark raises for a missing folder
        StateStore(spark, old.path).partials().count()
