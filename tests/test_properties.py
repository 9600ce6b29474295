"""Property tests: metrics and rule counts equal a brute-force computation on random small tables."""

import math
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from assay.operators import expectations as X
from assay.operators.profile import profile

ints = st.lists(st.one_of(st.none(), st.integers(-5, 5)), min_size=0, max_size=30)
texts = st.lists(st.one_of(st.none(), st.sampled_from(["", "a", "bb", "ccc", "é", "日本"])), min_size=0, max_size=30)


def table(spark, xs, ss):
    n = max(len(xs), len(ss))
    xs = xs + [None] * (n - len(xs))
    ss = ss + [None] * (n - len(ss))
    return spark.createDataFrame(list(zip(xs, ss)), "x int, s string"), xs, ss


def brute(values):
    present = [v for v in values if v is not None]
    counts = Counter(present)
    n, k = len(values), len(present)
    out = {
        "Completeness": k / n if n else None,
        "Distinctness": len(counts) / k if k else None,
        "Uniqueness": sum(1 for c in counts.values() if c == 1) / k if k else None,
    }
    return out, present


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(xs=ints, ss=texts)
def test_profile_matches_brute_force(spark, xs, ss):
    df, xs, ss = table(spark, xs, ss)
    m = {(r.metric, r.instance): r.value for r in profile(df, "t").collect()}
    assert m[("Size", "*")] == len(xs)
    cells = sum(v is not None for v in xs + ss)
    assert m[("Completeness", "*")] == (pytest.approx(cells / (2 * len(xs))) if xs else None)
    for col, values in (("x", xs), ("s", ss)):
        expect, present = brute(values)
        for metric, v in expect.items():
            if metric == "Uniqueness" and col == "x":
                assert (metric, col) not in m  # profiled for string columns only
                continue
            assert m[(metric, col)] == (pytest.approx(v) if v is not None else None), (metric, col)
    _, px = brute(xs)
    if px:
        mean = sum(px) / len(px)
        assert m[("Minimum", "x")] == min(px) and m[("Maximum", "x")] == max(px)
        assert m[("Mean", "x")] == pytest.approx(mean)
        assert m[("StandardDeviation", "x")] == pytest.approx(math.sqrt(sum((v - mean) ** 2 for v in px) / len(px)))
    else:
        assert m[("Minimum", "x")] is None and m[("Mean", "x")] is None
    _, ps = brute(ss)
    if ps:
        assert m[("MinLength", "s")] == min(len(v) for v in ps)
        assert m[("MaxLength", "s")] == max(len(v) for v in ps)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(xs=ints, ss=texts, lo=st.integers(-5, 5), span=st.integers(0, 6), mostly=st.sampled_from([None, 0.5, 0.9]))
def test_rule_counts_match_brute_force(spark, xs, ss, lo, span, mostly):
    df, xs, ss = table(spark, xs, ss)
    hi = lo + span
    rules = [
        X.expect_column_values_to_be_between("x", lo, hi, mostly=mostly),
        X.expect_column_values_to_be_unique("s", mostly=mostly),
        X.expect_column_values_to_not_be_null("x", mostly=mostly),
        X.expect_column_values_to_be_in_set("s", ["a", "bb"], mostly=mostly),
        X.expect_column_value_lengths_to_be_between("s", 1, 2, mostly=mostly),
    ]
    res = {r.seq: r for r in X.validate(df, rules, "t").collect()}
    px = [v for v in xs if v is not None]
    ps = [v for v in ss if v is not None]
    cs = Counter(ps)
    expected = [
        (len(px), sum(not (lo <= v <= hi) for v in px), sorted(str(v) for v in px if not (lo <= v <= hi))),
        (len(ps), sum(c for c in cs.values() if c > 1), None),
        (len(xs), len(xs) - len(px), None),
        (len(ps), sum(v not in ("a", "bb") for v in ps), None),
        (len(ps), sum(not (1 <= len(v) <= 2) for v in ps), None),
    ]
    m = 1.0 if mostly is None else mostly
    for i, (considered, bad, sample) in enumerate(expected):
        r = res[i]
        assert r.unexpected_count == bad, (i, r)
        assert r.success == (considered == 0 or (considered - bad) / considered >= m), (i, r)
        assert len(r.partial_unexpected_list) == min(bad, 20)
        if sample is not None:
            numeric_sorted = sorted(sample, key=int)[:20]
            assert r.partial_unexpected_list == numeric_sorted
