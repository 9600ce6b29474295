"""Row-level verdicts against brute force, and validation that isolates bad rules."""

import os
import random

import pytest

from assay.operators import expectations as X
from assay.operators.membership import bitmap, with_maybe
from assay.operators.verdicts import RowRule, quarantine, row_verdicts

RULES = [
    X.expect_column_values_to_not_be_null("a"),
    X.expect_column_values_to_be_in_set("s", ["x", "it's", None]),
    X.expect_column_values_to_be_between("a", 0, 5, mostly=0.5),
    X.expect_column_value_lengths_to_be_between("s", 1, None),
    X.expect_column_values_to_be_unique("s"),
    X.expect_column_values_to_be_unique("b"),
    RowRule("order", "a < b"),
    X.expect_table_row_count_to_be_between(1, 2),
    X.expect_column_values_to_be_between("s", 1, 3),
    X.expect_column_values_to_be_in_set("nowhere", [1]),
    RowRule("broken", "no_such > 1"),
    X.expect_column_values_to_be_unique("l"),
]
USABLE = {0, 1, 2, 3, 4, 5, 6, 11}


def rows_of(rng, n):
    return [
        (i, rng.choice([None, -1, 0, 3, 7]), rng.choice([None, 0.0, -0.0, float("nan"), 2.5, rng.random()]),
         rng.choice([None, "", "x", "it's", "long " * 100, f"u{i}"]), rng.choice([None, [1], [1, None], [i]]))
        for i in range(n)
    ]


def brute(rows):
    def key(v):
        return "nan" if v != v else str(v + 0.0 if isinstance(v, float) else v)

    def again(j):
        seen = {}
        for r in rows:
            if r[j] is not None:
                seen[key(r[j])] = seen.get(key(r[j]), 0) + 1
        return lambda v: v is not None and seen[key(v)] > 1

    many_s, many_b, many_l = again(3), again(2), again(4)
    out = {}
    for i, a, b, s, ls in rows:
        bad = [a is None, s is not None and s not in ("x", "it's"), a is not None and not 0 <= a <= 5, s is not None and len(s) < 1, many_s(s), many_b(b)]
        nan = b is not None and b != b  # the engine orders NaN above all numbers
        bad.append(a is None or b is None or not (nan or a < b))
        out[i] = [k for k, x in enumerate(bad) if x] + ([11] if many_l(ls) else [])
    return out


SCHEMA = "id int, a int, b double, s string, l array<int>"


@pytest.mark.parametrize("seed", [1, 2])
def test_verdicts(spark, tmp_dir, seed):
    rows = rows_of(random.Random(seed), 250)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    want = brute(rows)
    got = {r["id"]: list(r["failed_rules"]) for r in row_verdicts(df, RULES).collect()}
    assert got == want
    split = quarantine(df, RULES, os.path.join(tmp_dir, "out"))
    assert split.passed.columns == df.columns and split.quarantined.columns == [*df.columns, "failed_rules"]
    assert sorted(r["id"] for r in split.passed.collect()) == sorted(i for i, f in want.items() if not f)
    assert {r["id"]: list(r["failed_rules"]) for r in split.quarantined.collect()} == {i: f for i, f in want.items() if f}
    counts = {r["seq"]: (r["failed_rows"], r["message"]) for r in split.counts.collect()}
    assert {i for i, (n, _) in counts.items() if n is not None} == USABLE
    assert all(counts[i][0] == sum(i in f for f in want.values()) for i in USABLE)
    assert all(counts[i][1] for i in set(counts) - USABLE) and "whole table" in counts[7][1] and "NumericType" in counts[8][1]


def test_verdict_edges(spark, tmp_dir):
    df = spark.createDataFrame(rows_of(random.Random(3), 20), SCHEMA)
    empty = quarantine(df.limit(0), RULES, os.path.join(tmp_dir, "empty"))
    assert empty.passed.count() == 0 and empty.quarantined.count() == 0
    assert [r["failed_rows"] for r in empty.counts.orderBy("seq").collect()] == [0 if i in USABLE else None for i in range(len(RULES))]
    assert all(r["failed_rules"] == [] for r in row_verdicts(df, []).collect())
    with pytest.raises(ValueError, match="failed_rules"):
        row_verdicts(df.withColumnRenamed("a", "Failed_Rules"), RULES[4:5])
    odd = df.withColumnRenamed("s", "a `b`.c")
    assert row_verdicts(odd, [X.expect_column_values_to_be_unique("a `b`.c")]).count() == 20


def test_clean_rows_are_not_shuffled(spark, tmp_dir):
    """Rows that no repeated value can be in go past the join; a hot value is a skewed join, not a group."""
    path = os.path.join(tmp_dir, "t")
    spark.range(5000).selectExpr("id", "if(id < 2000, 7, id) AS k", "repeat('w', 50) AS wide").write.parquet(path)
    df = spark.read.parquet(path)
    tagged = row_verdicts(df, [X.expect_column_values_to_be_unique("k")])
    assert tagged.where("size(failed_rules) > 0").count() == 2000
    words = bitmap(df.where("k = 7").select("k"), "k")
    from pyspark.sql import functions as F

    assert with_maybe(df, F.col("k"), words, "m").where("m").count() < 2100
    assert with_maybe(df, F.lit(None).cast("bigint"), words, "m").where("m").count() == 0


def test_validate_isolates_bad_rules(spark):
    """A rule that cannot be computed - by type, by name or while it runs - is not successful; the others are unchanged."""
    df = spark.createDataFrame([(1, "a", 0), (2, "b", 1), (3, "5", 0)], "id int, s string, z int")
    good = [X.expect_column_values_to_be_unique("id"), X.expect_column_values_to_be_in_set("s", ["a", "b"]), X.expect_column_values_to_be_between("id", 2, None)]
    bad = [
        X.expect_column_values_to_be_between("s", 1, 3),
        X.expect_column_value_lengths_to_be_between("id", 1, 2),
        X.expect_column_values_to_be_in_set("s", [1, 2]),
        X.expect_column_values_to_be_unique("no"),
        X.expect_column_values_to_be_between("s", "a", "c"),
    ]
    alone = [r.asDict() for r in X.validate(df, good).collect()]
    mixed = [r.asDict() for r in X.validate(df, [*good, *bad]).orderBy("seq").collect()]
    assert mixed[:3] == alone
    assert [r["success"] for r in mixed] == [True, False, False, False, False, False, False, False]
    assert mixed[1]["partial_unexpected_list"] == ["5"] and mixed[2]["partial_unexpected_list"] == ["1"]
    assert mixed[3]["unexpected_count"] is None and mixed[7]["unexpected_count"] == 1
