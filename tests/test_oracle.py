"""Differential test: every registered query against its DuckDB twin on the given tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

SF_DIR = os.environ.get("ASSAY_TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    """Of the library's own queries; those of the optional subpackage have tests of their own."""
    from assay.plans.oracle import oracle_sql
    from assay.plans.queries import QUERIES as OWN

    assert set(SQL) <= set(QUERIES)
    assert set(oracle_sql()) == set(OWN)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_duckdb(spark, con, name):
    _, status, rows, _, detail = compare(spark, con, name, QUERIES[name], SQL[name], SF_DIR)
    assert status == "ok", detail
    assert rows > 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 62 and df.columns[:3] == ["table_name", "seq", "entity"]


def test_sampled_profile_is_deterministic(spark):
    a = QUERIES["profile_sampled"](spark, SF_DIR).collect()
    b = QUERIES["profile_sampled"](spark, SF_DIR).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    size = [r.value for r in a if r.metric == "Size"][0]
    total = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").count()
    assert 0.05 * total < size < 0.15 * total
