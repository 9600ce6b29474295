"""Checks and suites applied per micro-batch of a file stream."""

import os
import tempfile

from assay.operators import expectations as X
from assay.operators.checks import Check
from assay.streaming import check_stream, validate_stream

SF = "/root/testdata/sf0.001"


def _source(spark):
    src = tempfile.mkdtemp(prefix="assay-stream-src-")
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    orders.where("o_orderkey < 700").write.mode("overwrite").parquet(os.path.join(src, "part1"))
    orders.where("o_orderkey >= 700").write.mode("overwrite").parquet(os.path.join(src, "part2"))
    schema = orders.schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(src, "*"))
    return orders, stream


def test_validate_stream(spark):
    orders, stream = _source(spark)
    out = tempfile.mkdtemp(prefix="assay-stream-out-")
    rules = [
        X.expect_column_values_to_be_in_set("o_orderstatus", ["O", "F"]),
        X.expect_column_values_to_be_unique("o_orderkey"),
    ]
    q = validate_stream(stream, rules, "orders", out, available_now=True)
    q.awaitTermination(120)
    res = spark.read.json(out)
    assert res.select("batch_id").distinct().count() >= 1
    total_bad = res.where("seq = 0").groupBy().sum("unexpected_count").collect()[0][0]
    assert total_bad == orders.where("o_orderstatus NOT IN ('O', 'F')").count()
    assert res.where("seq = 1").where("NOT success").count() == 0
    total_rows = res.where("seq = 0").groupBy().sum("element_count").collect()[0][0]
    assert total_rows == orders.count()


def test_check_stream(spark):
    orders, stream = _source(spark)
    out = tempfile.mkdtemp(prefix="assay-stream-out-")
    q = check_stream(stream, [Check("orders").has_size().is_complete("o_orderkey")], "orders", out, available_now=True)
    q.awaitTermination(120)
    res = spark.read.json(out)
    assert res.count() == 2 * res.select("batch_id").distinct().count()
    assert res.where("status != 'Success'").count() == 0
