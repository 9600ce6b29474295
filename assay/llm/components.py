"""Connected components of an edge table (alternating large-star and small-star rounds).

Every round only aggregates a minimum per node (combined before the shuffle) and joins it
back, so a node with very many edges is split by the skew join, and no component is ever
gathered in one task. Rounds are written tables in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.llm.common import discard, written


def _size(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(edges: DataFrame, scratch: list[str] | None = None) -> DataFrame:
    """(id, component): the smallest id reachable, for every id that has an edge to another one.

    Each round's table goes when the next one is written; ``scratch`` gets the last one's folder.
    """
    spark, before = edges.sparkSession, []
    both = edges.selectExpr("CAST(a AS BIGINT) AS u", "CAST(b AS BIGINT) AS v").where("u <> v")
    now = written(both.selectExpr("greatest(u, v) AS u", "least(u, v) AS v").distinct(), "edges", before)
    size = _size(now)
    while size[0]:
        sym = now.unionByName(now.selectExpr("v AS u", "u AS v"))
        least = sym.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) AS m")
        large = sym.where("v > u").join(least, "u").selectExpr("v AS u", "m AS v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").selectExpr("v AS u", "m AS v").where("u <> v")
        own: list[str] = []
        now = written(small.unionByName(least.selectExpr("u", "m AS v")).distinct(), "edges", own)
        discard(spark, before)
        before = own
        size, last = _size(now), size
        if size == last:
            break
    if scratch is not None:
        scratch += before
    own = now.select("v").distinct().selectExpr("v AS id", "v AS component")
    return now.selectExpr("u AS id", "v AS component").unionByName(own)
