"""Which rows may have a key in a set: a fixed-size filter in front of a join.

A join of wide rows with a set of keys shuffles all rows. Here a bitmap over hashed keys - of a
fixed size, whatever the number of keys - is broadcast first; rows that it rules out need no join,
and only the others travel. No key is missed; the join that follows removes false alarms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.functions import col

#: Bits of the filter: at most FILTER_BITS / 64 rows of two numbers are broadcast.
FILTER_BITS = 1 << 23


def bitmap(keys: DataFrame, key: str) -> DataFrame:
    """``_word, _bits`` of the keys' places; a row for each word with any."""
    place = keys.select(F.pmod(F.xxhash64(key), F.lit(FILTER_BITS)).alias("_place"))
    return place.groupBy(F.expr("_place div 64").alias("_word")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(_place % 64 AS INT)))").alias("_bits")
    )


def with_maybe(df: DataFrame, key: Column, words: DataFrame, name: str) -> DataFrame:
    """``df`` with ``name``: false where ``key`` is null or certainly not among the keys of the bitmap."""
    marked = df.withColumn("_place", F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))).withColumn("_word", F.expr("_place div 64"))
    joined = marked.join(F.broadcast(words), "_word", "left")
    bit = F.expr("(shiftright(coalesce(_bits, 0L), CAST(_place % 64 AS INT)) & 1L) = 1")
    return joined.withColumn(name, bit & key.isNotNull()).select(*[col(c) for c in df.columns], name)
